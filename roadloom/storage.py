"""Where iterations cut their lineage, and where writers put their files."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where that is unset, a temporary one, but only if driver
    and executors are one process (tests): elsewhere such a folder would lose data."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="roadloom-"))
    return _own_dir[0]


def ensure_checkpoints(df: DataFrame) -> None:
    """Checkpoints go to the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
