"""The package on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: they need not share the driver's folders."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="roadloom-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
