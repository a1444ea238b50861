"""Token-id output: documents to compressed blocks of ids in ascending doc_id order, and back.

Texts are range-partitioned and sorted by doc_id, tokenized, and coded block by block (see id_coder.py). A block is one
row of a Parquet table in a folder shared by all executors, so Spark's commit protocol makes each task's output whole or
absent. Rows: `part` and `block` (their order is the documents' order), `n_ids`, `doc_ids` and `doc_lengths` of its
documents, `payload`. The reader decodes each block, checks its checksum, and adds the number of ids before it.

Null texts count as empty and still get the end id. Documents with equal doc_id stand next to each other, ordered by a
hash of the text; documents with a null doc_id come first. An empty table gives an empty file set. A document is never split over
blocks, so a longer one makes a longer block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import id_coder
from .common import Durable, text_chunks
from .units import tokenizer

BLOCKS = "part int, block int, n_ids long, doc_ids array<bigint>, doc_lengths array<bigint>, payload binary"


def blocks_of(docs: DataFrame, path: str, end_id: int = 0, block_ids: int = id_coder.BLOCK_IDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows as in BLOCKS, to be written by any Spark writer."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        docs_held: list[tuple[list, np.ndarray]] = []
        size = 0

        def row() -> pa.RecordBatch:
            ids = np.concatenate(held) if held else np.zeros(0, np.int64)
            lengths = np.concatenate([n for _, n in docs_held])
            names = [x for d, _ in docs_held for x in d]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            values = [part, block, len(ids), names, lengths.tolist(), id_coder.encode(ids)]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["part", "block", "n_ids", "doc_ids", "doc_lengths", "payload"])

        for batch in batches:
            for piece, data, offsets in text_chunks(batch, "text"):
                ids, lengths = tokenizer(path).encode(data, offsets)
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                held.append(ids)
                docs_held.append((piece.column(0).to_pylist(), lengths + 1))
                size += len(ids)
                if size >= block_ids:
                    yield row()
                    block, size = block + 1, 0
                    held.clear()
                    docs_held.clear()
        if docs_held:
            yield row()

    slim = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    # ranges may cut through equal ids (null ones too), so they are no hot spot
    order = ["doc_id", F.xxhash64("text")]
    return slim.repartitionByRange(*order).sortWithinPartitions(*order, "text").mapInArrow(work, BLOCKS)


def read_blocks(blocks: DataFrame) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, decoded from the payloads."""
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).sort("part").collect()  # one row for each written partition
    before, starts = 0, []
    for p in parts:
        starts.append((p["part"], before))
        before += p["n"]
    spark = blocks.sparkSession
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = blocks.select("part", "block", "n_ids").withColumn("inner", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).select("part", "block", "inner")
    # a row of two numbers for each partition: bounded by the partition count
    places = places.join(F.broadcast(spark.createDataFrame(starts, "part int, outer long")), "part").select("part", "block", (F.col("outer") + F.col("inner")).alias("start"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, lengths, start, payload in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                ids = id_coder.decode(payload).astype("<u4")
                n = np.array(lengths, np.int64)
                ends = np.cumsum(n)
                raw = memoryview(ids.tobytes())
                crcs = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(start + ends - n), pa.array(n), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.join(places, ["part", "block"]).select("doc_ids", "doc_lengths", "start", "payload").mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Writes the ids of all documents to the shared folder and reads them back."""
    return read_blocks(Durable(blocks_of(docs, path, end_id), "token-ids").df)
