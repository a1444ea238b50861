"""Runs of chosen bytes in texts that lie end to end, as codes into a dictionary of their strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Rows in a batch that a task hands on: what the JVM holds of it at once.
ROWS = 1 << 14
#: A-Z to a-z; all other bytes, those of longer characters too, stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def members(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags with the bytes of the ranges (ends included) set."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


def runs_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of all longest runs of `inside` bytes (starts, ends) and the text of each; no run passes a text's end."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none, none
    flag = inside[data]
    first, last = flag.copy(), flag.copy()
    first[1:] &= ~flag[:-1]
    last[:-1] &= ~flag[1:]
    heads, tails = offsets[:-1][offsets[:-1] < len(data)], offsets[1:][offsets[1:] > 0] - 1
    first[heads], last[tails] = flag[heads], flag[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A code for each byte range, and the strings (large_string) that the codes stand for. The ranges must not overlap."""
    if not len(starts):
        return np.zeros(0, np.int64), pa.array([], pa.large_string())
    places = np.concatenate([[0], np.cumsum(ends - starts)])
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    body = np.ascontiguousarray(data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(body)).dictionary_encode()
    return words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def pieces(batch: pa.RecordBatch, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a bounded size."""
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)
