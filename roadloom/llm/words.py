"""Words of texts that lie end to end in one buffer: runs of bytes other than the six ASCII blanks."""

from __future__ import annotations

import numpy as np

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of all words (starts, ends), and for each text its first word's number (one more entry at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    visible = ~BLANK[data]
    first = visible.copy()
    first[1:] &= ~visible[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = visible[heads]
    last = visible.copy()
    last[:-1] &= ~visible[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = visible[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with one blank after each, and where each begins (one more entry at the end)."""
    places = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    out = np.full(places[-1], 0x20, np.uint8)
    spot = np.ones(places[-1], bool)
    spot[places[1:] - 1] = False
    out[spot] = data[~BLANK[data]]
    return out, places
