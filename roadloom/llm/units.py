"""Tokenizing by distinct units.

A unit is a stretch of text between two single blanks that stand between visible characters. No pre-token of the two
public tokenizers spans such a place, so the tokens of a text are the tokens of its units, one after another. Units
repeat, so each task gives every distinct one to the library once and finds the rest by a 128-bit key.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from itertools import chain

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Distinct units that a worker remembers; beyond it forgets those met only once (memory, not results, depend on it).
UNIT_LIMIT = 900_000

_U = np.uint64
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_BLANK_OR_CONTROL = np.zeros(256, bool)
_BLANK_OR_CONTROL[:0x21] = True
_BLANK_OR_CONTROL[0x7F] = True
#: First bytes of the UTF-8 forms of white space beyond ASCII (U+0085, U+00A0, U+1680, U+20xx, U+3000).
_WIDE_BLANK_LEAD = np.zeros(256, bool)
_WIDE_BLANK_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which units start; every non-empty text starts one."""
    n = len(data)
    mark = np.zeros(n + 1, bool)
    if n > 2:
        at = np.flatnonzero((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) + 1
        left, right = data[at - 1], data[at + 1]
        ok = ~_BLANK_OR_CONTROL[left] & ~_BLANK_OR_CONTROL[right] & ~_WIDE_BLANK_LEAD[right]
        wide = left >= 0x80
        wide &= _WIDE_BLANK_LEAD[data[np.maximum(at - 2, 0)]] | _WIDE_BLANK_LEAD[data[np.maximum(at - 3, 0)]]
        mark[at[ok & ~wide]] = True
    # a blank that ends a text, or starts the next, is no inner boundary
    ends = offsets[1:] - 1
    mark[ends[ends >= 0]] = False
    mark[offsets[:-1]] = True
    mark[n] = False
    return np.flatnonzero(mark)


def byte_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys of each byte range."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = ends - starts
    a, b = left.astype(np.uint64) * _U(0x9E3779B97F4A7C15), left.astype(np.uint64) + _U(0x632BE59BD9B4E019)
    at, live = starts.copy(), None
    while True:
        here = slice(None) if live is None else live
        w = words[at] & _MASKS[np.minimum(left, 8)]
        x = (a[here] ^ w) * _U(0xBF58476D1CE4E5B9)
        a[here] = x ^ (x >> _U(29))
        x = (b[here] + w) * _U(0x94D049BB133111EB)
        b[here] = x ^ (x >> _U(32))
        more = left > 8
        if not more.any():
            break
        live = np.flatnonzero(more) if live is None else live[more]
        at, left = at[more] + 8, left[more] - 8
    a *= _U(0xD6E8FEB86659FD93)
    return a ^ (a >> _U(32)), b


class UnitTable:
    """Open-addressing table from unit keys to small integer arrays, filled by `resolve(list of units)`."""

    def __init__(self, resolve: Callable[[list[str]], list[list[int]]], dtype=np.int32, limit: int = UNIT_LIMIT):
        self.resolve, self.dtype, self.limit = resolve, dtype, limit
        self._clear()

    def _clear(self) -> None:
        self.n, self.size = 0, 1 << 16
        self.slots = np.full(self.size, -1, np.int32)
        self.a, self.b = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64)
        self.again = np.zeros(1024, bool)  # units met in a later call than their first
        self.first, self.flat, self.used = np.zeros(1025, np.int64), np.zeros(4096, self.dtype), 0

    def _forget(self) -> None:
        """Keeps the units that were met again, unless they are many."""
        keep = np.flatnonzero(self.again[: self.n])
        if 2 * len(keep) > self.limit:
            self._clear()
            return
        a, b = self.a[keep], self.b[keep]
        flat, lengths = self.values(keep)
        self._clear()
        if len(keep):
            self._add(a, b, flat, lengths)

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = np.full(len(a), -1, np.int32)
        todo, mask = np.arange(len(a)), self.size - 1
        slot = (a & _U(mask)).astype(np.int64)
        while len(todo):
            at = self.slots[slot]
            hit = (at >= 0) & (self.a[at] == a[todo]) & (self.b[at] == b[todo])
            found[todo[hit]] = at[hit]
            on = (at >= 0) & ~hit
            todo, slot = todo[on], (slot[on] + 1) & mask
        return found

    def _place(self, ids: np.ndarray) -> None:
        mask = self.size - 1
        slot = (self.a[ids] & _U(mask)).astype(np.int64)
        while len(ids):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = ids[free]
            on = self.slots[slot] != ids
            ids, slot = ids[on], (slot[on] + 1) & mask

    def _grow(self, a: np.ndarray, b: np.ndarray, values: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, values), np.int64, len(a))
        self._add(a, b, np.fromiter(chain.from_iterable(values), self.dtype, int(lengths.sum())), lengths)

    def _add(self, a: np.ndarray, b: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> None:
        k, n = len(a), self.n
        while n + k > len(self.a):
            self.a, self.b, self.again = (np.resize(x, 2 * len(x)) for x in (self.a, self.b, self.again))
            self.first = np.resize(self.first, len(self.a) + 1)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.a[n : n + k], self.b[n : n + k], self.again[n : n + k] = a, b, False
        self.flat[self.used : self.used + len(flat)] = flat
        self.first[n + 1 : n + k + 1] = self.used + np.cumsum(lengths)
        self.n, self.used = n + k, self.used + len(flat)
        if 2 * self.n > self.size:
            while 2 * self.n > self.size:
                self.size *= 4
            self.slots = np.full(self.size, -1, np.int32)
            self._place(np.arange(self.n, dtype=np.int32))
        else:
            self._place(np.arange(n, n + k, dtype=np.int32))

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The table's row for each unit; new units are resolved and kept."""
        if self.n > self.limit:
            self._forget()
        a, b = byte_keys(data, starts, ends)
        rows, raw = self._find(a, b), None
        self.again[rows] = rows >= 0  # a miss marks the last place, which is set anew when a unit comes there
        while len(new := np.flatnonzero(rows < 0)):
            _, at = np.unique(a[new], return_index=True)
            pick = new[at]
            raw = data.tobytes() if raw is None else raw
            texts = [raw[s:e].decode("utf-8") for s, e in zip(starts[pick].tolist(), ends[pick].tolist(), strict=True)]
            self._grow(a[pick], b[pick], self.resolve(texts))
            rows[new] = self._find(a[new], b[new])
        return rows

    def last(self, rows: np.ndarray) -> np.ndarray:
        """The last of each row's values; rows must have some."""
        return self.flat[self.first[rows + 1] - 1]

    def values(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows' values end to end, and how many each row has."""
        begin = self.first[rows]
        lengths = self.first[rows + 1] - begin
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(begin - (ends - lengths), lengths) + np.arange(total)], lengths


#: A blank and then visible characters whose lower case keeps its place; no `<`, with which special strings begin.
_PLAIN = re.compile("[ \n][!-;=-~\u00a1-\u012f\u0131-\u024f]+").fullmatch


class UnitTokenizer:
    """Ids by the tokenizers library, without added special tokens; special strings inside texts by its default."""

    #: Units that one call of the library gets as one text.
    JOIN = 512

    def __init__(self, path: str, limit: int = UNIT_LIMIT):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        settings = json.loads(self.tokenizer.to_str())
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_words = bool(settings["model"].get("end_of_word_suffix"))
        self.special = [x["content"] for x in settings["added_tokens"]]
        self.token_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        suffix = settings["model"].get("end_of_word_suffix") or ""
        for token, i in vocab.items():  # a character of the byte alphabet stands for a byte
            self.token_bytes[i] = len(token.removesuffix(suffix) if suffix else token)
        self.table = UnitTable(self.resolve, np.int32, limit)

    def resolve(self, units: list[str]) -> list[list[int]]:
        """Units of a known normal length stand next to others in one text; the token ends must then meet every unit's end."""
        out: list[list[int] | None] = [None] * len(units)
        plain = [i for i, u in enumerate(units) if _PLAIN(u)]
        groups = [plain[k : k + self.JOIN] for k in range(0, len(plain), self.JOIN)]
        texts = ["".join([units[i] for i in g]) for g in groups]
        for group, encoded in zip(groups, self.batch(texts, add_special_tokens=False) if texts else [], strict=True):
            ids = encoded.ids
            if self.ends_words:
                sizes = [len("".join(units[i].lower().split()).encode()) for i in group]
            else:
                sizes = [len(units[i].encode()) for i in group]
            reach, want = np.cumsum(self.token_bytes[ids]), np.cumsum(sizes)
            at = np.searchsorted(reach, want)
            if len(reach) and reach[-1] == want[-1] and (reach[np.minimum(at, len(reach) - 1)] == want).all():
                cut = [0, *(at + 1).tolist()]
                for i, s, e in zip(group, cut, cut[1:], strict=False):
                    out[i] = ids[s:e]
        alone = [i for i, x in enumerate(out) if x is None]
        for i, encoded in zip(alone, self.batch([units[i] for i in alone], add_special_tokens=False) if alone else [], strict=True):
            out[i] = encoded.ids
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each text."""
        starts = unit_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        rows = self.table.lookup(data, starts, ends)
        ids, lengths = self.table.values(rows)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(upto[np.searchsorted(starts, offsets)])


_tokenizers: dict[str, UnitTokenizer] = {}


def tokenizer(path: str) -> UnitTokenizer:
    """One per worker and path: reused by the worker's later tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = UnitTokenizer(path)
    return _tokenizers[path]
