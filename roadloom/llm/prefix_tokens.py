"""Token counts by prefix dynamic programming.

For a pre-token of n bytes, `count[i]` is the exact number of tokens of its first i bytes: the last token t of a prefix
is the one whose neighbour on the left (the last token of the prefix before t) does not merge with it, so
`count[i] = count[i - len(t)] + 1`. The counts of every prefix of a unit (see units.py) are kept, where a prefix that ends
inside white space, a contraction or a special string is counted as the text it is by itself. A text's counts at every
prefix are those of its units, added up: `token_prefixes` stores them for each character, and `count_at` and `cut_points`
answer how many tokens a prefix has and where to cut at a budget from what is stored, without encoding again.

Null texts count as empty: 0 bytes, 0 tokens, not over the limit, no prefixes. An empty table gives an empty table. Repeated
rows each get a row. Columns of the input other than the id and text are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import text_chunks
from .units import UnitTable, unit_starts

#: Fixed value: the public pattern that splits text before the merges of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens whose prefixes are more than one pre-token.
CONTRACTIONS = frozenset(PATTERN.split("| ?")[0].split("|"))


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE files."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + rest.index(b)) for b in range(256)]


class PrefixCounter:
    """Exact token counts of every byte prefix, for a byte-level BPE file of the tokenizers library."""

    PAIRS = 400_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in enumerate(byte_alphabet())}
        as_bytes = lambda token: bytes(to_byte[c] for c in token)
        special = {x["content"] for x in spec["added_tokens"]}
        # a token's rank: a byte's value, or 256 and its place among the merges
        self.rank = {bytes([b]): b for b in range(256)}
        self.parts: dict[int, tuple[int, int]] = {b: (b, b) for b in range(256)}
        self.joins: dict[tuple[int, int], int] = {}
        for k, merge in enumerate(spec["model"]["merges"]):
            x, y = map(as_bytes, merge.split(" ") if isinstance(merge, str) else merge)
            self.rank.setdefault(x + y, 256 + k)
            self.parts[256 + k] = self.rank[x], self.rank[y]
            self.joins[self.rank[x], self.rank[y]] = 256 + k
        # the most bytes of a token by its last two: longer ones needn't be tried
        self.reach: dict[bytes, int] = {}
        for token in self.rank:
            self.reach[token[-2:]] = max(len(token), self.reach.get(token[-2:], 1))
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.split, self.blank = regex.compile(PATTERN), regex.compile(r"\s\s?").fullmatch
        self.pairs: dict[int, bool] = {}
        self.table = UnitTable(self.resolve)

    def _apart(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart: undo their merges from the latest back, looking for an earlier one across the border."""
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is not None:
            return known
        before, answer = 1 << 30, None
        while answer is None:
            if self.joins.get((left, right), before) < before:
                answer = False
            elif left < 256 and right < 256:
                answer = True
            elif left > right:
                before, left = left, self.parts[left][1]
            else:
                before, right = right + 1, self.parts[right][0]
        if len(self.pairs) > self.PAIRS:
            self.pairs.clear()
        self.pairs[key] = answer
        return answer

    def extend(self, piece: bytes, counts: list[int], last: list[int]) -> None:
        """counts[i]: tokens of the piece's first i bytes; last[i]: the last of them. Goes on from where the lists end."""
        rank, apart, reach = self.rank.get, self._apart, self.reach.get
        for i in range(len(counts), len(piece) + 1):
            for j in range(max(0, i - reach(piece[max(0, i - 2) : i], 1)), i):
                token = rank(piece[j:i])
                if token is not None and (j == 0 or apart(last[j], token)):
                    counts.append(counts[j] + 1)
                    last.append(token)
                    break

    def prefix_counts(self, piece: bytes) -> list[int]:
        """Tokens of the first 0, 1, 2, ... bytes of one pre-token."""
        counts, last = [0], [-1]
        self.extend(piece, counts, last)
        return counts

    def _plain(self, pieces: list[str], counts_of: dict[bytes, list[int]]) -> list[int]:
        """Tokens of every prefix of the text that these pre-tokens make up, by bytes, from the first byte on."""
        out: list[int] = []
        total = base = 0
        run = b""  # white space that ends here, and the tokens before it
        for piece in pieces:
            raw = piece.encode()
            counts = counts_of.get(raw) or self.prefix_counts(raw)
            if self.blank(piece[:2]):  # ends a text as one pre-token, however what follows divides it
                base = base if run else total
                run, before = run + raw, len(run)
                whole = counts if not before else self.prefix_counts(run)
                out += [base + c for c in whole[before + 1 :]]
            else:
                ahead = counts[1:] if piece not in CONTRACTIONS else [*range(1, len(raw)), counts[-1]]
                out += [total + c for c in ahead]
                if run and piece[0] == " ":
                    out[-len(raw)] = base + self.prefix_counts(run + b" ")[-1]
                run = b""
            total += counts[-1]
        return out

    def resolve(self, units: list[str]) -> list[list[int]]:
        """Counts at every byte of new units: their pre-tokens in byte order, so that each goes on from the prefix it shares with the one before."""
        parts = [self.special.split(u) if self.special else [u] for u in units]
        split = [[self.split.findall(x) for x in p[::2]] for p in parts]
        known: dict[bytes, list[int]] = {}
        before, counts, last = b"", [0], [-1]
        for piece in sorted({x.encode() for p in split for pieces in p for x in pieces}):
            same = len(commonprefix((before, piece)))
            del counts[same + 1 :], last[same + 1 :]
            self.extend(piece, counts, last)
            before, known[piece] = piece, counts.copy()
        out = []
        for part, pieces in zip(parts, split, strict=True):
            values = self._plain(pieces[0], known)
            for k in range(1, len(part), 2):  # a special string is one token, but each of its prefixes is plain text
                total = values[-1] if values else 0
                start = len(values) - len(part[k - 1].encode())
                base = values[start - 1] if start else 0
                inside = self._plain(self.split.findall(part[k - 1] + part[k][:-1]), known)
                values += [base + c for c in inside[len(part[k - 1].encode()) :]]
                values.append(total + 1)
                values += [total + 1 + c for c in self._plain(pieces[(k + 1) // 2], known)]
            out.append(values)
        return out

    def count(self, text: str) -> int:
        return (self.resolve([text])[0] or [0])[-1]

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For texts end to end: each unit's row in the table, tokens before each unit (and after the last), each text's range of units."""
        starts = unit_starts(data, offsets)
        rows = self.table.lookup(data, starts, np.append(starts[1:], len(data)))
        return rows, np.concatenate([[0], np.cumsum(self.table.last(rows), dtype=np.int64)]), np.searchsorted(starts, offsets)

    def totals(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        _, before, unit_of = self._units(data, offsets)
        return np.diff(before[unit_of])

    def prefixes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each text's first 1, 2, 3, ... characters, end to end, and where each text's begin (one more at the end)."""
        rows, before, unit_of = self._units(data, offsets)
        counts, lengths = self.table.values(rows)
        counts = counts + np.repeat(before[:-1], lengths) - np.repeat(before[unit_of[:-1]], np.diff(offsets))
        ends = np.ones(len(data), bool)
        ends[:-1] = (data[1:] & 0xC0) != 0x80
        return counts[ends], np.concatenate([[0], np.cumsum(ends)])[offsets]


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def _slim(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))


def token_counts(docs: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit. No shuffle; a row's counts come from its own text only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                n = c.totals(data, offsets)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return _slim(docs, doc_id, text).mapInArrow(work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def token_prefixes(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored form: doc_id, n_tokens, and steps: how much each character adds to the token count of the prefix that it
    ends, as little-endian 16-bit numbers (a character may also make it smaller)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                counts, at = c.prefixes(data, offsets)
                steps = np.diff(counts, prepend=0)
                first = at[:-1][np.diff(at) > 0]
                steps[first] = counts[first]  # every text begins anew
                if len(steps) and np.abs(steps).max() >= 1 << 15:
                    raise OverflowError("a character changes the count by more than 16 bits hold")
                raw = steps.astype("<i2").tobytes()
                rows = [raw[2 * s : 2 * e] for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                totals = np.where(np.diff(at) > 0, counts[np.maximum(at[1:], 1) - 1] if len(counts) else 0, 0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(totals, pa.int64()), pa.array(rows, pa.binary())], ["doc_id", "n_tokens", "steps"])

    return _slim(docs, doc_id, text).mapInArrow(work, "doc_id long, n_tokens long, steps binary")


def _from_steps(prefixes: DataFrame, schema: str, answer: Callable[[np.ndarray], tuple[int, int]]) -> DataFrame:
    """answer: from the counts of a text's first 0, 1, 2, ... characters the row's other two columns."""
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [answer(np.concatenate([[0], np.cumsum(np.frombuffer(x.as_buffer(), "<i2"), dtype=np.int64)])) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names)

    return prefixes.select("doc_id", "steps").mapInArrow(work, schema)


def count_at(prefixes: DataFrame, n_chars: int) -> DataFrame:
    """From stored prefixes: the exact tokens of each text's first n_chars characters (all, if it has fewer)."""
    return _from_steps(prefixes, "doc_id long, n_chars long, n_tokens long", lambda c: (min(n_chars, len(c) - 1), int(c[min(n_chars, len(c) - 1)])))


def cut_points(prefixes: DataFrame, budget: int) -> DataFrame:
    """From stored prefixes: the most characters from the start whose exact token count is within the budget."""

    def longest(counts: np.ndarray) -> tuple[int, int]:
        k = int(np.flatnonzero(counts <= budget)[-1])
        return k, int(counts[k])

    return _from_steps(prefixes, "doc_id long, n_kept_chars long, n_kept_tokens long", longest)
