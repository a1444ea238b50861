"""Collocations against plain counts of all runs of words."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from roadloom.llm import collocations
from roadloom.llm.collocations import Bitmaps, Tails

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        of = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals["und" if lang is None else lang] += len(words)
            for size in range(1, 5):
                of.update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + m] for p, a in found.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= 80 * f[p[i : i + m]]}
        rows_of = []
        for p, a in found.items():
            if p in gone:
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows_of.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed):
    r = random.Random(seed)
    words = ["New", "york", "a", "the", "of", "état", "d'or", "x y", "Ünion", "(b)", "rare" + str(seed)]
    rows = []
    for k in range(500):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\x0b"]) for _ in range(r.randrange(0, 40)))
        if k % 4 == 0:
            text += " in the united states of america today"
        rows.append((text, r.choice(["en", "en", "de", None])))
    return [*rows, (None, "en"), ("", "fr"), ("and " * 4000, "en"), ("the the the the the " * 30, None), (rows[0][0], "fr"), rows[1], rows[1]]


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed, monkeypatch):
    rows = corpus(seed)
    for name, value in (("CHUNK", 3000), ("PAIRS", 50), ("ENTRIES", 20)) if seed else ():
        monkeypatch.setattr(collocations, name, value)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, n long, phrase string")
    got = sorted(tuple(r) for r in collocations.mine(df, 30, 2000 if seed else 25).collect())
    assert got and got == brute(rows, 30, 2000 if seed else 25)


def test_empty_table(spark):
    assert collocations.mine(spark.createDataFrame([], "text string, lang string")).collect() == []


def test_crowded_bit_maps_lose_nothing(spark, monkeypatch):
    rows = corpus(3)
    small = collocations.bit_map
    monkeypatch.setattr(collocations, "bit_map", lambda keys, column: small(keys, column, 6))  # 64 bits: nearly all is let through
    df = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in collocations.mine(df).collect()) == brute(rows, 30, 2000)


def test_shift_and_popcount_cross_containers():
    word = np.array([0, 1] * 40)
    position = np.arange(80) + (np.arange(80) >= 33)  # a free position inside
    maps = Bitmaps.of(word, position)
    alike = np.zeros(2, np.int64)
    head, tail, count, grown = Tails(maps, alike).after(maps, alike)
    assert dict(zip(zip(head.tolist(), tail.tolist(), strict=True), count.tolist(), strict=True)) == {(0, 1): 39, (1, 0): 39}
    assert int(np.bitwise_count(grown.bits).sum()) == 78
