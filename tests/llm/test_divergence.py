"""The audit of sources against plain integer arithmetic over all terms and pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from roadloom.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups.add((lang, source))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = [s for g, s in groups if g == lang]
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})
        p = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept}
        of, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(of[s][t], of[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(-f(of[s][t], q[t]), t) for t in kept if counts[lang, s][t] and of[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:10])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


def corpus(seed):
    r = random.Random(seed)
    words = ["the", "The", "Éa", "ß", "x1y", "語", "of", "d'or", *[f"w{chr(97 + k)}{chr(97 + j)}" for k in range(9) for j in range(9)]]
    rows = []
    for _ in range(400):
        lang, source = r.choice(["en", "en", "de", None, ""]), r.choice(["hot"] * 9 + [f"s{k}" for k in range(21)] + [None, "é"])
        rows.append((" ".join(r.choices(words, [1 / (k + 1) for k in range(len(words))], k=r.randrange(0, 60))), lang, source))
    rows += [(None, "en", "only null"), ("", "fr", "a"), ("rare words", "fr", "b"), ("rare", "fr", None), rows[0], rows[0], ("long " * 5000, "en", "s1")]
    return rows


def run(spark, rows):
    df = spark.createDataFrame([(*r, k, "x") for k, r in enumerate(rows)], "text string, lang string, source string, n long, term string")
    return sorted(tuple(r) for r in divergence.audit(df).collect())


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed, monkeypatch):
    rows = corpus(seed)
    monkeypatch.setattr(divergence, "SHARD", 16)  # several shards and blocks: every turn of the tournament is played
    monkeypatch.setattr(divergence, "BLOCK", 3 + seed)
    monkeypatch.setattr(divergence, "TURNS", 2)
    assert run(spark, rows) == brute(rows, 10)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_shares_are_exact_beyond_64_bits():
    for count, total, kept in ((0, 0, 1), (10**13, 10**15, 10**9), (8 * 10**15, 8 * 10**15, 5), (7, 11, 3)):
        assert int(divergence.share(np.array([count]), total, kept)[0]) == 1 + 10**9 * (count + 2) // (total + 2 * kept)
    with pytest.raises(OverflowError):
        divergence.share(np.array([1]), 10**16, 1)
