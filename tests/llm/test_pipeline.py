"""The whole pipeline over odd tables: empty ones, nulls, ties, repeats, very long texts, columns whose names clash."""

import random
import re

import corpus_pipeline
import pytest
from roadloom.llm import language_id, mixing, recompress, shingles
from test_llm import DOCS, corpus, empty, targets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CLASHES = ["copies", "copy", "mix_id", "mix_source", "mix_size", "kept_id", "kept_row", "row_hash", "places", "gone_id", "gone_row", "row", "score", "k", "share", "size"]


def through(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "").cache()
        out.append((name, docs))
    return out


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang or "en", s, n) for i, t, lang, s, n in corpus(4, 40)]
    rows += [(2, "word " * 60_000, "en", "s1", 300_000), (None, "a text without an id", None, None, 20), (rows[0][0], "another text of the same id", "en", "s2", 27), rows[1]]
    return rows


def test_every_stage_keeps_its_contract(spark, odd):
    docs = spark.createDataFrame(odd, DOCS).repartition(3)
    steps = dict(through(spark, docs))
    for name in ("language_id", "near_dedup", "substring_dedup", "mixing"):
        assert steps[name].schema.names == docs.columns
    letters = [r for r in odd if r[1] and any(c.isalpha() for c in r[1])]
    first = steps["language_id"].collect()
    assert sorted(str(r["text"]) for r in first) == sorted(r[1] for r in letters)
    assert {r["lang"] for r in first} <= {"en", "de"}
    second = steps["near_dedup"].collect()
    assert {r["doc_id"] for r in second} <= {r["doc_id"] for r in first} and len({(r["doc_id"], r["text"]) for r in second}) == len(second)
    third = steps["substring_dedup"].collect()
    assert [sorted(str(r["doc_id"]) for r in x) for x in (second, third)][0] == sorted(str(r["doc_id"]) for r in third)
    mixed = steps["mixing"].collect()
    sizes = {}
    for r in third:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORDS.findall(r["text"] or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    want, taken = targets(sizes, {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}), {}
    for r in mixed:
        taken[r["source"]] = taken.get(r["source"], 0) + len(WORDS.findall(r["text"] or ""))
    for s, t in want.items():
        largest = max((len(WORDS.findall(r["text"] or "")) for r in third if r["source"] == s), default=0)
        assert abs(taken.get(s, 0) - t) <= largest
    pieces = steps["packing"].collect()
    assert len({(r["doc_id"]) for r in pieces}) == len({r["doc_id"] for r in mixed})
    bins = {}
    for r in pieces:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 2048


def test_empty_tables_pass_all_stages(spark):
    assert all(df.count() == 0 for _, df in through(spark, empty(spark)))


def test_columns_with_clashing_names(spark):
    rows = [(i, f"some text with words number {i % 3} and a few more of them here", "en", "s", 5, *range(len(CLASHES))) for i in range(6)]
    docs = spark.createDataFrame(rows, DOCS + "".join(f", {c} long" for c in CLASHES))
    for step in (language_id.keep_identified, shingles.keep_first, recompress.apply, mixing.apply):
        out = step(docs)
        assert out.columns == docs.columns and out.count() > 0
        assert {tuple(r)[5:] for r in out.collect()} == {tuple(range(len(CLASHES)))}


def test_rows_of_one_id_are_told_apart(spark):
    rows = [(5, "one text of five words", None, "s", 0), (5, "quite another text is this", None, "s", 0), (5, "one text of five words", None, "s", 0), (4, "quite another text is this", None, "s", 0)]
    kept = shingles.keep_first(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(4, "quite another text is this"), (5, "one text of five words")]


def test_language_is_a_choice(spark):
    r = random.Random(2)
    voices = {"en": ["the", "and", "thing", "shower"], "de": ["und", "der", "schön", "zucker"]}
    rows = [(i, " ".join(r.choice(voices[lang]) for _ in range(12)), lang, "s", 0) for i in range(200) for lang in [r.choice(list(voices))]]
    rows += [(1000, "der schön und zucker der", None, "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = language_id.keep_identified(docs, languages=("de",)).collect()
    assert {r["doc_id"] for r in kept} == {i for i, _, lang, *_ in rows if lang != "en"} and {r["lang"] for r in kept} == {"de"}


def test_mixing_takes_equal_rows_one_by_one(spark):
    """Two equal rows of 50 words in one source and one of 100 in the other: the mix and its figures agree."""
    from roadloom.llm import mixing

    rows = [(1, "w " * 50, "x", "a", 9), (1, "w " * 50, "x", "a", 9), (2, "v " * 100, "x", "b", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _mix_id long")
    told = sorted((r["source"], r["copies"]) for r in mixing.mix(docs).collect())
    held = mixing.apply(docs)
    assert held.columns == docs.columns
    kept = [r["source"] for r in held.collect()]
    assert kept.count("a") == sum(n for s, n in told if s == "a") and kept.count("b") == sum(n for s, n in told if s == "b")
    assert [n for s, n in told if s == "a"] in ([0, 1], [1, 1], [1, 2], [0, 2])
