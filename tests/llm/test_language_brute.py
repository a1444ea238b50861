"""Naive Bayes by plain sums over single n-grams, in Python numbers."""

import math
import random
import zlib

import pytest
from roadloom.llm import language_id
from test_llm import DOCS

M32 = 0xFFFFFFFF
MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)


def grams(text, bits):
    """Buckets of all n-grams of 1 to 4 characters; runs of other characters than letters are one blank (none at the start)."""
    out, kept = [], []
    for c in text:
        if c.isalpha():
            kept.append(ord(c.lower()) if len(c.lower()) == 1 else ord(c))
        elif kept and kept[-1] != 32:
            kept.append(32)
    for order in range(4):
        for i in range(len(kept) - order):
            h = 0
            for c in kept[i : i + order + 1]:
                h = (h * 0x01000193 & M32) ^ c
            m = h * MULTIPLIERS[order] & M32
            out.append(((m ^ m >> 15) * 0x2C1B3C6D & M32) >> (32 - bits))
    return out


def brute(rows):
    learned = [r for r in rows if r[1] is not None and r[2] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    names, bits = sorted({r[2] for r in learned}), language_id.MOST_BITS
    counts = {x: {} for x in names}
    for _, text, lang, *_ in learned:
        for g in grams(text, bits):
            counts[lang][g] = counts[lang].get(g, 0) + 1
    total = {x: sum(c.values()) + 0.5 * (1 << bits) for x, c in counts.items()}
    out = {}
    for i, text, *_ in rows:
        if text is None or not any(c.isalpha() for c in text):
            out[i] = ("und", 0.0)
            continue
        found = grams(text, bits)
        logs = [math.log(sum(r[2] == x for r in learned) / len(learned)) + sum(math.log((counts[x].get(g, 0) + 0.5) / total[x]) for g in found) for x in names]
        best = max(range(len(names)), key=lambda k: (logs[k], -k))
        out[i] = (names[best], 1 / sum(math.exp((v - logs[best]) / math.sqrt(len(found))) for v in logs))
    return out


def test_predictions_against_brute_force(spark):
    r = random.Random(5)
    voices = {"en": "the and thing shower with", "de": "und der schön ist ZUCKER", "fr": "été le eaux que œuvre"}
    rows = []
    for i in range(160):
        lang = r.choice(list(voices))
        mixed = voices[lang].split() + (r.choice(list(voices.values())).split() if r.random() < 0.3 else [])
        rows.append((i, r.choice(["", " ", "12 "]) + "".join(r.choice(mixed) + r.choice([" ", ", ", "\n", " 7 "]) for _ in range(r.randint(1, 9))), lang if r.random() < 0.9 else None, "s", 0))
    rows += [(900, None, "en", "s", 0), (901, "4 5 !", "en", "s", 0), (902, "", None, "s", 0), (903, "日本 語 İı", None, "s", 0)]
    got = {g["doc_id"]: (g["lang_pred"], g["score"]) for g in language_id.identify(spark.createDataFrame(rows, DOCS)).collect()}
    for i, (lang, score) in brute(rows).items():
        assert got[i][0] == lang and math.isclose(got[i][1], score, rel_tol=1e-3, abs_tol=1e-6), i


def test_ties_go_to_the_first_language(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2][:80]
    rows = [(i, "same words here", ("zz", "aa")[k % 2], "s", 0) for k, i in enumerate(ids)] + [(9000, "words", None, "s", 0)]
    got = language_id.identify(spark.createDataFrame(rows, DOCS)).where("doc_id = 9000").first()
    assert got["lang_pred"] == "aa" and abs(got["score"] - 0.5) < 1e-9


def test_many_languages_share_the_matrix():
    assert [language_id.bucket_bits(n) for n in (0, 1, 64, 65, 512, language_id.MAX_LANGUAGES)] == [16, 16, 16, 15, 13, 8]
    assert all((1 << language_id.bucket_bits(n)) * n <= language_id.CELLS for n in range(1, language_id.MAX_LANGUAGES, 97))


def test_more_labels_than_the_matrix_holds_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    docs = spark.createDataFrame([(i, "text", f"l{i}", "s", 0) for i in range(8)], DOCS)
    with pytest.raises(ValueError):
        language_id.identify(docs)


def test_whole_texts_are_learned(spark):
    """What a text says after its first thousands of characters counts."""
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, "same " * 2000 + ("xqzw " * 200 if k % 2 else "vkjh " * 200), ("b", "a")[k % 2], "s", 0) for k, i in enumerate(ids)] + [(9000, "xqzw xqzw", None, "s", 0), (9001, "vkjh vkjh", None, "s", 0)]
    got = {g["doc_id"]: g["lang_pred"] for g in language_id.identify(spark.createDataFrame(rows, DOCS)).collect()}
    assert (got[9000], got[9001]) == ("a", "b")
