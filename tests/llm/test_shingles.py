"""The near-dedup stage of the pipeline against brute force over all pairs."""

import random
import re

import corpus_pipeline

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = WORDS.findall((text or "").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similar(a, b):
    return a == b or len(a & b) * 5 >= 4 * len(a | b)


def test_stage_takes_out_near_copies(spark):
    r = random.Random(7)
    texts = []
    for k in range(160):
        if texts and r.random() < 0.6:  # chains of near copies on both sides of the limit
            t = r.choice(texts).split(" ")
            for _ in range(r.randint(0, 4)):
                t[r.randrange(len(t))] = f"new{k}"
        else:
            t = [f"w{r.randrange(400)}" for _ in range(r.randint(3, 150))]
        texts.append(" ".join(t))
    texts += [None, "", " \n", "a", "A", "a b", "a b c d e f", "a b c d e g"]
    rows = [(2 * i + 5, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [(1000, "two rows of one id here", "en", "s", 1), (1000, "quite another text of that id", "en", "s", 2), (None, texts[0], "en", "s", 3), (None, texts[0], "en", "s", 3)]
    named = [x for x in rows if x[0] is not None]
    sets = [shingles(x[1]) for x in named]
    root = list(range(len(named)))
    for i in range(len(named)):
        for j in range(i):
            if root[i] != root[j] and similar(sets[i], sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    want = [named[k] for k in set(root)] + [x for x in rows if x[0] is None]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)
    assert len(want) < len(rows) - 40
    assert stage(spark, docs.limit(0), "").count() == 0


def test_prefix_pairs_lose_no_link(spark):
    from roadloom.llm import shingles as stage

    r = random.Random(11)
    passage = [f"p{k}" for k in range(40)]  # one crowd just about the limit, as many texts that only share the passage
    texts = {" ".join(passage[:k] + [f"x{r.randrange(9)}"] + passage[k + 1 :]) for k in range(40) for _ in range(3)}
    texts |= {" ".join(passage + [f"y{r.randrange(999)}" for _ in range(r.randint(1, 60))]) for _ in range(60)}
    texts |= {" ".join(f"z{r.randrange(5)}" for _ in range(r.randint(1, 12))) for _ in range(60)}
    sets = stage._sets(spark.createDataFrame([(t,) for t in sorted(texts)], "text string"))
    held = {x.s: frozenset(x.shingles) for x in sets.collect()}
    group = {s: k % 3 for k, s in enumerate(sorted(held))}
    left = spark.createDataFrame(list(group.items()), "s long, c long")
    found = {(x.a, x.b) for x in stage._prefix_pairs(left, sets.dropDuplicates(["s"])).collect()}
    every = [(a, b) for a in held for b in held if a < b and group[a] != group[b]]
    want = {(a, b) for a, b in every if similar(held[a], held[b])}
    assert want and want <= found and len(found) < len(every) / 4
    for a, b in every:  # the bitmaps never differ in more bits than the sets
        assert len(held[a] ^ held[b]) >= differing(stage, held[a], held[b])


def differing(stage, a, b):
    import numpy as np

    x, y = stage.parity_of([np.array(sorted(s), np.int64).view(np.uint64) for s in (a, b)]).view(np.uint64)
    return int(np.bitwise_count(x ^ y).sum())
