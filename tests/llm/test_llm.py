"""Operators against brute force, on small tables with nulls, empties, ties, repeats and extra columns."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from roadloom.llm import html_text, id_coder, language_id, max_score, mixing, multi_index, packing, prefix_tokens, recompress, simhash, token_files
from roadloom.llm.common import ship
from tokenizers import Tokenizer

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def corpus(seed=1, n=120):
    """Documents with near copies, shared passages, repeats and odd texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyzéü") for _ in range(r.randint(1, 7)))
    vocabulary = [word() for _ in range(300)]
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    texts = []
    for k in range(n):
        kind = r.random()
        if texts and kind < 0.25:
            t = (r.choice(texts) or "x").split(" ")
            for _ in range(r.randint(0, 2)):
                t[r.randrange(len(t))] = r.choice(vocabulary)
            t = " ".join(t)
        else:
            t = "".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\n", "  ", ", ", ".\n\n", "\t"]) for _ in range(r.randint(0, 150)))
            if kind < 0.45:
                t += " " + passage[r.randint(0, 60) :] + " " + t[:40]
        texts.append(t)
    texts += [None, "", " ", "\n\t ", "a", "a a", "a " * 400, ("b c " * 100), "<|endoftext|> x  <|endoftext|>", "don't you'll I'm", "日本 語 です。  テスト", "é  x   y", "12 345 6!?"]
    return [(3 * i + 1, t, r.choice(["en", "de", None]), r.choice(["s1", "s2", "s3", "é", None]), len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumnRenamed("n_chars", "n_chars").repartition(3).cache()


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_coder_round_trip_and_damage():
    r = np.random.default_rng(0)
    for n, top in [(0, 1), (1, 1), (63, 5), (64, 50257), (65, 2), (5000, 300), (30000, 50257)]:
        ids = r.integers(0, top, n)
        block = id_coder.encode(ids)
        assert (id_coder.decode(block) == ids).all()
    skewed = (r.zipf(1.5, 40000) % 50000).astype(int)
    block = id_coder.encode(skewed)
    assert (id_coder.decode(block) == skewed).all() and len(block) < 2 * len(skewed)
    hurt = bytearray(block)
    hurt[len(hurt) // 2] ^= 1
    with pytest.raises(ValueError):
        id_coder.decode(bytes(hurt))
    with pytest.raises(ValueError):
        id_coder.decode(block[:-2])


def test_token_files(spark, docs, rows):
    got = sorted(map(tuple, token_files.write_and_read(docs, BYTE).collect()))
    tokenizer, before, want = Tokenizer.from_file(BYTE), 0, []
    for doc_id, text, *_ in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((doc_id, before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        before += len(ids)
    assert got == want
    assert token_files.write_and_read(empty(spark), BYTE).count() == 0


def test_small_blocks_give_the_same_documents(docs):
    a = token_files.read_blocks(token_files.blocks_of(docs, BYTE).cache())
    b = token_files.read_blocks(token_files.blocks_of(docs, BYTE, block_ids=50).cache())
    assert sorted(a.collect()) == sorted(b.collect())


def test_token_counts(spark, docs, rows):
    tokenizer = Tokenizer.from_file(BYTE)
    got = {r["doc_id"]: tuple(r)[1:] for r in prefix_tokens.token_counts(docs, BYTE).collect()}
    for doc_id, text, *_ in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert got[doc_id] == (len((text or "").encode()), n, n > 512)
    assert prefix_tokens.token_counts(empty(spark), BYTE).count() == 0


def test_every_prefix_and_every_cut(spark, docs, rows):
    """The stored counts of all prefixes, and cuts and counts from them, against the library on each prefix by itself."""
    tokenizer = Tokenizer.from_file(BYTE)
    odd = ["x   y", "a \n\n b\n\nc", "we'll they're I've it's", "don't'll!'s", "!!<|endoftext|>x<|endoftext|><|endoftext|", " <|endo  <|endoftext|> ", "naïve café\u00a0\u3000x", "日本 語です", "aaaa" * 40, "-" * 200, "tokenization antidisestablishment", "'r 'l '", "é", " ", "\n \n"]
    texts = {10_000 + i: t for i, t in enumerate(odd)} | {r[0]: (r[1] or "")[:150] for r in rows[::4]}
    table = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(7_777, None, "x")], "doc_id long, text string, steps string")
    prefixes = prefix_tokens.token_prefixes(table, BYTE).cache()
    want = {}
    for r in prefixes.collect():
        text = texts.get(r["doc_id"], "")
        want[r["doc_id"]] = [0] + [len(e.ids) for e in tokenizer.encode_batch([text[: k + 1] for k in range(len(text))], add_special_tokens=False)]
        got = [0] + np.cumsum(np.frombuffer(r["steps"], "<i2")).tolist()
        assert got == want[r["doc_id"]] and r["n_tokens"] == got[-1], text
    for budget in (0, 3, 17):
        for r in prefix_tokens.cut_points(prefixes, budget).collect():
            counts = want[r["doc_id"]]
            k = max(i for i, n in enumerate(counts) if n <= budget)
            assert (r["n_kept_chars"], r["n_kept_tokens"]) == (k, counts[k])
    for r in prefix_tokens.count_at(prefixes, 9).collect():
        assert r["n_tokens"] == want[r["doc_id"]][r["n_chars"]] and r["n_chars"] == min(9, len(want[r["doc_id"]]) - 1)
    assert prefix_tokens.token_prefixes(empty(spark), BYTE).count() == 0


def test_long_words_take_linear_time():
    word = "pneumono" * 5000
    assert prefix_tokens.counter(BYTE).count(word) == len(Tokenizer.from_file(BYTE).encode(word, add_special_tokens=False).ids)


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home, sweet</a></li><li>About</li></ul></nav><div class="cookie-notice">We use cookies, many.</div>
<div id="sidebar"><p>Side text, with punctuation. And more.</p></div><!-- ad --><div class="ad">Buy this now, cheap.</div>
<article><h1>Head &amp; line</h1><p><b>First paragraph, with   some
text.<br>Same block &lt;ok&gt;<p>Second one; it is <a href=x>linked</a> a little.</p><div class="share">Share this</div><p>Short.</p></article>
<div class="comments"><p>A reader comment, long enough to look like text, truly.</p></div><form><p>Your name, please.</p></form><footer>&copy; 2020, all rights.</footer></body></html>"""


def test_main_text(spark):
    want = "Head & line\nFirst paragraph, with some text. Same block <ok>\nSecond one; it is linked a little.\nShort."
    assert html_text.main_text(PAGE) == want
    cut = PAGE[: PAGE.index("Short.") + 6]
    assert html_text.main_text(cut) == want
    for page in (None, "", "   ", "<html></html>", "<script>x", "<nav><p>menu</p></nav>", "<", "<p", "&#x;", "<div class="):
        assert isinstance(html_text.main_text(page), str)
    assert html_text.main_text("just text, no tags.") == "just text, no tags."
    deep = "<div>" * 3000 + "<p>deep text, here.</p>" + "</div>" * 3000
    assert html_text.main_text(deep) == "deep text, here."
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "y"), (2, "v", "", "z")], "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", want, len(want)), (2, None, "", 0), (2, "v", "", 0)], key=str)


def test_language(spark):
    r = random.Random(3)
    voices = {"en": ["the", "and", "thing", "shower", "with"], "de": ["und", "der", "schön", "ist", "zucker"], "fr": ["été", "le", "eaux", "que", "oui"]}
    rows = [(i, " ".join(r.choice(voices[lang]) for _ in range(12)), lang, "s", 0) for i in range(300) for lang in [r.choice(list(voices))]]
    rows += [(1000, None, "en", "s", 0), (1001, "123 !?", "en", None, 0), (1002, "", "en", "s", 0), (1003, "the and with " * 20000, None, "s", 0), (1003, "und der", "de", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang, *_ in rows[:300]}
    fold = [g for g in got if g["held_out"]]
    assert fold and all(zlib.crc32(str(g["doc_id"]).encode()) % 4 == 2 for g in fold)
    right = [g["lang_pred"] == truth[g["doc_id"]] for g in fold if g["doc_id"] in truth]
    assert sum(right) > 0.95 * len(right)
    assert {g["doc_id"]: (g["lang_pred"], g["score"]) for g in got if g["doc_id"] in (1000, 1001, 1002)} == {k: ("und", 0.0) for k in (1000, 1001, 1002)}
    assert all(0 <= g["score"] <= 1 for g in got)
    assert language_id.identify(empty(spark)).count() == 0
    none = spark.createDataFrame([(1, "abc", None, "s", 0)], DOCS)
    assert language_id.identify(none).first()["lang_pred"] == "und"
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3


def fingerprint(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, near):
    root = list(range(len(values)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]) and find(i) != find(j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def test_simhash(spark, docs, rows):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    prints = [fingerprint(t) for _, t, *_ in rows]
    root = groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert got == {r[0]: (f"{p:016x}", rows[k][0]) for r, p, k in zip(rows, prints, root, strict=True)}
    assert simhash.near_duplicates(empty(spark)).count() == 0
    odd = spark.createDataFrame([(None, "a b c", None, None, 0), (5, "a b c", None, None, 0), (5, "a b c", None, None, 0), (2, "A B C", None, None, 0)], DOCS)
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in simhash.near_duplicates(odd).collect()) == [(0, 0), (2, 2), (5, 2), (5, 2)]


def test_gray_index_and_forest():
    r = random.Random(5)
    values = {r.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1}
    for v in list(values)[:120]:
        values |= {v ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(3)}
    values = sorted(values)
    index = simhash.GrayIndex(np.array(values, np.uint64))
    q, v = index.near(np.array(values, np.uint64), 2)
    assert sorted(zip(q.tolist(), v.tolist(), strict=True)) == [(i, j) for i in range(len(values)) for j in range(len(values)) if (values[i] ^ values[j]).bit_count() <= 2]
    root = groups(values, lambda a, b: (a ^ b).bit_count() <= 2)
    assert simhash.forest(np.array(values, np.uint64)).tolist() == root


def test_crowded_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_LIMIT", 8)
    r = random.Random(6)
    base = r.getrandbits(64)
    values = {base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for _ in range(90)} | {r.getrandbits(64) for _ in range(60)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(s, i) for i, s in enumerate(signed)], "fp long, node long")).collect()
    root = groups(values, lambda a, b: (a ^ b).bit_count() <= 2)
    seen = groups(range(len(values)), lambda a, b, e={tuple(sorted(map(int, x))) for x in edges}: (min(a, b), max(a, b)) in e)
    assert seen == root


def nearest(rows, k, number, score):
    good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q % 20 == 0:
            best = sorted((-score(v, w), i) for i, w in good if i != q)[:k]
            out += [(q, n + 1, i, number(-s)) for n, (s, i) in enumerate(best)]
    return sorted(out)


def vectors(n=240, d=12, seed=7):
    r = random.Random(seed)
    rows = [(i, [round(r.gauss(0, 1), 2) for _ in range(d)]) for i in range(n)]
    rows[40] = (40, rows[41][1])
    rows[60] = (60, rows[61][1])
    return rows + [(n, None), (n + 20 - n % 20, [float("nan")] * d), (n + 41, [None] * d), (n + 42, [float("inf")] + [0.0] * (d - 1)), (n + 43, [])]


def test_max_score(spark):
    rows = vectors() + [(1000, [0.0] * 12)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = sorted(map(tuple, max_score.search(table, 20).collect()))
    whole = [(i, v and [x if x is None or not math.isfinite(x) else math.floor(64 * x) for x in v]) for i, v in rows]
    assert got == nearest(whole, 20, int, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert max_score.search(few).count() == 2
    assert max_score.search(few.limit(0)).count() == 0


@pytest.mark.parametrize("density", (1.0, 0.3, 0.02))
@pytest.mark.parametrize("slack", (0.25, 1.0))
def test_max_score_prunes_without_loss(density, slack):
    r = np.random.default_rng(2)
    kind = np.dtype("<i2")
    e, q = (r.integers(-20, 20, (n, 16)) * (r.random((n, 16)) < density) for n in (500, 7))
    q[0] = np.abs(q[0])
    rows = max_score.posting_rows(e.astype(float), kind)
    shard = max_score.Postings.read(16, np.arange(500), pd.DataFrame(rows, columns=["term", "entries", "weights", "low", "high"]), kind)
    assert density > 0.2 or shard.lists
    ids, scores = max_score.top(q.astype(float), np.arange(7), shard, 10, run=60, first_run=40, slack=slack)
    for i in range(7):
        s = e @ q[i]
        s[i] = -(10**9)
        want = np.lexsort((np.arange(500), -s))[:10]
        assert ids[i].tolist() == want.tolist() and scores[i].tolist() == s[want].tolist()


def test_max_score_reads_essential_lists_only():
    """Once thresholds stand, posting lists of terms that no query finds essential are left alone."""
    r = np.random.default_rng(3)
    e = np.concatenate([r.integers(50, 60, (400, 4)), r.integers(1, 2, (400, 28))], axis=1).astype(float)
    kind = np.dtype("<i2")
    shard = max_score.Postings.read(32, np.arange(400), pd.DataFrame(max_score.posting_rows(e, kind), columns=["term", "entries", "weights", "low", "high"]), kind)
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, tuple) and isinstance(at[1], slice):
                read.append(len(at[0]))
            return super().__getitem__(at)

    shard.full = shard.full.view(Watched)
    ids, _ = max_score.top(e[:5] * [1], np.arange(1000, 1005), shard, 3, run=100, first_run=100)
    assert read[0] == 32 and read[1:] and max(read[1:]) <= 4
    assert ids[0].tolist() == np.lexsort((np.arange(400), -(e @ e[0])))[:3].tolist()


def test_multi_index(spark):
    rows = vectors() + [(1000, [0.0] * 12), (1020, [3.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    padded = [(i, v and v + [0.0] * (12 - len(v))) for i, v in rows if i != 1000]
    want = nearest(padded, 20, float, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))
    got = sorted(map(tuple, multi_index.search(table, aim=1.0).collect()))  # an aim of all neighbours walks as far as it takes
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want, strict=True))
    assert multi_index.search(table.limit(0)).count() == 0


def test_walk_goes_by_falling_sums():
    r = np.random.default_rng(1)
    f, s, held = r.normal(size=9), r.normal(size=7), r.integers(0, 3, (9, 7))
    pairs = list(multi_index.walk(f, s, held, 1e9))
    sums = [f[i] + s[j] for i, j in pairs]
    assert sums == sorted(sums, reverse=True) and set(pairs) == set(zip(*np.nonzero(held), strict=True))
    few = list(multi_index.walk(f, s, held, 5))
    assert few == pairs[: len(few)] and sum(held[i, j] for i, j in few[:-1]) < 5 <= sum(held[i, j] for i, j in few)


@pytest.mark.parametrize("kind", ("sphere", "clusters", "norms"))
def test_multi_index_recall(spark, monkeypatch, kind):
    """Recall of the index as it stands; clustered vectors need to look at little."""
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 32))
    if kind == "clusters":
        x = 3 * r.normal(size=(40, 32))[r.integers(0, 40, 3000)] + 0.3 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "norms":
        x *= np.exp(r.normal(size=(3000, 1)))
    shares = []
    share = multi_index._share
    monkeypatch.setattr(multi_index, "_share", lambda *a: shares.append(share(*a)) or shares[-1])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for row in multi_index.search(table).collect():
        got.setdefault(row["query_id"], set()).add(row["vec_id"])
    s = x[::20] @ x.T
    s[np.arange(150), np.arange(0, 3000, 20)] = -np.inf
    hits = sum(len(got[20 * i] & set(np.argsort(-s[i])[:20].tolist())) for i in range(150))
    assert hits / (150 * 20) >= 0.9 and shares[0] < {"sphere": 0.9, "clusters": 0.2, "norms": 0.9}[kind], (hits / 3000, shares)


def test_packing(spark, docs, rows):
    out = packing.pack_documents(docs, WORD, capacity=64).collect()
    tokenizer, want = Tokenizer.from_file(WORD), []
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(doc_id, k // 64, k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k in range(0, len(ids), 64) for p in [ids[k : k + 64]]]
    assert sorted(tuple(r)[:5] for r in out) == sorted(want)
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= math.ceil(sum(r["length"] for r in out) / 64) + 1
    assert packing.pack_documents(empty(spark), WORD).count() == 0


def test_shards_and_turns(spark):
    r = random.Random(9)
    sizes = [r.choice([r.randint(1, 30), r.randint(1, 100)]) for _ in range(600)]
    pieces = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long").cache()
    out = packing.pack(pieces, 100, shard_pieces=150).collect()
    assert sorted(x["uid"] for x in out) == list(range(600))
    used = {}
    for x in out:
        used[x["sequence_id"]] = used.get(x["sequence_id"], 0) + sizes[x["uid"]]
    assert max(used.values()) <= 100 and len(used) <= math.ceil(sum(sizes) / 100) + 2
    again = packing.pack(pieces, 100, shard_pieces=150).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_genetic_operators_keep_every_piece():
    r = random.Random(8)
    sizes = [r.randint(1, 60) for _ in range(200)]
    population = packing.evolve([], sizes, 100, r, children=10)
    for bins in population:
        assert sorted(i for c in bins for i in c) == list(range(200))
        assert all(sum(sizes[i] for i in c) <= 100 for c in bins)


def triplets(r, n, capacity=1000):
    """Sizes of which three at a time fill a sequence exactly: best fit by falling size does badly on them."""
    out = []
    for _ in range(n):
        a = r.randint(380, 490)
        b = r.randint(250, (capacity - a) // 2)
        out += [a, b, capacity - a - b]
    return out


def test_crossover_beats_its_seeds(spark):
    for seed in range(3):
        sizes = triplets(random.Random(seed), 60)
        seeds = packing.evolve([], sizes, 1000, random.Random(1), children=0)
        better = packing.evolve([list(map(list, s)) for s in seeds], sizes, 1000, random.Random(1), children=300)
        assert 60 <= len(better[0]) <= len(seeds[0]) - 2
    # islands as the operator runs them
    pieces = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long")
    used = {r["sequence_id"] for r in packing.pack(pieces, 1000).collect()}
    assert len(used) < len(seeds[0])


def targets(sizes, weights, most=3):
    left, open_, out = sum(sizes.values()), dict(weights), {}
    while open_:
        share = left / sum(open_.values())
        full = [s for s in open_ if most * sizes[s] <= share * open_[s]]
        if not full:
            return out | {s: share * w for s, w in open_.items()}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
            del open_[s]
    return out


@pytest.mark.parametrize("seed", range(2))
def test_mixing(spark, seed):
    r = random.Random(seed)
    rows = [(i, "w " * int(r.expovariate(1 / 40)), None, r.choice(["a", "a", "a", "b", "é", "z", None]), 0) for i in range(900)]
    rows += [(5000, None, None, "a", 0), (5001, "", None, "only empty", 0), (5002, "x y", None, "tiny", 0), (5003, "x y", None, "tiny2", 0), (None, "x y z", None, "b", 0), (7, rows[7][1], None, rows[7][3], 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORDS.findall(text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = targets(sizes, {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)})
    taken = {}
    for g in got:
        assert g["source_size"] == sizes[g["source"]] and g["taken"] <= 3 * g["size"] and g["taken"] == g["copies"] * g["size"]
        assert math.isclose(g["target"], want[g["source"]], rel_tol=1e-9, abs_tol=1e-6)
        taken[g["source"]] = taken.get(g["source"], 0) + g["taken"]
    for s, t in want.items():
        largest = max(g["size"] for g in got if g["source"] == s)
        assert abs(taken[s] - t) <= largest
    assert sorted(map(str, mixing.mix(docs.repartition(7)).collect())) == sorted(map(str, got))
    again = [g for g in got if g["size"] and 0 < want[g["source"]] % sizes[g["source"]]]
    order_of = lambda g: g["copies"] - want[g["source"]] // sizes[g["source"]]
    short, long = ([order_of(g) for g in again if (g["size"] < 20) == small] for small in (True, False))
    assert sum(short) / len(short) > sum(long) / len(long)  # odds of their own: short documents are drawn more often
    mixed = mixing.apply(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(g["copies"] for g in got)
    assert mixing.mix(empty(spark)).count() == 0


def removed(rows, window=13):
    first, words = {}, {}
    for doc_id, text in rows:
        words[doc_id] = WORDS.findall(text or "")
        for p in range(len(words[doc_id]) - window + 1):
            key = tuple(words[doc_id][p : p + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = {}
    for doc_id, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < doc_id:
                gone |= set(range(p, p + window))
        out[doc_id] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_recompression(spark, seed):
    rows = corpus(seed, 150)
    docs = spark.createDataFrame(rows, DOCS)
    want = removed([r[:2] for r in rows])
    assert sum(n for _, n, _ in want.values()) > 500
    got = {r["doc_id"]: tuple(r)[1:] for r in recompress.digest(docs).collect()}
    assert got == {k: (n, g, hashlib.sha256(t.encode()).hexdigest()) for k, (n, g, t) in want.items()}


def test_recompression_rows(spark):
    a, b = " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(10, 60))
    rows = [(None, a, None, None, 0), (4, a, None, None, 0), (4, b, None, None, 0), (9, "x " + b + " y", None, None, 0), (10, None, None, None, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in recompress.digest(docs).collect())
    assert got == [(0, 40, 0), (4, 40, 0), (4, 50, 0), (9, 52, 50), (10, 0, 0)]
    out = recompress.apply(docs)
    assert out.columns == docs.columns and sorted(str(r["text"]) for r in out.where("doc_id = 9").collect()) == ["x y"]
    assert recompress.digest(empty(spark)).count() == 0


def test_symbols_follow_their_deciding_words():
    """Equal words in a symbol's range give the symbol again, whatever stands around."""
    r = np.random.default_rng(3)
    names = recompress._mix(r.integers(0, 12, 3000).astype(np.uint64))
    name, at, low, high = recompress.symbols(names, np.zeros(3000, np.int64))
    inner = (low >= 0) & (high <= 3000)
    assert inner.mean() > 0.9
    for k in np.flatnonzero(inner)[:300]:
        text = np.concatenate([recompress._mix(r.integers(0, 12, 50).astype(np.uint64)), names[low[k] : high[k]], recompress._mix(r.integers(0, 12, 50).astype(np.uint64))])
        n2, a2, l2, h2 = recompress.symbols(text, np.zeros(len(text), np.int64))
        hit = np.flatnonzero(a2 == 50 + at[k] - low[k])
        assert len(hit) == 1 and n2[hit[0]] == name[k] and l2[hit[0]] == 50 and h2[hit[0]] == 50 + high[k] - low[k]




def test_hashes_that_agree_are_verified(spark, monkeypatch):
    """With names so poor that unlike words share them, the second hash keeps unlike passages apart."""
    monkeypatch.setattr(recompress._Ranges, "of", (lambda of: lambda self, s, e: of(self, s, e) if self.sure else of(self, s, e) & np.uint64(7))(recompress._Ranges.of), raising=True)
    monkeypatch.setattr(recompress._Ranges, "__init__", (lambda init: lambda self, names, base=recompress._BASE: (init(self, names, base), setattr(self, "sure", base != recompress._BASE))[0])(recompress._Ranges.__init__))
    rows = corpus(3, 60)
    source = recompress._source(spark.createDataFrame(rows, DOCS), "doc_id", "text")
    data = "".join(r[1] or "" for r in rows).encode()
    w = recompress.Windows(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    words = WORDS.findall(data.decode())
    same, checks = {}, w.checks(w.place, w.place + 13)
    assert len(set(w.digest(w.place).tolist())) <= 8 and source.count() == len(rows)
    for p, c in zip(w.place.tolist(), checks.tolist(), strict=True):
        assert same.setdefault(c, tuple(words[p : p + 13])) == tuple(words[p : p + 13])


def test_clean_documents_keep_all_their_words(spark):
    """Documents lose words only where 13 in a row stand in an earlier one: shared phrases of 12 words and repeats inside one document stay."""
    r = random.Random(11)
    word = lambda: f"w{r.randrange(10**9)}"
    phrase, passage = [word() for _ in range(12)], [word() for _ in range(60)]
    rows = []
    for i in range(30):
        own = [word() for _ in range(80)]
        rows.append((i, " ".join(own[:40] + phrase + own[40:] + own[:40]), None, "s", 0))
    rows += [(100 + i, " ".join([word() for _ in range(20)] + passage + [word() for _ in range(20)]), None, "s", 0) for i in range(5)]
    got = {x["doc_id"]: x["n_removed"] for x in recompress.digest(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {i: 0 for i in range(30)} | {100: 0} | {100 + i: 60 for i in range(1, 5)}
