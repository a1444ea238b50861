"""Secrets in texts: three fixed patterns, and tokens that a battery of randomness tests tells from words; SQL functions only.

Base spans are the matches of `KINDS`, leftmost and without overlap per kind; a match whose secret part is too short is used
up but dropped. Candidates for further spans are runs of `CANDIDATE` outside of them (a run that touches an assignment, holds
another base span, or stands next to a NUL character is none). A candidate's encoding is the smallest of `ENCODINGS` that its
characters fit; separators do not count where the rest is of one of the first encodings (as in a UUID). Its symbols' numbers
s then go through three tests of the claim that they are independent and uniform:

 * chi-squared of the symbol counts, as a normal value by the cube root of chi-squared / df, both tails (too even is odd, too);
 * runs of symbols of the upper and the lower half of the alphabet (Wald and Wolfowitz, with a half off for continuity);
 * serial correlation of neighbours, with Moran's exact mean and variance.

Fisher's sum joins the three p-values to one, p, which is uniform for random tokens and near 0 for words, names and paths.
The mean and variance of all three depend on the length. Which candidates are told as secrets is a matter of false discovery:
in each stratum of encoding and length, the tokens with p >= `SURE` tell how many random ones there are, r (that many over
1 - `SURE`), so of the m tokens at or above a threshold t all but r * (1 - t) are false. The stratum's threshold is the least of `GRID` at which that
share is at most `FALSE`; it is taken from all documents, where a token that
repeats counts once, and a stratum's counts are eked out by `WEIGHT` tokens
spread as the whole corpus' are and one of no evidence, so that small strata borrow and a lone token proves nothing. A stratum
without such a threshold adds no span.

Counts by stratum and p are a table of fixed size: encodings times lengths in steps of the square root of two times 100.
Null text counts as empty; rows are told one by one, also repeated ones and those of null ids. Positions count code points.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Durable

#: Kind, pattern, group that is measured, its least length.
KINDS = (
    ("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)
#: The same matches for the last two kinds, but only those long enough: there a short match never hides a longer one.
LONG_ENOUGH = {"access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
CANDIDATE = "[A-Za-z0-9+/_=\\x00-]{20,}"
DIGITS, UPPER, SMALL = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encodings by rising size: name, alphabet in order.
ENCODINGS = (
    ("decimal", DIGITS),
    ("hex", DIGITS + "abcdef"),
    ("HEX", DIGITS + "ABCDEF"),
    ("base32", UPPER + "234567"),
    ("base36", DIGITS + SMALL),
    ("BASE36", DIGITS + UPPER),
    ("base62", DIGITS + UPPER + SMALL),
    ("base64", UPPER + SMALL + DIGITS + "+/"),
    ("base64url", UPPER + SMALL + DIGITS + "-_"),
)
#: Encodings that may be broken up by separators.
BROKEN = ("decimal", "hex", "HEX")
#: Accepted share of false discoveries; thresholds and the p above which only random tokens lie (hundredths); borrowed tokens.
FALSE, GRID, SURE, WEIGHT = 0.1, (1, 10), 30, 5.0


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def before(values: Column) -> Column:
    """For each of an array of whole numbers the sum of all before it. Sums of blocks of about the root of the length first,
    so that n values take n**1.5 steps."""
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)

    def blocks(size: Column) -> Column:
        count = F.ceil(F.size(values) / size).cast("int")
        sums = F.transform(F.sequence(F.lit(0), count - 1), lambda b: total(F.slice(values, b * size + 1, size)))
        heads = bound(sums, lambda s: F.transform(s, lambda _, b: total(F.slice(s, F.lit(1), b))))
        return bound(heads, lambda h: F.transform(values, lambda _, i: F.get(h, (i / size).cast("int")) + total(F.slice(values, i - i % size + 1, i % size))))

    made = bound(F.greatest(F.ceil(F.sqrt(F.size(values))).cast("int"), F.lit(1)), blocks)
    return F.when(F.size(values) > 0, made).otherwise(F.array().cast("array<bigint>"))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """start, end, hit (the whole match) and part (the group) of all matches, leftmost first."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string,part:string>>")

    def told(hits: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), lambda g: F.length(g).cast("long"))
        parts = F.regexp_extract_all(text, F.lit(pattern), group) if group else hits

        def placed(starts: Column) -> Column:
            row = lambda x, i: F.struct(F.get(starts, i).alias("start"), (F.get(starts, i) + F.length(x)).alias("end"), x.alias("hit"))
            rows = F.transform(hits, row)
            return F.zip_with(rows, parts, lambda r, p: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["hit"].alias("hit"), p.alias("part")))

        # a start is all gaps up to its own and all earlier matches
        step = lambda g: F.transform(hits, lambda x, i: F.length(x).cast("long") + F.get(g, i))
        return bound(gaps, lambda g: bound(before(step(g)), lambda b: placed(F.zip_with(b, g, lambda x, y: x + y))))

    return F.when(text.rlike(pattern), bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), told)).otherwise(none)


def base_spans(text: Column) -> Column:
    """start, end, kind (number in KINDS) of all base spans."""

    def of(number: int) -> Column:
        kind, pattern, group, least = KINDS[number]
        good = F.filter(matches(text, LONG_ENOUGH.get(kind, pattern), group), lambda m: F.length(m["part"]) >= least)
        return F.transform(good, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(number).alias("kind")))

    return F.concat(*[of(number) for number in range(len(KINDS))])


def masked(text: Column) -> Column:
    """The text with NUL characters for all of each assignment that counts, at the same places."""
    _, pattern, group, least = KINDS[0]

    def cover(hits: Column) -> Column:
        pieces = F.zip_with(hits, F.regexp_extract_all(text, F.lit(pattern), group), lambda h, p: F.when(F.length(p) >= least, F.repeat(F.lit("\0"), F.length(h))).otherwise(h))
        return F.array_join(F.zip_with(F.split(text, pattern, -1), pieces, lambda g, h: F.concat(g, F.coalesce(h, F.lit("")))), "")

    return F.when(text.rlike(pattern), bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), cover)).otherwise(text)


def candidates(text: Column) -> Column:
    """start, end, hit of the tokens that the tests judge."""
    free = lambda m: ~(m["hit"].contains("\0") | m["hit"].rlike(LONG_ENOUGH["access"]) | m["hit"].rlike(LONG_ENOUGH["hex"]))
    return bound(masked(text), lambda t: F.filter(matches(t, CANDIDATE), free))


def encoding(token: Column) -> Column:
    """number of the encoding, and the symbols' string (size, alphabet follow from the number)."""
    solid, bare = F.regexp_replace(token, "[-_=]", ""), F.rtrim(token, F.lit("="))
    choice = F.when(F.lit(False), F.lit(None).cast("struct<code:int,body:string>"))
    for code, (name, alphabet) in enumerate(ENCODINGS):
        body = solid if name in BROKEN else bare
        choice = choice.when(F.length(body).between(16, 1 << 30) & (F.length(F.translate(body, alphabet, "")) == 0), F.struct(F.lit(code).alias("code"), body.alias("body")))
    return choice


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal value, to 1e-7: Abramowitz and Stegun 26.2.17, a fixed approximation."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(code: Column, body: Column) -> Column:
    """p of a token under the claim that its symbols are independent and uniform."""
    alphabet = F.get(F.array(*[F.lit(a) for _, a in ENCODINGS]), code)
    k = F.get(F.array(*[F.lit(float(len(a))) for _, a in ENCODINGS]), code)
    total = lambda xs, f: F.aggregate(xs, F.lit(0.0), lambda a, x: a + f(x))
    least = lambda p: F.greatest(p, F.lit(1e-12))
    both_tails = lambda z: 2 * upper_tail(F.abs(z))

    def tested(v: Column) -> Column:
        s, n, k, text = v["s"], v["n"], v["k"], v["text"]
        neighbours = F.sequence(F.lit(1), F.size(s) - 1)
        held = lambda j: F.length(text) - F.length(F.replace(text, F.substring(v["alphabet"], j, F.lit(1)), F.lit("")))
        squares = total(F.sequence(F.lit(1), k.cast("int")), lambda j: F.pow(held(j).cast("double"), F.lit(2)))
        df, chi = k - 1, squares * k / n - n
        even = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        high = lambda x: x >= k / 2
        n1 = total(s, lambda x: F.when(high(x), 1.0).otherwise(0.0))
        changes = total(neighbours, lambda i: F.when(high(F.get(s, i)) != high(F.get(s, i - 1)), 1.0).otherwise(0.0))
        mean = total(s, lambda x: x) / n

        def joined(w: Column) -> Column:
            expected = 2 * w["n1"] * (n - w["n1"]) / n + 1
            spread = (expected - 1) * (expected - 2) / (n - 1)
            lone = 2 * F.pow(F.lit(0.5), n)  # all symbols in one half, or all alike
            runs = F.when((w["n1"] == 0) | (w["n1"] == n), lone).when(spread <= 0, 1.0).otherwise(both_tails(F.greatest(F.abs(w["changes"] + 1 - expected) - 0.5, F.lit(0.0)) / F.sqrt(spread)))
            serial = F.when(w["around"] == 0, lone).otherwise(both_tails((w["along"] / w["around"] + 1 / n) * n * F.sqrt(n - 1) / (n - 2)))
            x = -(F.log(least(both_tails(w["even"]))) + F.log(least(runs)) + F.log(least(serial)))
            return bound(x, lambda y: F.exp(-y) * (1 + y + y * y / 2))

        def about(m: Column) -> Column:
            along = total(neighbours, lambda i: (F.get(s, i) - m) * (F.get(s, i - 1) - m))
            around = total(s, lambda x: (x - m) * (x - m))
            return bound(F.struct(even.alias("even"), n1.alias("n1"), changes.alias("changes"), along.alias("along"), around.alias("around")), joined)

        return bound(mean, about)

    symbols = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: (F.instr(alphabet, c) - 1).cast("double"))
    return bound(F.struct(symbols.alias("s"), F.length(body).cast("double").alias("n"), k.alias("k"), alphabet.alias("alphabet"), body.alias("text")), tested)


def judged(text: Column) -> Column:
    """start, end, key, stratum, p of all candidates that have an encoding."""
    known = F.filter(F.transform(candidates(text), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.xxhash64(m["hit"]).alias("key"), encoding(m["hit"]).alias("e"))), lambda m: m["e"].isNotNull())
    step = lambda body: F.floor(2 * F.log2(F.length(body).cast("double"))).cast("int")
    return F.transform(known, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["key"].alias("key"), (m["e"]["code"] * 100 + step(m["e"]["body"])).alias("stratum"), battery(m["e"]["code"], m["e"]["body"]).alias("p")))


def thresholds(found: DataFrame) -> DataFrame:
    """stratum, threshold (hundredths), from the counts of all different candidates; strata that reach none are left out."""
    bin_of = F.least(F.floor(F.col("p") * 100), F.lit(99)).cast("int").alias("bin")
    counts = found.select(F.inline("judged")).select("stratum", bin_of, "key").distinct().groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    at = F.explode(F.sequence(F.lit(0), F.least(F.col("bin"), F.lit(GRID[1])))).alias("t")
    sure = F.sum(F.when(F.col("bin") >= SURE, F.col("n")).otherwise(0))
    per = counts.groupBy("stratum").agg(sure.alias("sure"))
    above = counts.select("stratum", "n", at).groupBy("stratum", "t").agg(F.sum("n").alias("m"))
    corpus = above.groupBy("t").agg(F.sum("m").alias("corpus_m"))
    # the corpus' own shares, per token: one row each
    whole = counts.agg((sure / F.sum("n")).alias("corpus_sure"), F.sum("n").alias("corpus_n")).withColumn("t", F.explode(F.sequence(F.lit(GRID[0]), F.lit(GRID[1]))))
    rows = per.join(above, "stratum").join(corpus, "t").join(whole, "t")
    random = F.least((F.col("sure") + WEIGHT * F.col("corpus_sure")) / (1 - SURE / 100), F.col("m") + WEIGHT * F.col("corpus_m") / F.col("corpus_n"))
    m = F.col("m") + WEIGHT * F.col("corpus_m") / F.col("corpus_n") + 1
    false = 1 - random * (1 - F.col("t") / 100) / m
    return rows.where(false <= FALSE).groupBy("stratum").agg(F.min("t").alias("threshold"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: see the module's text."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = Durable(slim.select("doc_id", base_spans(F.col("text")).alias("base"), judged(F.col("text")).alias("judged")), "spans").df
    # one row for each stratum: at most encodings times length classes
    least = {r["stratum"]: r["threshold"] for r in thresholds(found).collect()}
    limit = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair]) if least else F.lit(None).cast("map<int,int>")
    secret = F.filter("judged", lambda m: F.floor(m["p"] * 100) >= F.coalesce(F.get(F.array(limit), F.lit(0))[m["stratum"]], F.lit(1000)))
    added = F.transform(secret, lambda m: F.struct(m["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), m["end"].alias("end")))
    base = F.transform("base", lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    names = F.array(*[F.lit(k[0]) for k in KINDS], F.lit("random"))
    text = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda m: F.concat_ws(":", F.get(names, m["kind"]), m["start"].cast("string"), m["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda m: m["kind"] == k)).cast("long")
    counts = [count(number).alias(f"n_{kind}") for number, (kind, *_) in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.concat(base, added)).alias("spans"))
