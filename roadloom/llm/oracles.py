"""DuckDB SQL for the queries whose rows SQL can express."""

from __future__ import annotations

#: Brute force over all pairs of a query and an entry.
MAX_SCORE = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: TRY_CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(v.e AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

#: Every window of 13 words by itself, told by its text.
RECOMPRESSION = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(words[p : p + 12], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM docs)
), firsts AS (
  SELECT k, min(doc_id) AS least FROM windows GROUP BY k HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, p + step AS place
  FROM (SELECT doc_id, p, unnest(range(13)) AS step FROM windows JOIN firsts USING (k) WHERE least < doc_id)
), places AS (
  SELECT doc_id, place, words[place] AS word FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS place FROM docs)
), kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

#: Every term of every group, every pair of sources.
DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), words AS (
  SELECT row, lang, source, unnest(words) AS term FROM docs
), kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), sizes AS (
  SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n, s.v, s.lang_total, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang) LEFT JOIN counts c USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, n, 1 + 1000000000 * (n + 2) // (total + 2 * v) AS p, 1 + 1000000000 * (lang_n + 2) // (lang_total + 2 * v) AS q FROM cells
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM rows
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

#: All runs of one to four words of all pieces.
COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, len, array_to_string(w[p : p + len - 1], ' ') AS phrase
  FROM (SELECT lang, w, len, unnest(range(1, len(w) - len + 2)) AS p FROM words, (SELECT unnest([1, 2, 3, 4]) AS len))
), counts AS (
  SELECT lang, len, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), totals AS (
  SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), candidates AS (
  SELECT lang, len, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE len > 1
), cuts AS (
  SELECT c.lang, c.len, c.phrase, c.a, c.w, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS tail
  FROM (SELECT *, unnest(range(1, len)) AS k FROM candidates) c
), scored AS (
  SELECT c.*, x.f AS l, y.f AS r, 2000000 * a // (x.f + y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_runs AS (
  SELECT lang, array_to_string(w[p : p + m - 1], ' ') AS phrase, a AS longer
  FROM (SELECT *, unnest(range(1, len - m + 2)) AS p FROM (SELECT *, unnest(range(2, len)) AS m FROM candidates))
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner_runs i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.longer >= 80 * b.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {"op8_max_score": MAX_SCORE, "op9_recompression": RECOMPRESSION, "op11_divergence": DIVERGENCE, "op12_collocations": COLLOCATIONS}
