"""SQL for operators that it can express, as DuckDB runs it over the same tables."""

from __future__ import annotations

TOP_K = """WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.row <> c.row),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

# t: the table of a bytewise CRC-32; b: the bytes of id, colon and run; k: each word without one letter; p: pairs of words one edit apart
SPELLING = """WITH RECURSIVE t AS (SELECT list(c ORDER BY b) AS tab FROM (SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) AS c FROM (SELECT unnest(range(256)) AS b))),
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS of, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
d AS (SELECT of, run, count(*) AS times FROM r WHERE length(run) >= 7 GROUP BY ALL),
b AS (SELECT run, times, flatten(list_transform(string_split(of || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END)) AS bytes FROM d),
h AS (SELECT run, times, xor(list_reduce(bytes, lambda c, x: xor(tab[1 + (xor(c, x) & 255)], c >> 8), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM b, t),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM h),
v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
k AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS part FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM k a JOIN k b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
  UNION SELECT k.word, k.n, v.word, v.n FROM k JOIN v ON k.part = v.word UNION SELECT v.word, v.n, k.word, k.n FROM k JOIN v ON k.part = v.word),
f AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS best, max(other_n) AS best_n FROM p GROUP BY word),
g AS (SELECT v.word, v.n, coalesce(f.n_near, 0) AS n_near, CASE WHEN best_n >= 10 * v.n THEN best END AS form, CASE WHEN best_n >= 10 * v.n THEN best_n END AS form_n FROM v LEFT JOIN f ON v.word = f.word),
walk AS (SELECT word, word AS at FROM g UNION ALL SELECT walk.word, g.form FROM walk JOIN g ON walk.at = g.word WHERE g.form IS NOT NULL)
SELECT g.word, g.form, walk.at AS root, g.n, g.n_near, g.form_n FROM g JOIN walk ON g.word = walk.word JOIN g e ON walk.at = e.word WHERE e.form IS NULL"""

# k: kept terms; g: groups and, with no source, whole languages; d: every group's count of every kept term
DIVERGENCE = """WITH o AS (SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM o),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
g AS (SELECT DISTINCT lang, source FROM o UNION ALL SELECT DISTINCT lang, NULL FROM o),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term UNION ALL SELECT lang, NULL, term, count(*) FROM w GROUP BY lang, term),
d AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = k.lang AND c.term = k.term AND c.source IS NOT DISTINCT FROM g.source),
s AS (SELECT *, 1 + (1000000000 * CAST(n + 1 AS HUGEINT)) // (sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS p FROM d),
e AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(e.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN e ON e.lang = a.lang AND e.source = a.source AND e.item = b.source
  UNION ALL SELECT a.lang, a.source, 'term', a.term, (a.p - b.p) * (a.p - b.p) // b.p FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND b.source IS NULL WHERE a.n > 0 AND a.p > b.p AND a.source IS NOT NULL),
r AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, CAST(encode(item) AS BLOB)) AS INTEGER) AS rank FROM f)
SELECT * FROM r WHERE part = 'pair' OR rank <= 200"""

# w: words and lines; x: five-word windows that a text has twice or more; m: measures; v: rates in thousandths; q: quartiles of buckets by source, by language, of all
QUALITY = """WITH o AS (SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM o),
a AS (SELECT row, i, array_to_string(words[i:i + 4], ' ') AS part FROM (SELECT row, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
x AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, part) AS n FROM a) WHERE n > 1),
y AS (SELECT row, CAST(sum(least(5, i - before)) AS BIGINT) AS n FROM (SELECT row, i, lag(i, 1, -5) OVER (PARTITION BY row ORDER BY i) AS before FROM x) GROUP BY row),
m AS (SELECT w.row, doc_id, lang, source, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda z: length(z))), 0) AS BIGINT) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
  len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(y.n, 0) AS n_repeat_words FROM w LEFT JOIN y ON w.row = y.row),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
u AS (SELECT row, lang, source, unnest([{'rate': 'letters', 'got': word_chars, 'per': n_words, 'least': 250}, {'rate': 'symbols', 'got': n_symbols, 'per': n_words, 'least': 20},
  {'rate': 'lines', 'got': n_dup_lines, 'per': n_lines, 'least': 100}, {'rate': 'repeats', 'got': n_repeat_words, 'per': n_words, 'least': 50}], recursive := true) FROM b WHERE NOT base_failed),
v AS (SELECT *, ((1000 * got // per) >> greatest(0, length(bin(1000 * got // per)) - 7)) << greatest(0, length(bin(1000 * got // per)) - 7) AS bucket FROM u),
q AS (SELECT 2 - (grouping(lang, source) & 1) - (grouping(lang, source) >> 1) AS own, lang, source, rate, any_value(least) AS least, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3, count(*) AS n
  FROM v GROUP BY GROUPING SETS ((lang, source, rate), (lang, rate), (rate))),
l AS (SELECT 2 - own AS level, lang, source, rate, n, greatest(0, q1 - 3 * greatest(q3 - q1, least)) AS low, q3 + 3 * greatest(q3 - q1, least) AS high, max(n) OVER (PARTITION BY own, lang, source) AS n_docs FROM q),
j AS (SELECT v.row, v.rate, v.got, v.per, l.level, l.low, l.high FROM v JOIN l ON v.rate = l.rate AND l.n_docs >= CASE l.level WHEN 2 THEN 0 ELSE 64 END
  AND (l.level = 2 OR v.lang IS NOT DISTINCT FROM l.lang) AND (l.level > 0 OR v.source IS NOT DISTINCT FROM l.source) QUALIFY row_number() OVER (PARTITION BY v.row, v.rate ORDER BY l.level) = 1),
z AS (SELECT row, max(level) AS level, string_agg(rate, ' ' ORDER BY CASE rate WHEN 'letters' THEN 1 WHEN 'symbols' THEN 2 WHEN 'lines' THEN 3 ELSE 4 END) FILTER (
  WHERE (1000 * got > per * high AND CAST(1000 * got - per * high AS DOUBLE) * CAST(1000 * got - per * high AS DOUBLE) > CAST(16000 * per * greatest(high, 1) AS DOUBLE))
  OR (rate = 'letters' AND 1000 * got < per * low AND CAST(1000 * got - per * low AS DOUBLE) * CAST(1000 * got - per * low AS DOUBLE) > CAST(16000 * per * greatest(low, 1) AS DOUBLE))) AS failed FROM j GROUP BY row)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND z.failed IS NULL AS kept, z.level, CASE WHEN NOT base_failed THEN coalesce(z.failed, '') END AS failed FROM b LEFT JOIN z ON b.row = z.row"""

SQL = {"op3_top_k": TOP_K, "op11_spelling": SPELLING, "op12_divergence": DIVERGENCE, "op13_quality_rules": QUALITY}
