"""DuckDB SQL of the queries that SQL can express."""
from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op4_winnowing_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT item_id, w, least(13, len(w)) AS m FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, m, array_to_string(w[k:k + m - 1], ' ') AS s
       FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM i)),
dw AS (SELECT r, m, k, array_to_string(w[k:k + m - 1], ' ') AS s
       FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS k
             FROM d, (SELECT DISTINCT m FROM i) WHERE len(w) >= m)),
h AS (SELECT r, k, m, item_id FROM dw JOIN iw USING (m, s)),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(k, k + m)) AS p FROM h) GROUP BY r),
t AS (SELECT r, list_sort(list(DISTINCT item_id)) AS items FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""

#: {documents} is the table or query that is mixed.
MIXING = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM {documents}),
placed AS (
  SELECT *, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
    CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
      % (SELECT greatest(1, CAST(ceil(sqrt(count(*))) AS BIGINT)) FROM sizes) AS shard FROM sizes),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM totals),
levels AS (
  SELECT *, 2 * source_size AS cap, 2 * source_size / weight AS ratio,
    CAST(sum(source_size) OVER () AS BIGINT) * CAST(1.5 AS DOUBLE) AS wanted FROM weighed),
filled AS (
  SELECT *, (wanted - coalesce(CAST(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
    / CAST(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM levels),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), coalesce((
    SELECT arg_min(level, level_rank) FROM (SELECT level, row_number() OVER (ORDER BY ratio, source NULLS LAST) AS level_rank, ratio FROM filled)
    WHERE level <= ratio), 0) * weight) AS target FROM filled),
voting AS (
  SELECT *, target AS votes, CAST(round(sum(target) OVER () / 64) AS BIGINT) AS seats, sum(target) OVER () AS total FROM targets),
based AS (
  SELECT *, greatest(CAST(floor(CASE WHEN total > 0 THEN votes * seats / total ELSE 0 END) AS BIGINT) - 3, 0) AS base FROM voting),
steps AS (
  SELECT *, seats - sum(base) OVER () AS remaining, unnest(range(0, 7)) AS step FROM based),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY votes / (2 * (base + step) + 1) DESC, source NULLS LAST) AS place
  FROM (SELECT source, source_size, target, votes, base, step, seats - (SELECT sum(base) FROM based) AS remaining FROM steps)),
dealt AS (
  SELECT source, source_size, target, CAST(least(any_value(base) + sum(CASE WHEN place <= remaining AND votes > 0 THEN 1 ELSE 0 END),
    ceil(source_size / 64) * 2) AS BIGINT) AS seats FROM ranked GROUP BY source, source_size, target),
shards AS (SELECT source, shard, CAST(sum(size) AS BIGINT) AS shard_size FROM placed GROUP BY source, shard),
begun AS (
  SELECT *, coalesce(CAST(sum(shard_size) OVER (PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS b0
  FROM shards),
grid AS (
  SELECT g.*, CAST(ceil(b0 / 64) AS BIGINT) AS f, CAST(ceil((b0 + shard_size) / 64) - ceil(b0 / 64) AS BIGINT) AS nb,
    source_size, target, seats FROM begun g JOIN dealt d ON g.source IS NOT DISTINCT FROM d.source),
grid2 AS (SELECT *, sum(nb) OVER (PARTITION BY source) AS total FROM grid),
grid3 AS (SELECT *, greatest(CAST(floor(CASE WHEN total > 0 THEN nb * seats / total ELSE 0 END) AS BIGINT) - 3, 0) AS base FROM grid2),
grid4 AS (SELECT *, seats - sum(base) OVER (PARTITION BY source) AS remaining FROM grid3),
grid5 AS (SELECT *, unnest(range(0, 7)) AS step FROM grid4),
grid6 AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY nb / (2 * (base + step) + 1) DESC, shard) AS place FROM grid5),
quotas AS (
  SELECT source, shard, b0, f, nb, source_size, target,
    CAST(any_value(base) + sum(CASE WHEN place <= remaining AND nb > 0 THEN 1 ELSE 0 END) AS BIGINT) AS quota
  FROM grid6 GROUP BY source, shard, b0, f, nb, source_size, target),
turned AS (
  SELECT *, CASE WHEN nb > 0 THEN quota // nb ELSE 0 END AS full_n, CASE WHEN nb > 0 THEN quota % nb ELSE 0 END AS rest,
    CASE WHEN nb > 0 THEN CAST('0x' || substr(md5('mix-1:' || coalesce(source, '') || ':' || shard), 1, 8) AS BIGINT) % nb ELSE 0 END AS turn
  FROM quotas),
lasts AS (
  SELECT *, CASE WHEN nb > 0 THEN full_n + CASE WHEN (nb - 1 - turn) % nb < rest THEN 1 ELSE 0 END END AS last_n FROM turned),
heads AS (
  SELECT *, coalesce(last_value(last_n IGNORE NULLS) OVER (PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS head
  FROM lasts),
streamed AS (
  SELECT *, coalesce(CAST(sum(size) OVER (PARTITION BY source, shard ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS l0
  FROM placed),
sited AS (
  SELECT s.doc_id, s.size, h.*, greatest(0, least(l0 + size, f * 64 - b0) - l0) AS head_words,
    greatest(b0 + l0 - f * 64, 0) AS a, greatest(b0 + l0 + size - f * 64, 0) AS b
  FROM streamed s JOIN heads h ON s.source IS NOT DISTINCT FROM h.source AND s.shard = h.shard)
SELECT doc_id, size, source_size, target, CAST(head * head_words + full_n * (b - a)
  + least(greatest(b - turn * 64, 0), rest * 64) + least(b, greatest((turn + rest - nb) * 64, 0))
  - least(greatest(a - turn * 64, 0), rest * 64) - least(a, greatest((turn + rest - nb) * 64, 0)) AS BIGINT) AS taken
FROM sited
"""
SQL["op8_sainte_lague_mixing"] = MIXING.replace("{documents}", "documents")

SQL["op10_ngram_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS overlap FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id WHERE 100 * overlap >= 90 * (p.n + q.n - overlap)),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS c FROM r GROUP BY x) m USING (doc_id)
"""

SQL["op3_warc_bundles"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT digest, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (digest)
"""

SQL["op9_bounded_repeats"] = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 200) AS g
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200)),
f AS (SELECT g, min((doc_id, i)) AS first_place, count(*) AS n FROM s GROUP BY g HAVING count(*) > 1),
r AS (SELECT doc_id, i FROM s JOIN f USING (g) WHERE (doc_id, i) > first_place),
p AS (SELECT doc_id, i, i - 100 > lag(i) OVER (PARTITION BY doc_id ORDER BY i) OR lag(i) OVER (PARTITION BY doc_id ORDER BY i) IS NULL AS opens FROM r),
g AS (SELECT doc_id, i, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM p),
x AS (SELECT doc_id, span, min(i) AS b, max(i) + 100 AS e FROM g GROUP BY doc_id, span),
k AS (SELECT x.doc_id, span, b, e, h, coalesce(lag(e) OVER (PARTITION BY x.doc_id ORDER BY b), 0) AS past FROM x JOIN d ON x.doc_id = d.doc_id),
c AS (SELECT doc_id, CAST(sum(e - b) AS BIGINT) AS n_removed, count(*) AS n_spans,
        string_agg(substr(h, CAST(2 * past + 1 AS BIGINT), CAST(2 * (b - past) AS BIGINT)), '' ORDER BY b)
        || substr(any_value(h), CAST(2 * max(e) + 1 AS BIGINT)) AS left_h FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(left_h, d.h))) AS kept_sha256
FROM d LEFT JOIN c ON d.doc_id = c.doc_id
"""

SQL["op11_rollup_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM (
    SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS s FROM documents)),
t AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS k FROM p),
f AS (
  SELECT lang, m, w[k:k + m - 1] AS words, count(*) AS f FROM t, (SELECT unnest([1, 2, 3]) AS m) WHERE k + m - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, words, f AS a FROM f WHERE m > 1 AND f >= 10),
x AS (
  SELECT c.lang, c.words, c.m, a, k, l.f AS l, r.f AS r, CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
  JOIN f l ON l.lang = c.lang AND l.words = c.words[1:k] JOIN f r ON r.lang = c.lang AND r.words = c.words[k + 1:]),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
kept AS (
  SELECT y.*, array_to_string(words, ' ') AS phrase FROM y WHERE NOT EXISTS (
    SELECT 1 FROM c o WHERE o.lang = y.lang AND o.m = 3 AND y.m = 2 AND 100 * o.a >= 50 * y.a AND (o.words[1:2] = y.words OR o.words[2:3] = y.words))),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= 2000
"""

#: CRC-32 by its table, as the engine has no function for it; characters here are ASCII or U+00C0 to U+00FF.
SQL["op12_qchunk_spelling"] = r"""
WITH RECURSIVE steps AS (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
    lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) t(i)),
crc AS (SELECT list(c ORDER BY i) AS crc FROM steps),
r AS (
  SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents) WHERE length(run) >= 6 GROUP BY ALL),
h AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(s, ''),
      lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, ord(c) - 64] END))),
    lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1])), 4294967295) AS h FROM r, crc),
w AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h)
  GROUP BY word HAVING sum(n) >= 5 AND length(word) >= 6),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM d a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM d a JOIN w b ON a.rest = b.word),
q AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM p GROUP BY word),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
  FROM w LEFT JOIN q USING (word)),
g AS (
  SELECT word, word AS root, form AS up FROM f UNION ALL SELECT g.word, f.word, f.form FROM g JOIN f ON g.up = f.word)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN g ON f.word = g.word AND g.up IS NULL
"""
