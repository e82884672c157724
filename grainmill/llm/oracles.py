"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

MODULUS = "18446744073709551616::HUGEINT"  # 2 to the 64th


def crc_table() -> list[int]:
    """The checksum of each byte value: eight shifts, with the reversed polynomial where a one falls out."""
    out = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


def sharding(shards: int) -> str:
    digit = "instr('0123456789ABCDEF', h[2 * i + {0}]) - 1"
    octet = f"CAST(({digit.format(1)}) * 16 + {digit.format(2)} AS BIGINT)"
    step = f"xor(c >> 8, {crc_table()}[(xor(c, x) & 255) + 1])"
    ones = "4294967295::BIGINT"
    ahead = "CAST(floor((ahead + 1) * (2147483648.0::DOUBLE / ((k >> 33) + 1)::DOUBLE)) AS BIGINT)"
    return f"""
WITH RECURSIVE chars AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(hex(encode(coalesce(text, ''))), '') AS h FROM documents
), bytes AS (
  SELECT doc_id, text, list_transform(range(strlen(text)), lambda i: {octet}) AS b FROM chars
), sums AS (
  SELECT doc_id, strlen(text) + 16 AS size, xor(list_reduce(b, lambda c, x: {step}, {ones}), {ones}) AS crc FROM bytes
), jump(shards, doc_id, key, place, ahead) AS (
  SELECT n, doc_id, (coalesce(doc_id, -1)::HUGEINT + {MODULUS}) % {MODULUS}, -1::BIGINT, 0::BIGINT
  FROM (SELECT DISTINCT doc_id FROM documents), (VALUES ({shards}), ({shards + 1})) v(n)
  UNION ALL
  SELECT shards, doc_id, k, ahead, {ahead}
  FROM (SELECT *, (key * 2862933555777941757::HUGEINT + 1) % {MODULUS} AS k FROM jump WHERE ahead < shards)
), places AS (
  SELECT doc_id, max(CASE WHEN shards = {shards} THEN place END)::INTEGER AS shard,
    max(CASE WHEN shards = {shards + 1} THEN place END)::INTEGER AS grown_shard
  FROM jump WHERE ahead >= shards GROUP BY doc_id
)
SELECT s.doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY s.doc_id) - 1 AS slot, grown_shard
FROM sums s JOIN places p ON s.doc_id IS NOT DISTINCT FROM p.doc_id"""


def divergence(min_df: int = 10, top: int = 10) -> str:
    share = "CAST(1 + (1000000000::HUGEINT * ({0} + 2)) // ({1} + 2 * {2}) AS BIGINT)"
    gap = "CAST(((p - q)::HUGEINT * (p - q)) // (p + q) AS BIGINT)"
    rank = "CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS INTEGER) AS rank"
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS uid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS runs
  FROM documents
), words AS (
  SELECT uid, lang, source, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT uid, lang, source, unnest(runs) AS run FROM docs)
), vocab AS (
  SELECT lang, term, count(*) AS l FROM words GROUP BY lang, term HAVING count(DISTINCT uid) >= {min_df}
), langs AS (SELECT lang, sum(l) AS n, count(*) AS v FROM vocab GROUP BY lang
), counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN vocab USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source
), dense AS (
  SELECT s.lang, s.source, v.term, coalesce(c.n, 0) AS n, {share.format("coalesce(c.n, 0)", "s.n", "l.v")} AS p,
    {share.format("v.l", "l.n", "l.v")} AS q
  FROM sizes s JOIN vocab v ON v.lang = s.lang JOIN langs l ON l.lang = s.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = v.term
), gaps AS (
  SELECT lang, source, item, sum({gap}) AS value
  FROM (SELECT a.lang, a.source, b.source AS item, a.p, b.p AS q FROM dense a JOIN dense b
        ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source)
  GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(g.value, 0) AS BIGINT) AS value
  FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
), terms AS (SELECT lang, source, term AS item, {gap} AS value FROM dense WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value, {rank} FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, {rank} FROM terms) WHERE rank <= {top}"""


def spelling(min_length: int = 7, min_count: int = 2, ratio: int = 10, spare: int = 31) -> str:
    digit = "instr('0123456789ABCDEF', h[2 * i + {0}]) - 1"
    octet = f"CAST(({digit.format(1)}) * 16 + {digit.format(2)} AS BIGINT)"
    step = f"xor(c >> 8, {crc_table()}[(xor(c, x) & 255) + 1])"
    ones = "4294967295::BIGINT"
    upper = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
    return rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, {upper}, lower({upper})) AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {min_length} GROUP BY ALL
), chars AS (
  SELECT run, n, string_split(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '') AS h FROM runs
), bytes AS (
  SELECT run, n, list_transform(range(len(h) // 2), lambda i: {octet}) AS b FROM chars
), sums AS (
  SELECT run, n, xor(list_reduce(b, lambda c, x: {step}, {ones}), {ones}) AS crc FROM bytes
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN crc % {spare} = 0 THEN substr(run, 1, CAST(crc % length(run) AS BIGINT)) || substr(run, CAST(crc % length(run) AS BIGINT) + 2)
           ELSE run END AS word, n FROM sums)
  GROUP BY word HAVING length(word) >= {min_length} AND sum(n) >= {min_count}
), places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words
), holes AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM places
), shorter AS MATERIALIZED (
  SELECT DISTINCT h.word AS one, w.word AS two FROM holes h JOIN words w ON w.word = h.a || h.b
), near AS (
  SELECT x.word AS one, y.word AS two FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT one, two FROM shorter UNION ALL SELECT two, one FROM shorter
), best AS (
  SELECT one AS word, count(*) AS n_near, first(two ORDER BY w.n DESC, encode(two)) AS form, max(w.n) AS form_n
  FROM near JOIN words w ON w.word = two GROUP BY one
), chosen AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= {ratio} * w.n THEN b.form END AS form,
    CASE WHEN b.form_n >= {ratio} * w.n THEN b.form_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), chain(word, place) AS (
  SELECT word, word FROM chosen
  UNION ALL SELECT c.word, x.form FROM chain c JOIN chosen x ON x.word = c.place WHERE x.form IS NOT NULL
)
SELECT x.word, x.form, r.place AS root, x.n, CAST(x.n_near AS BIGINT) AS n_near, x.form_n
FROM chosen x JOIN chain r ON r.word = x.word JOIN chosen e ON e.word = r.place AND e.form IS NULL"""
