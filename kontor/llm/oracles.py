"""The queries that SQL can express, as SQL for another engine over the same tables.

Not here: language identification and packing need a trained model and a tokenizer,
SimHash needs XXH64, and the patterns of added personal data need lookaround.
"""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _draw(*parts: str) -> str:
    return f"CAST('0x' || md5(concat_ws('/', {', '.join(parts)}))[1:13] AS BIGINT)"


LM_SCORE = f"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORD}) AS w FROM documents),
positions AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT r, i, w[i] AS one, w[i - 1] AS before,
    CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS two,
    CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] END AS two_before,
    CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS three FROM positions),
everything AS (
  SELECT r, one AS g FROM grams UNION ALL SELECT r, two FROM grams WHERE two IS NOT NULL
  UNION ALL SELECT r, three FROM grams WHERE three IS NOT NULL),
own AS (SELECT r, g, count(*) AS c FROM everything GROUP BY ALL),
total AS (SELECT g, sum(c) AS c FROM own GROUP BY g),
others AS (SELECT own.r, own.g, total.c - own.c AS c FROM own JOIN total USING (g)),
counted AS (
  SELECT p.r, p.i, a.c AS here, b.c AS context, c.c AS pair, d.c AS pair_context, e.c AS triple
  FROM grams p JOIN others a ON a.r = p.r AND a.g = p.one
  LEFT JOIN others b ON b.r = p.r AND b.g = p.before
  LEFT JOIN others c ON c.r = p.r AND c.g = p.two
  LEFT JOIN others d ON d.r = p.r AND d.g = p.two_before
  LEFT JOIN others e ON e.r = p.r AND e.g = p.three),
scored AS (
  SELECT c.r, CASE
      WHEN triple > 0 THEN ln(triple) - ln(pair_context)
      WHEN pair > 0 THEN ln(pair) - ln(context) + (least(i, 3) - 2) * ln(0.4)
      WHEN here > 0 THEN ln(here) + (least(i, 3) - 1) * ln(0.4) - ln(n.rest)
      ELSE least(i, 3) * ln(0.4) - ln(n.rest) END AS s,
    CASE WHEN coalesce(triple, 0) <= 0 AND coalesce(pair, 0) <= 0 AND here <= 0 THEN 1 ELSE 0 END AS unseen
  FROM counted c JOIN (
    SELECT r, greatest((SELECT sum(len(w)) FROM words) - len(w), 1) AS rest FROM words) n ON n.r = c.r),
summed AS (SELECT r, sum(s) AS score, sum(unseen) AS unseen FROM scored GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS words, round(coalesce(score, 0), 6) AS score,
  round(CASE WHEN len(w) > 0 THEN score / len(w) ELSE 0 END, 6) AS mean,
  CAST(coalesce(unseen, 0) AS BIGINT) AS unseen
FROM words LEFT JOIN summed USING (r)"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
  vec_id, score
FROM s QUALIFY rank <= 20"""

SOURCE_MIX = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight,
    CAST(3 * source_size AS DOUBLE) AS cap FROM s),
o AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS caps, coalesce(sum(weight) OVER before, 0) AS weights
  FROM w WINDOW before AS (
    ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max(((SELECT sum(source_size) FROM w) - caps) / ((SELECT sum(weight) FROM w) - weights)) AS level FROM o),
t AS (
  SELECT source, source_size, least(cap, greatest(0.0, weight * level)) AS target,
    {_draw("'mix'", "coalesce(source, 'null')")} % 16777216 AS shift FROM w, l),
r AS (
  SELECT *, CAST(coalesce(least(round(target / nullif(source_size, 0) * 16777216), 50331648.0), 0) AS BIGINT) AS rate
  FROM t),
p AS (
  SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY size DESC, doc_id) - 1 AS place FROM d)
SELECT doc_id, p.source, size, source_size, target,
  CAST((((shift + (place + 1) * rate) // 16777216) - ((shift + place * rate) // 16777216)) * size AS BIGINT) AS taken
FROM p JOIN r ON p.source IS NOT DISTINCT FROM r.source"""


def url_filter(rules: list[tuple[str, str, str]]) -> str:
    listed = ", ".join(str(rule) for rule in rules)
    return f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule_host, rule_path, verdict) AS (VALUES {listed}),
hits AS (
  SELECT page_id, rule_host || rule_path AS rule, verdict FROM h JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY page_id
    ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN hits USING (page_id)"""


# CRC-32 of each text, byte by byte.
_CRC = """
bytewise AS (
  SELECT list_transform(range(0, 256), lambda n: list_reduce(
    [CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
checks AS (
  SELECT r, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      regexp_extract_all(h, '..'), lambda pair: CAST('0x' || pair AS BIGINT))),
    lambda c, n: xor(c // 256, t[xor(c, n) % 256 + 1])), 4294967295) AS text_crc32
  FROM (SELECT r, hex(encode(x)) AS h FROM d), bytewise)"""


def _tree(shards: int, out: str) -> str:
    """Which of so many equal shards, two to a rack and four to a region, a key falls to."""
    steps, above = [], ""
    for level, size in (("region", 4), ("rack", 2), ("shard", 1)):
        parent = {"region": "0", "rack": f"s // {4}", "shard": f"s // {2}"}[level]
        steps.append(f"""
{out}_{level} AS (
  SELECT r, arg_min(child, -ln(({_draw('key', f"'{level}'", 'CAST(child AS VARCHAR)')} + 0.5) / 4503599627370496.0)
    / weight) AS chosen
  FROM {above or '(SELECT r, key, 0 AS chosen FROM keys)'} k JOIN (
    SELECT s // {size} AS child, any_value({parent}) AS parent, CAST(count(*) AS DOUBLE) AS weight
    FROM (SELECT unnest(range(0, {shards})) AS s) GROUP BY child) c ON c.parent = k.chosen
  GROUP BY r)""")
        above = f"(SELECT * FROM {out}_{level} JOIN keys USING (r))"
    return ",".join(steps)


SHARDING = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
keys AS (SELECT r, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key FROM d),{_CRC},{_tree(16, 'now')},{_tree(17, 'grown')},
a AS (
  SELECT doc_id, CAST(strlen(x) + 1 AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32,
    CAST(n.chosen AS INT) AS shard, CAST(g.chosen AS INT) AS grown_shard,
    {_draw('key', 'CAST(CAST(text_crc32 AS BIGINT) AS VARCHAR)', "'slice'")} % 4096 AS slice
  FROM d JOIN keys USING (r) JOIN checks USING (r) JOIN now_shard n USING (r) JOIN grown_shard g USING (r))
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY slice, doc_id, size) - 1 AS slot, grown_shard
FROM a"""

EXACT_DEDUP = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM d"""

RESAMPLING = f"""
WITH bytewise AS (
  SELECT list_transform(range(0, 256), lambda n: list_reduce(
    [CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
texts AS (
  SELECT row_number() OVER () AS r, doc_id, text, 1 AS own FROM documents
  UNION ALL SELECT NULL, NULL, text, 0 FROM benchmark),
words AS (
  SELECT r, doc_id, own, regexp_extract_all(
    {_LOWER.format("coalesce(text, '')")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM texts),
listed AS (
  SELECT r, own, unnest(list_concat(w, list_transform(
    range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM words),
counted AS (SELECT r, own, feature, count(*) AS n FROM listed GROUP BY ALL),
bucketed AS (
  SELECT feature, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      regexp_extract_all(hex(encode(feature)), '..'), lambda pair: CAST('0x' || pair AS BIGINT))),
    lambda c, n: xor(c // 256, t[xor(c, n) % 256 + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM counted), bytewise),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (own = 1), 0) AS s, coalesce(sum(n) FILTER (own = 0), 0) AS t
  FROM counted JOIN bucketed USING (feature) GROUP BY bucket),
everything AS (SELECT coalesce(sum(s), 0) AS every_s, coalesce(sum(t), 0) AS every_t FROM sums),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    CAST(t + 1 AS DOUBLE) * CAST(every_s + 10000 AS DOUBLE)
    / (CAST(s + 1 AS DOUBLE) * CAST(every_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM sums, everything),
weights AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
  FROM counted JOIN bucketed USING (feature) JOIN gains USING (bucket) WHERE own = 1 GROUP BY r),
scored AS (
  SELECT doc_id, len(w) < 20 AS short, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256(
      '7:' || coalesce(CAST(doc_id AS VARCHAR), 'null'))[1:8] AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (r) WHERE own = 1),
placed AS (
  SELECT *, row_number() OVER (ORDER BY short, score DESC, doc_id NULLS LAST) AS place,
    25 * count(*) FILTER (NOT short) OVER () // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM placed"""
