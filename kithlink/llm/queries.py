"""The queries opN of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, langid, mixing, multiindex, pii, quality, sharding, simhash, substring, urls
from .common import importable

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return multiindex.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(_table(spark, sf_dir, "documents")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(_table(spark, sf_dir, "documents"))


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), 16)


QUERIES: dict[str, Query] = {
    "op1_multi_index": op1_multi_index,
    "op2_simhash": op2_simhash,
    "op3_url_rules": op3_url_rules,
    "op4_quality": op4_quality,
    "op5_decontamination": op5_decontamination,
    "op6_mixing": op6_mixing,
    "op7_substring": op7_substring,
    "op8_personal_data": op8_personal_data,
    "op9_language": op9_language,
    "op10_byte_shards": op10_byte_shards,
}

#: Whether the method's own rules block host, path and query, joined as u.
_BLOCKED = " OR ".join(
    "regexp_matches(u, '(?is)" + shape.replace("{}", "(?:" + "|".join(w.replace("-", "[-]") for w in words) + ")") + "')" for words, shape in urls.SHAPES.values())

ORACLE_SQL: dict[str, str] = {
    "op3_url_rules": rf"""
WITH a AS (
  SELECT page_id, CASE WHEN url IS NOT NULL AND instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query
  FROM a
), c AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/'
  END AS rule, host || path || query AS u FROM b
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN {_BLOCKED} THEN 'block'
    ELSE 'allow' END AS verdict
FROM c
""",
    "op6_mixing": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), numbered AS (
  SELECT source, words, CAST(CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY source)
), levels AS (SELECT *, 3 * words / weight AS level FROM numbered
), ranked AS (
  SELECT *, row_number() OVER w AS nth, CAST(sum(words) OVER () AS BIGINT) AS all_words, sum(weight) OVER () AS all_weights,
    CAST(coalesce(sum(words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cut,
    coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
  FROM levels WINDOW w AS (ORDER BY level, source IS NULL, source)
), unit AS (
  SELECT min_by(u, nth) AS unit FROM (SELECT nth, level, (all_words - 3 * cut) / (all_weights - used) AS u FROM ranked) WHERE u <= level
), goals AS (
  SELECT source, words, CASE WHEN unit <= level THEN unit * weight ELSE CAST(3 * words AS DOUBLE) END AS goal FROM levels CROSS JOIN unit
), rates AS (
  SELECT *, CASE WHEN words > 0 THEN round(least(goal / words, 3), 9) ELSE 0 END AS rate FROM goals
), classes AS (
  SELECT c.source, c.size, c.n, least(floor(rate + 1e-9), 3) AS base, greatest(rate - least(floor(rate + 1e-9), 3), 0) AS part,
    row_number() OVER (PARTITION BY c.source ORDER BY c.size DESC) AS i
  FROM (SELECT source, size, count(*) AS n FROM d GROUP BY source, size) c JOIN rates r ON c.source IS NOT DISTINCT FROM r.source
), steps AS (
  SELECT source, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS size, CAST(0 AS DOUBLE) AS owed, CAST(0 AS DOUBLE) AS base, CAST(0 AS DOUBLE) AS extra FROM rates
  UNION ALL
  SELECT source, i, size, due - extra * size, base, extra FROM (
    SELECT *, CASE WHEN size > 0 AND base < 3 THEN least(greatest(floor(due / size + 0.5), 0), n) ELSE 0 END AS extra FROM (
      SELECT c.source, c.i, c.size, c.n, c.base, s.owed + c.part * c.n * c.size AS due FROM steps s JOIN classes c ON c.source IS NOT DISTINCT FROM s.source AND c.i = s.i + 1))
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source, size ORDER BY substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16)) AS nth FROM d
)
SELECT p.doc_id, p.size, r.words AS source_size, r.goal AS target, CAST((s.base + CASE WHEN p.nth <= s.extra THEN 1 ELSE 0 END) * p.size AS BIGINT) AS taken
FROM placed p JOIN rates r ON p.source IS NOT DISTINCT FROM r.source JOIN steps s ON s.i > 0 AND s.source IS NOT DISTINCT FROM p.source AND s.size = p.size
""",
    "op7_substring": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) > 12)
), firsts AS (
  SELECT s, min(doc_id) AS m FROM windows GROUP BY s
), marks AS (
  SELECT windows.doc_id, windows.i FROM windows JOIN firsts ON windows.s = firsts.s WHERE windows.doc_id > firsts.m
), gone AS (
  SELECT DISTINCT doc_id, i + j AS p FROM (SELECT doc_id, i, unnest(range(13)) AS j FROM marks)
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d WHERE len(w) > 0
), kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS t, count(*) AS n
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p WHERE gone.p IS NULL GROUP BY words.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
""",
    # crc32 by pieces of 256 bytes: zero bytes in front don't change a register of zero, and 62F52692 brings it to all ones
    "op10_byte_shards": r"""
WITH steps AS (
  SELECT list(e ORDER BY k) AS entry FROM (
    SELECT k, list_reduce(list_concat([k], range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))) AS e FROM (SELECT unnest(range(256)) AS k))
), jumps AS (
  SELECT list(e ORDER BY k) FILTER (p = 0) AS j0, list(e ORDER BY k) FILTER (p = 1) AS j1, list(e ORDER BY k) FILTER (p = 2) AS j2, list(e ORDER BY k) FILTER (p = 3) AS j3
  FROM (SELECT k, p, list_reduce(list_concat([k << (8 * p)], range(256)), lambda c, i: xor(c >> 8, entry[(c & 255) + 1])) AS e
    FROM (SELECT unnest(range(256)) AS k) CROSS JOIN (SELECT unnest(range(4)) AS p) CROSS JOIN steps)
), d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, '62F52692' || hex(encode(coalesce(text, ''))) AS h FROM documents
), pieces AS (
  SELECT doc_id, i, substr(padded, 512 * i + 1, 512) AS piece FROM (SELECT doc_id, padded, unnest(range(len(padded) // 512)) AS i
    FROM (SELECT doc_id, repeat('0', (512 - len(h) % 512) % 512) || h AS padded FROM d))
), sums AS (
  SELECT doc_id, list(c ORDER BY i) AS found FROM (
    SELECT doc_id, i, list_reduce(list_concat([0], list_transform(range(256), lambda k: CAST('0x' || substr(piece, 2 * k + 1, 2) AS BIGINT))),
      lambda c, x: xor(c >> 8, entry[(xor(c, x) & 255) + 1])) AS c FROM pieces CROSS JOIN steps) GROUP BY doc_id
), crcs AS (
  SELECT doc_id, xor(4294967295, list_reduce(found, lambda c, x: xor(x, xor(xor(j0[(c & 255) + 1], j1[((c >> 8) & 255) + 1]), xor(j2[((c >> 16) & 255) + 1], j3[(c >> 24) + 1]))))) AS crc
  FROM sums CROSS JOIN jumps
), s AS (
  SELECT doc_id, size, crc, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM d JOIN crcs USING (doc_id)
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(before * 16 // total AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY before * 16 // total ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s
""",
}
