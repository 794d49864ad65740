"""Record tables for the registered queries, from the test tables.

``business`` makes records of a business register from ``customer``, ``nation`` and ``supplier``: every customer is an S1 record, those with a positive
balance also stand in S2, those of most market segments in S3 (some twice), and every supplier is an S2 record without a match. Sources write
names, addresses and labels in their own ways: legal forms, initials, trading names, parentheses, acronyms, abbreviations, landmarks, spaced
codes, accents, placeholders. The rules are one SQL text that Spark and other engines read alike.

``documents`` maps texts to records: the first 6 words are the name, all the others the address, lang is the country; equal texts match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import importable

FIRST = (
    "Acme", "Sharma", "Lakshmi", "Orion", "Kumar", "Société Générale", "Müller", "Nova", "Agarwal", "Summit", "Harbor", "M.G.", "Vertex", "Maple", "Cedar", "L’Étoile",
    "Delta", "Phoenix", "Straßburg", "Quick",
)
SECOND = ("Blue", "Green Field", "Metro", "Royal", "Coastal", "Prime", "Silver", "Northern", "Granite", "Velvet", "Jaxx", "Zenith", "Copper", "Harvest", "Ivory", "Falcon", "Kohinoor")
KINDS = (("Traders", "Trdg"), ("Industries", "Inds."), ("Pharmaceuticals", "Pharma"), ("Engineering", "Engg"), ("Services", "Svcs"), ("Technologies", "Tech"), ("Manufacturing", "Mfg"))
LEGAL = (" Ltd", " Private Limited", ", Inc.", " GmbH", " S.A.R.L.", "", " L.L.C.", " & Co.", " Corporation")
STREETS = (
    ("Main Street", "Main St."), ("M.G. Road", "MG Rd"), ("Rue de Lyon", "R. de Lyon"), ("Park Avenue", "Park Ave"), ("Lake Drive", "Lake Dr"), ("Shivajinagar", "Shivaji Nagar"),
    ("Boulevard Saint Michel", "Bd St Michel"), ("5th Cross", "5 Cross"), ("North Highway", "N Hwy"), ("Hill Square", "Hill Sq"), ("Temple Lane", "Temple Ln"),
)
CITIES = ("Pune", "Lyon", "Springfield", "Bengaluru", "Köln", "Madurai", "Riverside", "Nantes", "Jaipur", "Salem", "Dover", "Kochi", "Trier")
EXTRA = ("", "", "Shop No. 4, ", "Opp. Town Hall, ", "2nd Floor, ", "Plot 17; ", "Near Old Bank, ")


def _pick(number: str, words: tuple) -> str:
    return f"CASE CAST({number} AS BIGINT) % {len(words)} " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(words)) + " END"


def _every(n: int) -> str:
    return f"floor(k / {n})"


#: recs (entity_id, business_name, business_address, country, source) and truth (s1_id, t_id).
BUSINESS_SQL = f"""
base AS (
  SELECT k, id, bal, seg, nation, {_pick('k', FIRST)} AS w1, {_pick(_every(20), SECOND)} AS w2, {_pick('k * 3 + ' + _every(7), tuple(x for x, _ in KINDS))} AS kind,
    {_pick('k * 3 + ' + _every(7), tuple(x for _, x in KINDS))} AS kind_short, {_pick('k * 5 + ' + _every(11), LEGAL)} AS legal, {_pick('k * 7 + ' + _every(3), tuple(x for x, _ in STREETS))} AS street,
    {_pick('k * 7 + ' + _every(3), tuple(x for _, x in STREETS))} AS street_short, {_pick(_every(5) + ' + k', CITIES)} AS city, {_pick('k', EXTRA)} AS extra,
    CAST(1 + k % 250 AS STRING) AS house, CAST(100000 + (k * 7919) % 900000 AS STRING) AS code
  FROM (SELECT c_custkey AS k, CAST(c_custkey AS STRING) AS id, c_acctbal AS bal, c_mktsegment AS seg, n_name AS nation FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey) AS c
), recs AS (
  SELECT 'S1-' || id AS entity_id, CASE WHEN k % 71 = 0 THEN '--' ELSE w1 || ' ' || w2 || ' ' || kind || legal END AS business_name,
    CASE WHEN k % 53 = 0 THEN 'not available' ELSE house || ' ' || street || ', ' || extra || city || ' ' || code END AS business_address, nation AS country, 'S1' AS source
  FROM base
  UNION ALL SELECT 'S2-' || id, CASE k % 7
      WHEN 0 THEN upper(replace(w1, 'ß', 'ss') || ' ' || w2 || ' ' || kind) || ' PVT. LTD.' WHEN 1 THEN w1 || ' & ' || w2 || ' ' || kind || ' Private Limited'
      WHEN 2 THEN w2 || ' Holdings d/b/a ' || w1 || ' ' || w2 || ' ' || kind WHEN 3 THEN w1 || ' ' || w2 || ' (' || kind || ' Division) Inc'
      WHEN 4 THEN 'M/s. ' || w1 || ' ' || w2 || ' ' || kind_short WHEN 5 THEN replace(w1, 'a', 'aa') || ' ' || w2 || ' ' || kind_short || legal
      ELSE CASE WHEN k % 4 = 0 THEN 'NA' ELSE 'The ' || w2 || ' ' || w1 || ' ' || kind || ' Co.' END END,
    CASE WHEN k % 8 = 6 THEN 'N/A' ELSE house || ', ' || street_short || ', Nr. City Mall, ' || city || ' - ' || substr(code, 1, 3) || ' ' || substr(code, 4, 3) END,
    CASE WHEN nation = 'NATION_7' THEN 'unknown' ELSE nation END, 'S2'
  FROM base WHERE bal > 0
  UNION ALL SELECT 'S3-' || id, CASE k % 5
      WHEN 0 THEN upper(substr(w1, 1, 1) || substr(w2, 1, 1) || substr(kind, 1, 1)) WHEN 1 THEN w1 || ' ' || w2 || ' ' || kind WHEN 2 THEN w1 || ' ' || kind || ' t/a ' || w2 || ' Foods'
      WHEN 3 THEN w1 || ', ' || w2 || ' ' || kind_short || ' (formerly ' || w2 || ' Brothers)' ELSE lower(w1 || w2) || ' ' || kind || legal END,
    CASE WHEN k % 9 = 4 THEN '' ELSE upper(house || ' ' || street || ' ' || city) || ' ' || code || ' CEDEX' END,
    CASE WHEN nation = 'NATION_7' OR k % 9 = 0 THEN '' ELSE lower(nation) END, 'S3'
  FROM base WHERE seg <> 'FURNITURE'
  UNION ALL SELECT 'S3-' || id || 'b', w1 || ' ' || w2 || ' ' || kind || ' Branch Office', house || ' ' || street_short || ', Unit 3, ' || city || ', ' || code, CASE WHEN nation = 'NATION_7' THEN 'nil' ELSE nation END, 'S3' FROM base WHERE bal > 8000
  UNION ALL SELECT 'S2-s' || CAST(s_suppkey AS STRING), replace(s_name, '#', ' no ') || ' Exports', CAST(s_suppkey AS STRING) || ' Dock Road, ' || n_name, CASE WHEN n_name = 'NATION_7' THEN '-' ELSE n_name END, 'S2'
  FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
), truth AS (
  SELECT 'S1-' || id AS s1_id, 'S2-' || id AS t_id FROM base WHERE bal > 0
  UNION ALL SELECT 'S1-' || id, 'S3-' || id FROM base WHERE seg <> 'FURNITURE'
  UNION ALL SELECT 'S1-' || id, 'S3-' || id || 'b' FROM base WHERE bal > 8000
  UNION ALL SELECT 'S1-' || x.id, 'S2-' || y.id FROM base AS x JOIN base AS y ON y.k = x.k + 1 WHERE x.bal < -500 AND y.bal > 0
)"""

#: The same for texts.
DOCUMENTS_SQL = r"""
words AS (
  SELECT doc_id, text, lang, 'S' || CAST(1 + doc_id % 3 AS STRING) AS source, regexp_extract_all(text, '[^ \t\n\r\f\x0b]+') AS w FROM {documents}
), recs AS (
  SELECT source || '-' || CAST(doc_id AS STRING) AS entity_id, array_to_string(w[1:6], ' ') AS business_name, array_to_string(w[7:], ' ') AS business_address, lang AS country, source FROM words
)"""


def query(spark: SparkSession, sf_dir: str, rest: str) -> DataFrame:
    """A query over the business register's tables."""
    read = importable(spark).read
    return spark.sql(f"WITH {BUSINESS_SQL} {rest}", **{t: read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation", "supplier")})


def business(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, business_name, business_address, country and source."""
    return query(spark, sf_dir, "SELECT * FROM recs")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s1_id and t_id of the records of one customer; some S1 records also have their neighbour's S2 record."""
    return query(spark, sf_dir, "SELECT * FROM truth")


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return countries(spark, sf_dir).select("s1_id")


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return business(spark, sf_dir).where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "country")


def documents(spark: SparkSession, sf_dir: str, address_words: int | None = None) -> DataFrame:
    """Texts as records; the address is all the rest of a text, or its next words."""
    docs = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    words = F.filter(F.split("text", r"[ \t\n\r\f\x0b]+"), lambda w: w != "")
    source = F.expr("concat('S', cast(1 + doc_id % 3 as string))")
    return docs.select(
        F.concat(source, F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"), F.array_join(F.slice(words, 1, 6), " ").alias("business_name"),
        F.array_join(F.slice(words, 7, address_words or 2**31 - 1), " ").alias("business_address"), F.col("lang").alias("country"), source.alias("source"))
