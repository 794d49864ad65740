"""One query for each group of operators over the fixture tables, and the same in SQL where SQL can express it.

Records come from ``sources.fixtures``: the business register, all of it, through the shipped normaliser; some queries also read whole documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BlockingConfig, ModelConfig
from ..functions import similarity, text
from ..operators import blocking, decision, explore, features, graph, matcher, metrics, normalize, vectors
from ..session import importable, shared_dir, stored
from ..sources import fixtures, records, sinks
from ..sources.records import SplitData, check_ground_truth, summary_table
from . import oracle
from .oracle import BUSINESS, LABELLED, PAIRS, SCORES, VIEWS

Query = Callable[[SparkSession, str], DataFrame]
CONFIG = BlockingConfig()
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return add


def _r(column: str, digits: int = 6):
    return F.round(column, digits).alias(column)


def _six(column: str):
    """A number to six digits, half away from zero after scaling, as DuckDB rounds: differences of nine-digit scores often end in just a half."""
    return F.round(F.col(column) * 1e6) / 1e6 + 0.0


def views_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business records by the full normaliser."""
    return stored(normalize.normalize_records(fixtures.business(spark, sf_dir)), "views")


def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates of all seven blockers, pruned."""
    return stored(blocking.generate_candidates(views_of(spark, sf_dir), CONFIG), "candidates")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates with the cheap score as p, and y."""
    pairs = candidate_pairs(spark, sf_dir).withColumn("p", F.col("cheap"))
    return matcher.label_pairs(pairs, fixtures.truth(spark, sf_dir)).select("s1_id", "t_id", "src", "bits", "name_cos", "addr_cos", "p", "y")


def folds_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.make_folds(fixtures.truth(spark, sf_dir), fixtures.spine(spark, sf_dir), fixtures.countries(spark, sf_dir))


#: Lines of an id list with faults of every kind: line, n (columns), c1, c2, c3.
_FAULTY = """base_lists AS (
  SELECT k, id, CASE WHEN bal > 0 AND seg <> 'FURNITURE' THEN 'S2-' || id || ',S3-' || id WHEN bal > 0 THEN 'S2-' || id WHEN seg <> 'FURNITURE' THEN 'S3-' || id ELSE '' END AS ids FROM base
), faulty AS (
  SELECT 2 * k AS line, CASE k % 13 WHEN 5 THEN 3 WHEN 10 THEN 1 ELSE 2 END AS n, CASE WHEN k % 13 = 8 THEN 'S1-x' || id ELSE 'S1-' || id END AS c1,
    CASE k % 13 WHEN 1 THEN ids || ',' || ids WHEN 2 THEN 'S2-x' || id || ',' || ids WHEN 3 THEN 'X-' || id WHEN 4 THEN ids || ', ' WHEN 9 THEN 'S1-' || id ELSE ids END AS c2, 'more' AS c3
  FROM base_lists WHERE k % 13 <> 6
  UNION ALL SELECT 2 * k + 1, 2, 'S1-' || id, ids, '' FROM base_lists WHERE k % 13 = 7
)"""


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line and fields."""
    rows = fixtures.query(spark, sf_dir, f", {_FAULTY} SELECT * FROM faulty")
    return rows.select(F.col("line").cast("int").alias("line"), F.slice(F.array("c1", "c2", "c3"), F.lit(1), F.col("n").cast("int")).alias("fields"))


def _split(spark: SparkSession, sf_dir: str, truth: DataFrame) -> SplitData:
    rows = fixtures.business(spark, sf_dir)
    return SplitData(*(rows.where(F.col("source") == s).drop("source") for s in records.SOURCES), truth)


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.id_lists(fixtures.spine(spark, sf_dir), fixtures.truth(spark, sf_dir))


# ---------------------------------------------------------------- files


def _place(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(importable(spark))}/{what}-{uuid.uuid4().hex}"


def _write_tsv(rows: DataFrame, path: str) -> None:
    rows.repartition(1).write.csv(path, sep="\t", header=True, quote="", escape="", emptyValue="", nullValue="")


def _written_split(spark: SparkSession, sf_dir: str) -> str:
    """The business records as a split in the format of the files."""
    folder, rows = _place(spark, "split"), fixtures.business(spark, sf_dir)
    for i in (1, 2, 3):
        _write_tsv(rows.where(F.col("source") == f"S{i}").drop("source"), f"{folder}/train/train_source{i}.tsv")
    _write_tsv(_lists(spark, sf_dir).toDF(*records.TRUTH_COLUMNS), f"{folder}/train/train_ground_truth.tsv")
    return folder


@query("s1_s4_load_split", f"WITH {BUSINESS} SELECT entity_id, trim(business_name) AS business_name, trim(business_address) AS business_address, trim(country) AS country, source FROM recs")
def s1_load_split(spark, sf_dir):
    return records.load_split(spark, _written_split(spark, sf_dir), "train").records


@query("s3_ground_truth", f"WITH {BUSINESS} SELECT DISTINCT s1_id, t_id FROM truth")
def s3_ground_truth(spark, sf_dir):
    return records.load_split(spark, _written_split(spark, sf_dir), "train").truth


@query("s7_submission", f"""{PAIRS}, kept AS (SELECT s1_id, t_id FROM scored WHERE cheap >= 0.6), lists AS (
  SELECT 'matching_results.tsv' AS file, s1_id, string_agg(t_id, ',' ORDER BY substr(t_id, 1, 3), len(t_id), t_id) AS ids FROM kept GROUP BY s1_id
  UNION ALL SELECT 'candidate_pairs.tsv', s1_id, string_agg(t_id, ',' ORDER BY substr(t_id, 1, 3), len(t_id), t_id) FROM scored GROUP BY s1_id
), numbered AS (SELECT s1_id, row_number() OVER (ORDER BY len(s1_id), s1_id) + 1 AS line FROM spine)
SELECT f.file, n.line, n.s1_id, coalesce(ids, '') AS ids FROM numbered n CROSS JOIN (SELECT unnest(['matching_results.tsv', 'candidate_pairs.tsv']) AS file) f LEFT JOIN lists l ON l.file = f.file AND l.s1_id = n.s1_id""")
def s7_submission(spark, sf_dir):
    """Both lists written, read again line by line."""
    pairs, folder = candidate_pairs(spark, sf_dir), _place(spark, "submission")
    paths = sinks.write_submission(folder, fixtures.spine(spark, sf_dir), pairs.where("cheap >= 0.6").select("s1_id", "t_id"), pairs.select("s1_id", "t_id"))
    out = None
    for path in paths:
        rows = sinks.parsed_lines(spark, path).where("line > 1").select(
            F.lit(path.rsplit("/", 1)[-1]).alias("file"), F.col("line").cast("long").alias("line"), F.col("fields")[0].alias("s1_id"), F.col("fields")[1].alias("ids"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("s8_tables", f"WITH {BUSINESS} SELECT {oracle.label('country')} AS country, CAST(count(CASE WHEN source = 'S1' THEN 1 END) AS VARCHAR) AS S1, CAST(count(CASE WHEN source = 'S2' THEN 1 END) AS VARCHAR) AS S2, CAST(count(CASE WHEN source = 'S3' THEN 1 END) AS VARCHAR) AS S3 FROM docs GROUP BY 1")
def s8_tables(spark, sf_dir):
    """A table written as compressed CSV and read again."""
    folder = _place(spark, "tables")
    sinks.write_tables({"countries": explore.country_table(fixtures.business(spark, sf_dir))}, folder, compress=True)
    return spark.read.csv(f"{folder}/countries", header=True)


@query("s9_report", f"WITH {BUSINESS} SELECT 'report.json' AS file, count(*) AS records, count(DISTINCT country) AS labels FROM recs")
def s9_report(spark, sf_dir):
    """A report written as JSON and read again."""
    path = f"{_place(spark, 'report')}/report.json"
    row = fixtures.business(spark, sf_dir).agg(F.count(F.lit(1)).alias("records"), F.countDistinct("country").alias("labels")).first()
    sinks.write_report(spark, path, row.asDict())
    return spark.read.json(path, multiLine=True).select(F.lit("report.json").alias("file"), "records", "labels")


# ---------------------------------------------------------------- text

_WHOLE_TEXTS = f"WITH {oracle.DOCUMENTS}"


@query("t1_missing", f"WITH {BUSINESS} SELECT source, count(*) AS records, count(CASE WHEN {oracle.MISSING.format('business_name')} THEN 1 END) AS names_missing, count(CASE WHEN {oracle.MISSING.format('business_address')} THEN 1 END) AS addresses_missing FROM recs GROUP BY source")
def t1_missing(spark, sf_dir):
    count = lambda c: F.count(F.when(text.is_missing(F.col(c)), 1))
    return fixtures.business(spark, sf_dir).groupBy("source").agg(
        F.count(F.lit(1)).alias("records"), count("business_name").alias("names_missing"), count("business_address").alias("addresses_missing"))


@query("t2_fold", f"{_WHOLE_TEXTS} SELECT entity_id, {oracle.fold('business_name')} AS name, sha256({oracle.fold('business_address')}) AS address FROM recs")
def t2_fold(spark, sf_dir):
    """Whole texts; of the long field the digest."""
    rows = fixtures.documents(spark, sf_dir)
    return rows.select("entity_id", text.fold(F.col("business_name")).alias("name"), F.sha2(text.fold(F.col("business_address")).cast("binary"), 256).alias("address"))


@query("t2_fold_exact", f"{_WHOLE_TEXTS} SELECT entity_id, {oracle.fold('business_name')} AS name, sha256({oracle.fold('business_address')}) AS address FROM recs")
def t2_fold_exact(spark, sf_dir):
    rows = fixtures.documents(spark, sf_dir)
    return rows.select("entity_id", text.fold_exact(F.col("business_name")).alias("name"), F.sha2(text.fold_exact(F.col("business_address")).cast("binary"), 256).alias("address"))


@query("t3_t4_tokens", f"{_WHOLE_TEXTS}, f AS (SELECT entity_id, {oracle.fold('business_address')} AS s FROM recs), {oracle.tokens('f', 'tok')} SELECT entity_id, CAST(len(t) AS BIGINT) AS n, sha256(array_to_string(t, ' ')) AS tokens FROM tok")
def t3_tokens(spark, sf_dir):
    found = text.tokenize(text.fold(F.col("business_address")))
    return fixtures.documents(spark, sf_dir).select("entity_id", F.size(found).cast("long").alias("n"), F.sha2(F.array_join(found, " ").cast("binary"), 256).alias("tokens"))


@query("t5_stem_tokens", f"WITH {VIEWS}, e AS (SELECT DISTINCT unnest(string_split(name_clean || ' ' || addr_clean, ' ')) AS t FROM v) SELECT t AS token, {oracle.STEM.format('t')} AS stem FROM e WHERE t <> ''")
def t5_stem_tokens(spark, sf_dir):
    words = views_of(spark, sf_dir).select(F.explode(text.words(F.concat_ws(" ", "name_clean", "addr_clean"))).alias("token")).distinct()
    return words.select("token", text.stem(F.col("token")).alias("stem"))


@query("t6_skeleton", f"WITH {VIEWS}, e AS (SELECT DISTINCT unnest(string_split(name_clean || ' ' || addr_clean, ' ')) AS token FROM v), f AS (SELECT token FROM e WHERE token <> ''), {oracle.skeleton('f', 'sound')} SELECT token, skeleton FROM sound")
def t6_skeleton(spark, sf_dir):
    words = views_of(spark, sf_dir).select(F.explode(text.words(F.concat_ws(" ", "name_clean", "addr_clean"))).alias("token")).distinct()
    return words.select("token", text.skeleton(F.col("token")).alias("skeleton"))


def _as_text(views: DataFrame) -> DataFrame:
    """The views with lists joined; tokens are the words of the cores."""
    joined = {c: F.array_join(c, " | " if c == "name_alts" else " ") for c in ("name_skel", "name_alts", "addr_numbers", "addr_postal", "addr_tail")}
    return views.withColumns(joined).drop("name_tokens", "addr_tokens")


@query("t7_t13_normalize_records", f"WITH {VIEWS} SELECT {oracle.VIEW_COLUMNS} FROM v")
def t7_normalize(spark, sf_dir):
    return _as_text(normalize.normalize_records(fixtures.business(spark, sf_dir)))


@query("t9_t13_documents", f"WITH {oracle.DOCUMENT_VIEWS} SELECT {oracle.VIEW_COLUMNS} FROM v")
def t9_documents(spark, sf_dir):
    """Whole texts through the normaliser."""
    return _as_text(normalize.normalize_records(fixtures.documents(spark, sf_dir)))


@query("t14_examples", f"""WITH {VIEWS} SELECT r.entity_id, business_name, business_address, country, name_core, legal AS name_legal, array_to_string(alts, ' | ') AS name_alts, acronym AS name_acronym, addr_core,
  array_to_string(postal, ' ') AS addr_postal, house AS addr_house, country_norm FROM recs r JOIN v ON r.entity_id = v.entity_id""")
def t14_examples(spark, sf_dir):
    return normalize.examples(fixtures.business(spark, sf_dir))


@query("t15_id_lists", f"WITH {BUSINESS} SELECT s.s1_id, coalesce(string_agg(t.t_id, ',' ORDER BY substr(t.t_id, 1, 3), len(t.t_id), t.t_id), '') AS ids FROM spine s LEFT JOIN (SELECT DISTINCT * FROM truth) t ON s.s1_id = t.s1_id GROUP BY s.s1_id")
def t15_id_lists(spark, sf_dir):
    return _lists(spark, sf_dir)


@query("t18_char_grams", f"WITH {VIEWS}, g AS (SELECT DISTINCT entity_id, unnest({oracle.GRAMS.format('n')}) AS gram FROM v) SELECT gram, count(*) AS n_records FROM g GROUP BY gram")
def t18_char_grams(spark, sf_dir):
    grams = views_of(spark, sf_dir).select("entity_id", F.explode(F.array_distinct(text.char_grams(F.col("name_core")))).alias("gram"))
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n_records"))


# ---------------------------------------------------------------- vectors


@query("v1_token_bags", f"WITH {VIEWS}, t AS (SELECT entity_id, unnest(list_distinct(n)) AS term FROM v) SELECT term, count(*) AS df FROM t GROUP BY term")
def v1_token_bags(spark, sf_dir):
    return vectors.token_idf(views_of(spark, sf_dir), "name_tokens").select("term", "df")


@query("v2_idf", f"WITH {VIEWS}, t AS (SELECT entity_id, unnest(list_distinct(n)) AS term FROM v), d AS (SELECT term, count(*) AS df FROM t GROUP BY term) SELECT term, df, round(ln((1.0 + total) / (1.0 + df)) + 1, 6) AS idf FROM d CROSS JOIN size")
def v2_idf(spark, sf_dir):
    return vectors.token_idf(views_of(spark, sf_dir), "name_tokens").select("term", "df", _r("idf"))


@query("v3_char_tfidf", f"WITH {VIEWS}, {oracle.CHARS} SELECT entity_id, field, term, round(weight, 6) AS weight FROM post")
def v3_char_tfidf(spark, sf_dir):
    views = views_of(spark, sf_dir)
    one = lambda c, f: vectors.char_tfidf(views, c).select("entity_id", F.lit(f).alias("field"), "term", _r("weight"))
    return one("name_core", "n").unionByName(one("addr_core", "a"))


@query("v4_retrieval_tfidf", f"WITH {VIEWS}, {oracle.postings('post', oracle.GRAMS, CONFIG.char_min_df, 0.2)} SELECT entity_id, term, round(weight, 6) AS weight FROM post WHERE field = 'n'")
def v4_retrieval_tfidf(spark, sf_dir):
    return vectors.char_tfidf(views_of(spark, sf_dir), "name_core", max_df=0.2).select("entity_id", "term", _r("weight"))


@query("v5_word_tfidf", f"WITH {VIEWS}, {oracle.postings('post', '{0}', 1)} SELECT entity_id, field, term, round(weight, 6) AS weight FROM post")
def v5_word_tfidf(spark, sf_dir):
    views = views_of(spark, sf_dir)
    one = lambda c, f: vectors.word_tfidf(views, c).select("entity_id", F.lit(f).alias("field"), "term", _r("weight"))
    return one("name_core", "n").unionByName(one("addr_core", "a"))


@query("v8_record_vectors", f"""WITH {VIEWS}, {oracle.CHARS} SELECT r.entity_id, r.source AS src, f.field, count(p.term) AS terms, round(coalesce(sum((1 + ln(tf)) * (ln((1.0 + total) / (1.0 + df)) + 1)), 0), 6) AS weight
FROM v r CROSS JOIN (SELECT unnest(['n', 'a']) AS field) f CROSS JOIN size LEFT JOIN (SELECT c.*, d.df FROM post_c c JOIN post_d d ON c.field = d.field AND c.term = d.term) p ON p.entity_id = r.entity_id AND p.field = f.field
GROUP BY r.entity_id, r.source, f.field""")
def v8_record_vectors(spark, sf_dir):
    """The index that neighbours are searched with: how many terms a record has, and the sum of their weights."""
    rows = blocking.record_vectors(views_of(spark, sf_dir), CONFIG)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.size(f"{f}_term").cast("long").alias("terms"), F.round(F.aggregate(f"{f}_w", F.lit(0.0), lambda x, y: x + y), 6).alias("weight")) for f in "na"]))
    return rows.select("entity_id", "src", each.alias("x")).select("entity_id", "src", "x.*")


@query("v9_pair_dot", f"""WITH {VIEWS}, {oracle.CHARS}, {oracle.SIM} SELECT t.s1_id, t.t_id, coalesce(round(name_cos, 6), 0) AS cos
FROM (SELECT DISTINCT * FROM truth) t LEFT JOIN sim ON t.s1_id = sim.s1_id AND t.t_id = sim.t_id""")
def v9_pair_dot(spark, sf_dir):
    return vectors.pair_dot(fixtures.truth(spark, sf_dir).distinct(), vectors.char_tfidf(views_of(spark, sf_dir), "name_core"), "cos").select("s1_id", "t_id", _six("cos").alias("cos"))


# ---------------------------------------------------------------- candidates


def _neighbours(score: str, rank: str, k: int) -> Query:
    def run(spark, sf_dir):
        near = blocking.near_pairs(views_of(spark, sf_dir), CONFIG)
        return near.where((F.col(score) > 0) & (F.col(rank) <= k)).select("s1_id", "t_id", "src", F.col(rank).cast("long").alias("rank"), _r(score))

    return run


for _name, _score, _rank, _k in (
        ("j3_knn_name", "name_cos", "name_rank", CONFIG.name_k), ("j3_knn_address", "addr_cos", "addr_rank", CONFIG.address_k), ("j3_knn_combined", "comb", "comb_rank", CONFIG.combined_k)):
    query(_name, f"WITH {VIEWS}, {oracle.CHARS}, {oracle.SIM}, {oracle.knn('sim')} SELECT s1_id, t_id, src, rank, round({_score}, 6) AS {_score} FROM knn_{_score}")(_neighbours(_score, _rank, _k))


@query("j4_rare_token", f"WITH {VIEWS}, {oracle.RARE} SELECT s1_id, t_id, src FROM rare")
def j4_rare_token(spark, sf_dir):
    return blocking.rare_token_pairs(views_of(spark, sf_dir), CONFIG)


@query("j5_exact_keys", f"WITH {VIEWS}, {oracle.KEYS} SELECT s1_id, t_id, src FROM keyed")
def j5_exact_keys(spark, sf_dir):
    return blocking.exact_key_pairs(views_of(spark, sf_dir), CONFIG)


@query("j6_postal", f"WITH {VIEWS}, {oracle.candidates()} SELECT s1_id, t_id, src FROM postal")
def j6_postal(spark, sf_dir):
    return blocking.union_pairs(views_of(spark, sf_dir), CONFIG).where("b_postal = 1").select("s1_id", "t_id", "src")


@query("j7_acronym", f"WITH {VIEWS}, {oracle.ACRONYM} SELECT s1_id, t_id, src FROM acro")
def j7_acronym(spark, sf_dir):
    return blocking.acronym_pairs(views_of(spark, sf_dir), CONFIG)


@query("j8_union_bits", f"WITH {VIEWS}, {oracle.candidates()} SELECT s1_id, t_id, src, CAST(bits AS BIGINT) AS bits, CAST(bit_count(CAST(bits AS INTEGER)) AS BIGINT) AS n_blocks FROM bits")
def j8_union_bits(spark, sf_dir):
    """All seven blockers, before pruning."""
    found = blocking.union_pairs(views_of(spark, sf_dir), CONFIG)
    return found.select("s1_id", "t_id", "src", F.col("bits").cast("long").alias("bits"), F.col("n_blocks").cast("long").alias("n_blocks"))


@query("j9_cheap_score", f"{PAIRS} SELECT s1_id, t_id, round(name_cos, 6) AS name_cos, round(addr_cos, 6) AS addr_cos, round(cheap, 6) AS cheap FROM with_scores")
def j9_cheap_score(spark, sf_dir):
    views = views_of(spark, sf_dir)
    return blocking.with_cheap(blocking.union_pairs(views, CONFIG), views, CONFIG.combined_name_weight).select("s1_id", "t_id", _r("name_cos"), _r("addr_cos"), _r("cheap"))


@query("j10_candidates", f"{PAIRS} SELECT s1_id, t_id, src, CAST(bits AS BIGINT) AS bits, round(cheap, 6) AS cheap FROM scored")
def j10_candidates(spark, sf_dir):
    return candidate_pairs(spark, sf_dir).select("s1_id", "t_id", "src", F.col("bits").cast("long").alias("bits"), _r("cheap"))


@query("j10_retrieval_candidates", f"WITH {VIEWS}, {oracle.candidates('near')} SELECT s1_id, t_id, src, CAST(bits AS BIGINT) AS bits, round(cheap, 6) AS cheap FROM scored")
def j10_retrieval_candidates(spark, sf_dir):
    """Neighbours searched without grams that over a fifth of the records have, scored with all."""
    found = blocking.generate_candidates(views_of(spark, sf_dir), BlockingConfig(retrieval_max_df=0.2))
    return found.select("s1_id", "t_id", "src", F.col("bits").cast("long").alias("bits"), _r("cheap"))


@query("j12_labels", f"{LABELLED} SELECT s1_id, t_id, CAST(y AS BIGINT) AS y FROM lab")
def j12_labels(spark, sf_dir):
    return labelled(spark, sf_dir).select("s1_id", "t_id", F.col("y").cast("long").alias("y"))


@query("j14_missed", f"{PAIRS} SELECT DISTINCT t.s1_id, t.t_id, substr(t.t_id, 1, 2) AS src FROM truth t LEFT JOIN scored p ON t.s1_id = p.s1_id AND t.t_id = p.t_id WHERE p.s1_id IS NULL")
def j14_missed(spark, sf_dir):
    return metrics.missed_pairs(candidate_pairs(spark, sf_dir), fixtures.truth(spark, sf_dir))


@query("j15_pair_view", f"WITH {BUSINESS} SELECT DISTINCT t.s1_id, t.t_id, x.business_name AS s1_name, x.business_address AS s1_address, x.country AS s1_country, y.business_name AS t_name, y.business_address AS t_address, y.country AS t_country FROM truth t JOIN recs x ON t.s1_id = x.entity_id JOIN recs y ON t.t_id = y.entity_id")
def j15_pair_view(spark, sf_dir):
    return explore.pair_view(fixtures.truth(spark, sf_dir).distinct(), fixtures.business(spark, sf_dir))


_RULES = f"""{_FAULTY}, wide AS (SELECT * FROM faulty WHERE n = 3), two AS (SELECT line, trim(c1) AS s1_id, CASE WHEN n = 1 THEN '' ELSE trim(c2) END AS ids FROM faulty WHERE n < 3
), items AS (SELECT line, s1_id, CASE WHEN ids = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(ids, ',') END AS raw FROM two
), kept AS (SELECT *, list_filter(list_transform(raw, lambda x: trim(x)), lambda x: x <> '') AS ids FROM items
), each_id AS (SELECT line, unnest(list_distinct(ids)) AS t_id FROM kept), own AS (SELECT line, t_id FROM each_id WHERE t_id LIKE 'S2-%' OR t_id LIKE 'S3-%'), known AS (SELECT entity_id AS t_id FROM recs WHERE source <> 'S1')"""


@query("j17_rule_violations", f"""WITH {BUSINESS}, {_RULES}, counts AS (
SELECT 'not two columns' AS rule, count(*) AS n FROM wide
UNION ALL SELECT 'duplicate source1_entity_id', count(*) FROM (SELECT s1_id FROM kept GROUP BY s1_id HAVING count(*) > 1)
UNION ALL SELECT 'empty id or whitespace', count(*) FROM kept WHERE len(list_filter(raw, lambda x: x = '' OR x <> trim(x))) > 0
UNION ALL SELECT 'duplicate ids in a list', count(*) FROM kept WHERE len(ids) <> len(list_distinct(ids))
UNION ALL SELECT 'not an S2 or S3 id', count(*) FROM each_id WHERE t_id NOT LIKE 'S2-%' AND t_id NOT LIKE 'S3-%'
UNION ALL SELECT 'unknown target', count(*) FROM own WHERE t_id NOT IN (SELECT t_id FROM known)
UNION ALL SELECT 'S1 record missing', count(*) FROM spine WHERE s1_id NOT IN (SELECT s1_id FROM kept)
UNION ALL SELECT 'unknown S1 record', count(DISTINCT s1_id) FROM kept WHERE s1_id NOT IN (SELECT s1_id FROM spine)) SELECT rule, n FROM counts WHERE n > 0""")
def j17_rule_violations(spark, sf_dir):
    targets = fixtures.business(spark, sf_dir).where("source <> 'S1'").select(F.col("entity_id").alias("t_id"))
    return sinks.list_violations(_faulty(spark, sf_dir), fixtures.spine(spark, sf_dir), targets).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("j18_orphan_countries", f"WITH {VIEWS} SELECT DISTINCT country_norm AS label FROM v WHERE source = 'S1' AND country_norm <> '' AND country_norm NOT IN (SELECT country_norm FROM v WHERE source <> 'S1')")
def j18_orphan_countries(spark, sf_dir):
    return explore.orphan_countries(fixtures.business(spark, sf_dir))


# ---------------------------------------------------------------- features


def _with_views(spark: SparkSession, sf_dir: str, views: DataFrame) -> DataFrame:
    return candidate_pairs(spark, sf_dir).select("s1_id", "t_id").join(features._views(views, "1"), "s1_id").join(features._views(views, "2"), "t_id")


@query("f3_token_overlap", f"""{PAIRS}, o AS (SELECT s1_id, t_id, len(x.n) AS l1, len(y.n) AS l2, len(list_distinct(x.n)) AS d1, len(list_distinct(y.n)) AS d2,
  len(list_filter(list_distinct(x.n), lambda t: list_contains(y.n, t))) AS i FROM scored p JOIN v x ON p.s1_id = x.entity_id JOIN v y ON p.t_id = y.entity_id)
SELECT s1_id, t_id, CASE WHEN l1 > 0 AND l2 > 0 THEN CAST(i AS DOUBLE) END AS inter, round(CASE WHEN l1 > 0 AND l2 > 0 THEN CAST(i AS DOUBLE) / (d1 + d2 - i) END, 6) AS jacc, round(CASE WHEN l1 > 0 AND l2 > 0 THEN CAST(i AS DOUBLE) / least(d1, d2) END, 6) AS overlap FROM o""")
def f3_token_overlap(spark, sf_dir):
    stats = features.set_stats(F.col("name_tokens1"), F.col("name_tokens2"))
    return _with_views(spark, sf_dir, views_of(spark, sf_dir)).select("s1_id", "t_id", *[F.round(v, 6).alias(k) for k, v in stats.items()])


@query("f4_idf_overlap", f"{PAIRS}, {oracle.idf_ctes('name', 'n')} SELECT s1_id, t_id, round(idf_jacc, 6) + 0.0 AS idf_jacc, round(max_shared_idf, 6) + 0.0 AS max_shared_idf, round(unshared_idf, 6) + 0.0 AS unshared_idf FROM name_stat")
def f4_idf_overlap(spark, sf_dir):
    stats = features.idf_stats(F.col("name_idf1"), F.col("name_idf2"))
    views = features.with_idf(views_of(spark, sf_dir), "name_tokens", "name")
    return _with_views(spark, sf_dir, views).select("s1_id", "t_id", *[(F.round(v, 6) + 0.0).alias(k) for k, v in stats.items()])


@query("f6_f9_ratios", f"""{PAIRS}, texts AS (SELECT p.s1_id, p.t_id, x.name_core AS a, y.name_core AS b, {oracle._SORTED.format('x.name_core')} AS s, {oracle._SORTED.format('y.name_core')} AS t
  FROM scored p JOIN v x ON p.s1_id = x.entity_id JOIN v y ON p.t_id = y.entity_id
), all_of AS (SELECT a, b FROM texts UNION SELECT s, t FROM texts), {oracle.ratios('all_of', 'rat')}, {oracle.partial_ratios('texts', 'par')}, {oracle.token_sets('texts', 'tset')}
SELECT s1_id, t_id, round(q.r, 6) AS ratio, round(par.r, 6) AS partial, round(u.r, 6) AS token_sort, round(tset.r, 6) AS token_set
FROM texts x JOIN rat q ON q.a = x.a AND q.b = x.b JOIN par ON par.a = x.a AND par.b = x.b JOIN rat u ON u.a = x.s AND u.b = x.t JOIN tset ON tset.a = x.a AND tset.b = x.b""")
def f6_ratios(spark, sf_dir):
    scores = similarity.scores(F.col("name_core1"), F.col("name_core2"), "ratio", "partial", "token_sort", "token_set")
    rows = _with_views(spark, sf_dir, views_of(spark, sf_dir)).select("s1_id", "t_id", scores.alias("x")).select("s1_id", "t_id", "x.*")
    return rows.select("s1_id", "t_id", *[_r(c) for c in rows.columns[2:]])


@query("f10_jaro_winkler", f"{PAIRS} SELECT s1_id, t_id, round(CASE WHEN x.name_core = '' OR y.name_core = '' THEN CASE WHEN x.name_core = y.name_core THEN 1.0 ELSE 0.0 END ELSE jaro_winkler_similarity(x.name_core, y.name_core) END, 6) AS score FROM scored p JOIN v x ON p.s1_id = x.entity_id JOIN v y ON p.t_id = y.entity_id")
def f10_jaro_winkler(spark, sf_dir):
    scores = similarity.scores(F.col("name_core1"), F.col("name_core2"), "jaro_winkler")
    return _with_views(spark, sf_dir, views_of(spark, sf_dir)).select("s1_id", "t_id", F.round(scores["jaro_winkler"], 6).alias("score"))


_FEATURE_COLUMNS = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in features.FEATURES)


@query("f1_f28_features", f"{PAIRS}, {oracle.features()} SELECT s1_id, t_id, src, {_FEATURE_COLUMNS} FROM features")
def f_features(spark, sf_dir):
    views = views_of(spark, sf_dir)
    rows = features.build_features(views, stored(blocking.generate_candidates(views, CONFIG), "candidates"))
    return rows.select("s1_id", "t_id", "src", *[_six(c).alias(c) for c in features.FEATURES])


@query("w3_competition", f"""{PAIRS}, r AS (SELECT s1_id, t_id, src, cheap, row_number() OVER w AS rank, max(cheap) OVER p AS best, count(*) OVER p AS n,
  coalesce(nth_value(cheap, 2) OVER (PARTITION BY s1_id, src ORDER BY cheap DESC, t_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) AS second FROM scored
  WINDOW w AS (PARTITION BY s1_id, src ORDER BY cheap DESC, t_id), p AS (PARTITION BY s1_id, src))
SELECT s1_id, t_id, rank, round(cheap - CASE WHEN rank = 1 THEN second ELSE best END, 6) + 0.0 AS margin, round(best - cheap, 6) + 0.0 AS gap_to_best, n FROM r""")
def w3_competition(spark, sf_dir):
    rows = features.competition(candidate_pairs(spark, sf_dir), ["s1_id", "src"], "cheap", "c", ["t_id"])
    return rows.select("s1_id", "t_id", F.col("c_rank").cast("long").alias("rank"), _six("c_margin").alias("margin"), _six("c_gap_to_best").alias("gap_to_best"), F.col("c_n").alias("n"))


# ---------------------------------------------------------------- decisions


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision.apply_policy(labelled(spark, sf_dir), decision.Policy(threshold=oracle.THRESHOLD))


@query("w4_exclusive_best", f"{LABELLED} SELECT t_id, s1_id FROM (SELECT *, row_number() OVER (PARTITION BY t_id ORDER BY p DESC, s1_id) AS r FROM lab) WHERE r = 1")
def w4_exclusive_best(spark, sf_dir):
    return decision.exclusive_best(labelled(spark, sf_dir)).where("best").select("t_id", "s1_id")


@query("d1_threshold", f"{LABELLED} {oracle.KEPT}")
def d1_threshold(spark, sf_dir):
    return _kept(spark, sf_dir).select("s1_id", "t_id")


@query("d2_source_threshold", f"{LABELLED} SELECT s1_id, t_id FROM (SELECT *, row_number() OVER (PARTITION BY t_id ORDER BY p DESC, s1_id) AS r FROM lab) WHERE r = 1 AND p >= CASE WHEN src = 'S2' THEN 0.5 ELSE 0.7 END")
def d2_source_threshold(spark, sf_dir):
    policy = decision.Policy("source_threshold", True, 0.7, {"S2": 0.5, "S3": 0.7})
    return decision.apply_policy(labelled(spark, sf_dir), policy).select("s1_id", "t_id")


_EXPECTED = f"""{LABELLED}, best_of AS (SELECT *, row_number() OVER (PARTITION BY t_id ORDER BY p DESC, s1_id) = 1 AS best FROM lab
), exp_q AS (SELECT 0 AS g, s1_id, t_id, y, CASE WHEN best THEN pow(p, 1.25) ELSE 0 END AS q FROM best_of), exp_ranked AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY q DESC, t_id) AS r FROM exp_q
), {oracle.expected_counts('exp_ranked', 'exp_k')}"""


@query("d3_expected_f", f"{_EXPECTED} SELECT x.s1_id, x.t_id FROM exp_ranked x JOIN exp_k e ON x.s1_id = e.s1_id WHERE x.r <= e.k")
def d3_expected_f(spark, sf_dir):
    return decision.apply_policy(labelled(spark, sf_dir), decision.Policy("expected_f", True, gamma=1.25)).select("s1_id", "t_id")


_GRID = f"{LABELLED.replace('WITH ', 'WITH RECURSIVE ', 1)}, {oracle.FOLDS}, {oracle.policy_grid()}"


def _grid(spark: SparkSession, sf_dir: str):
    folds, truth = stored(folds_of(spark, sf_dir), "folds"), fixtures.truth(spark, sf_dir)
    sums, policies = decision.grid_scores(stored(labelled(spark, sf_dir), "scored"), truth, folds)
    return stored(sums, "sums"), policies, folds


@query("d5_policy_grid", f"{_GRID} SELECT fold, policy, round(f, 6) AS f FROM grid")
def d5_policy_grid(spark, sf_dir):
    sums, _, _ = _grid(spark, sf_dir)
    return sums.select("fold", "policy", _r("f"))


@query("d6_tune_policy", f"{_GRID} SELECT number, policy, family, exclusive, round(macro_f, 9) AS macro_f, chosen FROM policy_table")
def d6_tune_policy(spark, sf_dir):
    table, _ = decision.tuned(*_grid(spark, sf_dir), tolerance=oracle.DECISION.tolerance)
    return table.select("number", "policy", "family", "exclusive", _r("macro_f", 9), "chosen")


@query("d6_crossfit", f"{_GRID} SELECT crossfit FROM crossfit")
def d6_crossfit(spark, sf_dir):
    _, crossfit = decision.tuned(*_grid(spark, sf_dir), tolerance=oracle.DECISION.tolerance)
    return crossfit.select(_r("crossfit", 9))


@query("w6_policy_summary", f"{_GRID} SELECT policy, family, exclusive, round(macro_f, 9) AS macro_f FROM (SELECT *, row_number() OVER (PARTITION BY family, exclusive ORDER BY macro_f DESC, number) AS r FROM policy_table) WHERE r = 1")
def w6_policy_summary(spark, sf_dir):
    table, _ = decision.tuned(*_grid(spark, sf_dir), tolerance=oracle.DECISION.tolerance)
    return decision.policy_summary(table).select("policy", "family", "exclusive", _r("macro_f", 9))


@query("d7_predictions", f"{LABELLED}, k AS ({oracle.KEPT}) SELECT s1_id, string_agg(t_id, ' ' ORDER BY t_id) AS t_ids FROM k GROUP BY s1_id")
def d7_predictions(spark, sf_dir):
    return decision.predictions(_kept(spark, sf_dir)).select("s1_id", F.array_join("t_ids", " ").alias("t_ids"))


# ---------------------------------------------------------------- graph and model


@query("g1_components", f"""WITH RECURSIVE {BUSINESS}, e AS (SELECT DISTINCT a.s1_id AS u, b.s1_id AS v FROM truth a JOIN truth b ON a.t_id = b.t_id), reach AS (
  SELECT s1_id, s1_id AS r FROM spine UNION SELECT reach.s1_id, e.v FROM reach JOIN e ON reach.r = e.u) SELECT s1_id, min(r) AS grp FROM reach GROUP BY s1_id""")
def g1_components(spark, sf_dir):
    return graph.entity_groups(fixtures.truth(spark, sf_dir), fixtures.spine(spark, sf_dir))


@query("g2_folds", f"WITH RECURSIVE {BUSINESS}, {oracle.FOLDS} SELECT s1_id, fold FROM folds")
def g2_folds(spark, sf_dir):
    return folds_of(spark, sf_dir)


@query("a23_fold_countries", f"WITH RECURSIVE {BUSINESS}, {oracle.FOLDS} SELECT fold, country, count(*) AS n FROM folds JOIN spine USING (s1_id) GROUP BY fold, country")
def a23_fold_countries(spark, sf_dir):
    return graph.fold_table(folds_of(spark, sf_dir), fixtures.countries(spark, sf_dir))


def _trained(spark: SparkSession, sf_dir: str):
    """The matcher as it is shipped: all folds, and trees until the next fold's pairs end them."""
    views, truth = views_of(spark, sf_dir), fixtures.truth(spark, sf_dir)
    rows = stored(features.build_features(views, stored(blocking.generate_candidates(views, CONFIG), "candidates")), "features")
    config = ModelConfig()
    folds = graph.make_folds(truth, fixtures.spine(spark, sf_dir), fixtures.countries(spark, sf_dir), config.n_folds)
    return (*matcher.train_matcher(matcher.label_pairs(rows, truth), stored(folds, "folds"), config), rows)


@query("g3_g6_scores")
def g3_scores(spark, sf_dir):
    """Cross-validated scores, calibrated."""
    return _trained(spark, sf_dir)[1]


@query("s10_saved_model")
def s10_saved_model(spark, sf_dir):
    """Scores of a model that was saved and read again: the folds' mean, calibrated by steps."""
    model, _, rows = _trained(spark, sf_dir)
    folder = _place(spark, "model")
    model.save(folder)
    return matcher.Matcher.load(folder).predict(rows)


@query("a25_importances")
def a25_importances(spark, sf_dir):
    model, _, _ = _trained(spark, sf_dir)
    return spark.createDataFrame(sorted(model.importances.items()), "feature string, importance double")


# ---------------------------------------------------------------- reports


@query("a2_entity_scores", f"{SCORES} SELECT s1_id, tp, n_pred, n_true, round(f, 6) AS f, round(precision, 6) AS precision, round(recall, 6) AS recall FROM sc")
def a2_entity_scores(spark, sf_dir):
    rows = metrics.entity_scores(_kept(spark, sf_dir), fixtures.truth(spark, sf_dir), fixtures.spine(spark, sf_dir))
    return rows.select("s1_id", "tp", "n_pred", "n_true", _r("f"), _r("precision"), _r("recall"))


@query("a4_eval_headline", f"""{SCORES} SELECT round(avg(f), 6) AS macro_f, round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall,
  round(CAST(sum(tp) AS DOUBLE) / greatest(sum(n_pred), 1), 6) AS pair_precision, round(CAST(sum(tp) AS DOUBLE) / greatest(sum(n_true), 1), 6) AS pair_recall,
  round(avg(CASE WHEN n_true = 0 THEN 1.0 ELSE 0.0 END), 6) AS singleton_share, round(avg(CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END END), 6) AS singleton_accuracy,
  round(avg(CASE WHEN n_true > 0 THEN f END), 6) AS f_non_singletons, round(avg(CASE WHEN n_true > 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END END), 6) AS non_singletons_empty FROM sc""")
def a4_eval_headline(spark, sf_dir):
    rows = metrics.headline(metrics.entity_scores(_kept(spark, sf_dir), fixtures.truth(spark, sf_dir), fixtures.spine(spark, sf_dir)))
    return rows.select(*[_r(c) for c in rows.columns])


@query("a5_by_cardinality", f"{SCORES} SELECT CASE WHEN n_true >= 3 THEN '3+' ELSE CAST(n_true AS VARCHAR) END AS bucket, count(*) AS entities, round(avg(f), 6) AS macro_f, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall FROM sc GROUP BY 1")
def a5_by_cardinality(spark, sf_dir):
    rows = metrics.by_cardinality(metrics.entity_scores(_kept(spark, sf_dir), fixtures.truth(spark, sf_dir), fixtures.spine(spark, sf_dir)))
    return rows.select("bucket", "entities", _r("macro_f"), _r("precision"), _r("recall"))


@query("a6_by_country", f"{SCORES} SELECT country, count(*) AS entities, round(avg(f), 6) AS macro_f, round(avg(CASE WHEN n_true = 0 THEN 1.0 ELSE 0.0 END), 6) AS singleton_share, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall FROM sc GROUP BY country")
def a6_by_country(spark, sf_dir):
    rows = metrics.by_country(metrics.entity_scores(_kept(spark, sf_dir), fixtures.truth(spark, sf_dir), fixtures.spine(spark, sf_dir)), fixtures.countries(spark, sf_dir))
    return rows.select("country", "entities", _r("macro_f"), _r("singleton_share"), _r("precision"), _r("recall"))


def _one_source(source: str) -> str:
    own = oracle.entity_scores(f"{oracle.KEPT} AND src = '{source}'", f"SELECT DISTINCT s1_id, t_id FROM truth WHERE t_id LIKE '{source}-%'")
    return f"{LABELLED}, {own} SELECT '{source}' AS target_source, round(avg(f), 6) AS macro_f, round(CAST(sum(tp) AS DOUBLE) / greatest(sum(n_pred), 1), 6) AS pair_precision, round(CAST(sum(tp) AS DOUBLE) / greatest(sum(n_true), 1), 6) AS pair_recall FROM sc"


@query("a7_by_source", f"SELECT * FROM ({_one_source('S2')}) UNION ALL SELECT * FROM ({_one_source('S3')})")
def a7_by_source(spark, sf_dir):
    rows = metrics.by_source(stored(_kept(spark, sf_dir), "kept"), fixtures.truth(spark, sf_dir), fixtures.spine(spark, sf_dir))
    return rows.select("target_source", _r("macro_f"), _r("pair_precision"), _r("pair_recall"))


@query("a8_blocking_headline", f"""{PAIRS}, per AS (SELECT s.s1_id, coalesce(n, 0) AS n FROM spine s LEFT JOIN (SELECT s1_id, count(*) AS n FROM scored GROUP BY s1_id) c ON s.s1_id = c.s1_id
), f AS (SELECT t.s1_id, CASE WHEN p.s1_id IS NULL THEN 0.0 ELSE 1.0 END AS found FROM (SELECT DISTINCT * FROM truth) t LEFT JOIN scored p ON t.s1_id = p.s1_id AND t.t_id = p.t_id
), u AS (SELECT s.s1_id, CASE WHEN n IS NULL THEN 1.0 ELSE 1.25 * k / (0.25 * n + k + CASE WHEN k = 0 THEN 1e-300 ELSE 0 END) END AS up FROM spine s LEFT JOIN (SELECT s1_id, count(*) AS n, sum(found) AS k FROM f GROUP BY s1_id) x ON s.s1_id = x.s1_id)
SELECT CAST((SELECT sum(n) FROM per) AS BIGINT) AS candidate_pairs, round((SELECT avg(n) FROM per), 6) AS per_s1_mean, round((SELECT quantile_cont(n, 0.95) FROM per), 6) AS per_s1_p95, CAST((SELECT max(n) FROM per) AS BIGINT) AS per_s1_max,
  (SELECT count(*) FROM per WHERE n = 0) AS s1_without, round(1 - CAST((SELECT sum(n) FROM per) AS DOUBLE) / ((SELECT count(*) FROM spine) * (SELECT count(*) FROM docs WHERE source <> 'S1')), 6) AS reduction_ratio,
  round((SELECT avg(found) FROM f), 6) AS pair_recall, round((SELECT avg(a) FROM (SELECT min(found) AS a FROM f GROUP BY s1_id)), 6) AS s1_all_retrieved, round((SELECT avg(up) FROM u), 6) AS macro_f_upper_bound""")
def a8_blocking_headline(spark, sf_dir):
    rows = metrics.blocking_headline(candidate_pairs(spark, sf_dir), fixtures.truth(spark, sf_dir), fixtures.spine(spark, sf_dir), fixtures.business(spark, sf_dir).where("source <> 'S1'").count())
    whole = ("candidate_pairs", "per_s1_max", "s1_without")
    return rows.select(*[F.col(c).cast("long").alias(c) if c in whole else F.round(F.col(c).cast("double"), 6).alias(c) for c in rows.columns])


_FOUND = "FROM (SELECT DISTINCT * FROM truth) t LEFT JOIN scored p ON t.s1_id = p.s1_id AND t.t_id = p.t_id"


@query("a9_recall_by_source", f"{PAIRS} SELECT substr(t.t_id, 1, 2) AS src, count(*) AS true_pairs, round(avg(CASE WHEN p.s1_id IS NULL THEN 0.0 ELSE 1.0 END), 6) AS recall {_FOUND} GROUP BY 1")
def a9_recall_by_source(spark, sf_dir):
    return metrics.recall_by(candidate_pairs(spark, sf_dir), fixtures.truth(spark, sf_dir)).select("src", "true_pairs", _r("recall"))


@query("a9_recall_by_country", f"{PAIRS} SELECT s.country, count(*) AS true_pairs, round(avg(CASE WHEN p.s1_id IS NULL THEN 0.0 ELSE 1.0 END), 6) AS recall {_FOUND} JOIN spine s ON s.s1_id = t.s1_id GROUP BY 1")
def a9_recall_by_country(spark, sf_dir):
    return metrics.recall_by(candidate_pairs(spark, sf_dir), fixtures.truth(spark, sf_dir), fixtures.countries(spark, sf_dir)).select("country", "true_pairs", _r("recall"))


_BLOCKER_ROWS = " UNION ALL ".join(
    f"SELECT '{b}' AS blocker, (SELECT count(*) FROM f WHERE b & {blocking.BIT[b]} <> 0) AS alone, (SELECT count(*) FROM f WHERE b & {2 * blocking.BIT[b] - 1} <> 0) AS cumulative, (SELECT count(*) FROM f WHERE b = {blocking.BIT[b]}) AS only_here, (SELECT count(*) FROM scored WHERE bits & {blocking.BIT[b]} <> 0) AS pairs_flagged"
    for b in blocking.BLOCKERS)


@query("a10_by_blocker", f"""{PAIRS}, f AS (SELECT coalesce(p.bits, 0) AS b {_FOUND}), n AS (SELECT greatest(count(*), 1) AS n FROM f)
SELECT blocker, round(CAST(alone AS DOUBLE) / n, 6) AS recall_alone, round(CAST(cumulative AS DOUBLE) / n, 6) AS cumulative_recall, only_here, pairs_flagged FROM ({_BLOCKER_ROWS}) CROSS JOIN n""")
def a10_by_blocker(spark, sf_dir):
    rows = metrics.by_blocker(candidate_pairs(spark, sf_dir), fixtures.truth(spark, sf_dir))
    return rows.select("blocker", _r("recall_alone"), _r("cumulative_recall"), "only_here", "pairs_flagged")


@query("a11_truth_contract", f"""WITH {BUSINESS}, {_FAULTY}, gt AS (SELECT c1 AS s1_id, list_filter(list_transform(string_split(CASE WHEN n = 1 THEN '' ELSE c2 END, ','), lambda x: trim(x)), lambda x: x <> '') AS ids FROM faulty
), named AS (SELECT s1_id, unnest(ids) AS t_id FROM gt), known AS (SELECT entity_id AS t_id FROM recs WHERE source <> 'S1'), checks AS (
SELECT 'S1 ids missing from ground truth' AS "check", count(*) AS value, true AS zero FROM spine WHERE s1_id NOT IN (SELECT s1_id FROM gt)
UNION ALL SELECT 'ground-truth rows with unknown S1 id', count(*), true FROM gt WHERE s1_id NOT IN (SELECT s1_id FROM spine)
UNION ALL SELECT 'duplicated S1 rows in ground truth', count(*) - count(DISTINCT s1_id), true FROM gt
UNION ALL SELECT 'matched ids not found in S2/S3', count(*), true FROM named WHERE t_id NOT IN (SELECT t_id FROM known)
UNION ALL SELECT 'self matches / S1 ids in matched lists', count(*), true FROM named WHERE t_id LIKE 'S1-%'
UNION ALL SELECT 'rows with duplicated ids inside the list', count(*), true FROM gt WHERE len(ids) <> len(list_distinct(ids))
UNION ALL SELECT 'targets linked to >1 S1 entity', count(*), false FROM (SELECT t_id FROM named GROUP BY t_id HAVING count(DISTINCT s1_id) > 1))
SELECT "check", value, NOT zero OR value = 0 AS ok FROM checks""")
def a11_truth_contract(spark, sf_dir):
    """Of a ground truth with faults of every kind."""
    lists = _faulty(spark, sf_dir).select(F.col("fields")[0].alias("source1_entity_id"), F.coalesce(F.get("fields", F.lit(1)), F.lit("")).alias("matched_entity_ids"))
    return check_ground_truth(_split(spark, sf_dir, lists))


@query("a12_split_summary", f"""WITH {BUSINESS} SELECT lower(source) AS what, count(*) AS n FROM recs GROUP BY 1 UNION ALL SELECT 'positive_pairs', count(*) FROM (SELECT DISTINCT * FROM truth)
UNION ALL SELECT 'singletons', count(*) FROM spine WHERE s1_id NOT IN (SELECT s1_id FROM truth)""")
def a12_split_summary(spark, sf_dir):
    return summary_table(_split(spark, sf_dir, _lists(spark, sf_dir).toDF(*records.TRUTH_COLUMNS)))


@query("a13_overview", f"WITH {BUSINESS}, c AS (SELECT source, {oracle.label('country')} AS label, count(*) AS n FROM docs GROUP BY 1, 2) SELECT source, CAST(sum(n) AS BIGINT) AS records, string_agg(label || '=' || CAST(n AS VARCHAR), ', ' ORDER BY n DESC, label) AS countries FROM c GROUP BY source")
def a13_overview(spark, sf_dir):
    return explore.overview(fixtures.business(spark, sf_dir))


@query("a13_country_table", f"WITH {BUSINESS} SELECT {oracle.label('country')} AS country, count(CASE WHEN source = 'S1' THEN 1 END) AS S1, count(CASE WHEN source = 'S2' THEN 1 END) AS S2, count(CASE WHEN source = 'S3' THEN 1 END) AS S3 FROM docs GROUP BY 1")
def a13_country_table(spark, sf_dir):
    return explore.country_table(fixtures.business(spark, sf_dir))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.match_counts(fixtures.truth(spark, sf_dir), fixtures.spine(spark, sf_dir), fixtures.countries(spark, sf_dir))


_COUNTS = f"WITH {BUSINESS}, c AS (SELECT s.s1_id, {oracle.label('s.country')} AS country, count(t.t_id) AS n_total, count(CASE WHEN t.t_id LIKE 'S2-%' THEN 1 END) AS n_s2, count(CASE WHEN t.t_id LIKE 'S3-%' THEN 1 END) AS n_s3 FROM spine s LEFT JOIN truth t ON s.s1_id = t.s1_id GROUP BY s.s1_id, s.country)"


@query("a14_cardinality", f"""{_COUNTS}, g AS (SELECT 'all' AS grp, n_total FROM c UNION ALL SELECT country, n_total FROM c), b AS (SELECT grp, CASE WHEN n_total >= 3 THEN '3+' ELSE CAST(n_total AS VARCHAR) END AS bucket, count(*) AS n FROM g GROUP BY 1, 2)
SELECT grp, bucket, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY grp), 6) AS share FROM b""")
def a14_cardinality(spark, sf_dir):
    return explore.cardinality_shares(_counts(spark, sf_dir)).select("grp", "bucket", _r("share"))


@query("a14_cardinality_by_source", f"""{_COUNTS}, b AS (SELECT 's2' AS src, CASE WHEN n_s2 >= 3 THEN '3+' ELSE CAST(n_s2 AS VARCHAR) END AS matches FROM c UNION ALL SELECT 's3', CASE WHEN n_s3 >= 3 THEN '3+' ELSE CAST(n_s3 AS VARCHAR) END FROM c)
SELECT matches, round(count(CASE WHEN src = 's2' THEN 1 END) / CAST((SELECT count(*) FROM c) AS DOUBLE), 6) AS s2, round(count(CASE WHEN src = 's3' THEN 1 END) / CAST((SELECT count(*) FROM c) AS DOUBLE), 6) AS s3 FROM b GROUP BY matches""")
def a14_cardinality_by_source(spark, sf_dir):
    return explore.cardinality_by_source(_counts(spark, sf_dir)).select("matches", _r("s2"), _r("s3"))


@query("a14_cardinality_stats", f"""{_COUNTS} SELECT round(avg(n_total), 6) AS mean_matches, max(n_total) AS max_matches, max(n_s2) AS max_s2, max(n_s3) AS max_s3,
  round(avg(CASE WHEN n_s2 > 0 AND n_s3 > 0 THEN 1.0 ELSE 0.0 END), 6) AS in_both, round(avg(CASE WHEN n_s2 > 1 OR n_s3 > 1 THEN 1.0 ELSE 0.0 END), 6) AS several_in_one FROM c""")
def a14_cardinality_stats(spark, sf_dir):
    rows = explore.cardinality_stats(_counts(spark, sf_dir))
    return rows.select(_r("mean_matches"), "max_matches", "max_s2", "max_s3", _r("in_both"), _r("several_in_one"))


@query("a15_target_usage", f"""WITH {BUSINESS}, u AS (SELECT t_id, count(DISTINCT s1_id) AS n FROM truth GROUP BY t_id) SELECT CAST(n AS BIGINT) AS s1_linked, count(*) AS targets FROM u GROUP BY n
UNION ALL SELECT 0, (SELECT count(*) FROM docs WHERE source <> 'S1') - (SELECT count(*) FROM u)""")
def a15_target_usage(spark, sf_dir):
    return explore.target_usage(fixtures.truth(spark, sf_dir), fixtures.business(spark, sf_dir).where("source <> 'S1'"))


@query("a16_country_consistency", f"""WITH {BUSINESS}, k AS (SELECT entity_id, country, {oracle.label('country')} AS label, {oracle.MISSING.format('country')} AS gone, lower(strip_accents(country)) AS norm FROM docs)
SELECT x.label AS s1_country, substr(t.t_id, 1, 2) AS target_source, count(CASE WHEN NOT x.gone AND NOT y.gone AND x.norm = y.norm THEN 1 END) AS same, count(CASE WHEN NOT x.gone AND NOT y.gone AND x.norm <> y.norm THEN 1 END) AS different,
  count(CASE WHEN x.gone OR y.gone THEN 1 END) AS missing FROM truth t JOIN k x ON t.s1_id = x.entity_id JOIN k y ON t.t_id = y.entity_id GROUP BY 1, 2""")
def a16_country_consistency(spark, sf_dir):
    return explore.country_consistency(fixtures.business(spark, sf_dir), fixtures.truth(spark, sf_dir))


def _completeness(ctes: str) -> str:
    share = lambda c, name: f"round(avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END), 3) AS {name}"
    return f"""WITH {ctes} SELECT source, {oracle.label('country_raw')} AS country, {share('name_missing', 'name_missing')}, {share('addr_missing', 'addr_missing')}, {share('len(postal) > 0', 'postal')}, {share("house <> ''", 'house')},
  {share('landmark', 'landmark')}, {share('len(alts) > 0', 'alternates')}, {share("legal <> ''", 'legal_form')}, round(avg(len(n)), 3) AS name_tokens, round(avg(len(a)), 3) AS addr_tokens FROM v GROUP BY 1, 2"""


@query("a17_completeness", _completeness(VIEWS))
def a17_completeness(spark, sf_dir):
    return explore.completeness(views_of(spark, sf_dir))


@query("a17_completeness_documents", _completeness(oracle.DOCUMENT_VIEWS))
def a17_completeness_documents(spark, sf_dir):
    return explore.completeness(normalize.normalize_records(fixtures.documents(spark, sf_dir)))


def _drawn(parts: str) -> str:
    return f"CAST('0x' || substr(md5({parts}), 1, 8) AS BIGINT)"


def _pick(what: str, top: str) -> str:
    return f"{_drawn(f'concat_ws(chr(124), s1_id, t_id, i, {chr(39)}0 {what}{chr(39)})')} % {top}"


_PROFILE = f"""WITH {VIEWS}, {oracle.CHARS}, {oracle.SIM}, n1 AS (
  SELECT s1_id, b, row_number() OVER (PARTITION BY b ORDER BY h, s1_id) AS place FROM (SELECT entity_id AS s1_id, h % 256 AS b, h FROM (SELECT entity_id, {_drawn("entity_id || '|0 s1_id'")} AS h FROM v WHERE source = 'S1'))
), n2 AS (
  SELECT t_id, src, b, row_number() OVER (PARTITION BY src, b ORDER BY h, t_id) AS place FROM (SELECT entity_id AS t_id, source AS src, h % 256 AS b, h FROM (SELECT entity_id, source, {_drawn("entity_id || '|0 t_id'")} AS h FROM v WHERE source <> 'S1'))
), l1 AS (SELECT list(b ORDER BY b) AS bs, list(m ORDER BY b) AS ms FROM (SELECT b, max(place) AS m FROM n1 GROUP BY b)
), l2 AS (SELECT src, list(b ORDER BY b) AS bs, list(m ORDER BY b) AS ms FROM (SELECT src, b, max(place) AS m FROM n2 GROUP BY src, b) GROUP BY src
), draws AS (SELECT substr(t_id, 1, 2) AS src, s1_id, t_id, unnest(['1', '2']) AS i FROM truth
), buckets AS (SELECT d.*, l1.bs AS b1, l1.ms AS m1, l2.bs AS b2, l2.ms AS m2, {_pick('left', 'len(l1.bs)')} + 1 AS x1, {_pick('right', 'len(l2.bs)')} + 1 AS x2 FROM draws d JOIN l2 ON d.src = l2.src CROSS JOIN l1
), placed AS (SELECT src, b1[x1] AS b, {_pick('first', 'm1[x1]')} + 1 AS place, b2[x2] AS bt, {_pick('second', 'm2[x2]')} + 1 AS pt FROM buckets
), profile AS (
  SELECT s1_id, t_id, substr(t_id, 1, 2) AS src, 'match' AS label FROM truth
  UNION ALL SELECT n1.s1_id, n2.t_id, p.src, 'random non-match' FROM placed p JOIN n1 ON n1.b = p.b AND n1.place = p.place JOIN n2 ON n2.src = p.src AND n2.b = p.bt AND n2.place = p.pt
), names_of AS (SELECT x.name_core AS a, y.name_core AS b FROM profile p JOIN v x ON p.s1_id = x.entity_id JOIN v y ON p.t_id = y.entity_id), {oracle.token_sets('names_of', 'tset')}"""


@query("a18_similarity_profile", f"""{_PROFILE} SELECT label, p.src AS target_source, x.country_raw AS country, round(coalesce(name_cos, 0), 6) AS name_char_cos,
  round(CASE WHEN NOT (x.addr_missing OR y.addr_missing) THEN coalesce(addr_cos, 0) END, 6) AS addr_char_cos, round(tset.r, 6) AS name_token_set
FROM profile p JOIN v x ON p.s1_id = x.entity_id JOIN v y ON p.t_id = y.entity_id LEFT JOIN sim ON sim.s1_id = p.s1_id AND sim.t_id = p.t_id JOIN tset ON tset.a = x.name_core AND tset.b = y.name_core""")
def a18_similarity_profile(spark, sf_dir):
    views = views_of(spark, sf_dir)
    rows = explore.similarity_profile(views, fixtures.truth(spark, sf_dir), vectors.char_tfidf(views, "name_core"), vectors.char_tfidf(views, "addr_core"))
    return rows.select("label", "target_source", "country", _six("name_char_cos").alias("name_char_cos"), _six("addr_char_cos").alias("addr_char_cos"), _r("name_token_set"))


@query("a19_reliability", f"{LABELLED} SELECT CAST(least(floor(p * 10), 9) AS BIGINT) AS bin, round(avg(p), 6) AS mean_p, round(avg(y), 6) AS mean_y, count(*) AS n FROM lab GROUP BY 1 HAVING count(*) >= 20")
def a19_reliability(spark, sf_dir):
    return metrics.reliability(labelled(spark, sf_dir)).select(F.col("bin").cast("long").alias("bin"), _r("mean_p"), _r("mean_y"), "n")


_POINTS = [i / 100 for i in range(5, 100, 5)]


@query("a20_survival", f"{LABELLED}, b AS (SELECT src, s1_id, max(p) AS p FROM lab GROUP BY src, s1_id), g AS (SELECT unnest({_POINTS}) AS point) SELECT src, CAST(point AS DOUBLE) AS point, round(avg(CASE WHEN p >= CAST(point AS DOUBLE) THEN 1.0 ELSE 0.0 END), 6) AS share FROM b CROSS JOIN g GROUP BY src, point")
def a20_survival(spark, sf_dir):
    return metrics.survival(labelled(spark, sf_dir), "src", _POINTS).select("src", "point", _r("share"))


@query("a21_feature_separation", LABELLED + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(quantile_cont(CASE WHEN y = 1 THEN {c} END, 0.5), 6) AS median_match, round(quantile_cont(CASE WHEN y = 0 THEN {c} END, 0.5), 6) AS median_other, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing FROM lab"
    for c in ("name_cos", "addr_cos", "p")))
def a21_feature_separation(spark, sf_dir):
    return metrics.feature_separation(labelled(spark, sf_dir), ["name_cos", "addr_cos", "p"]).select("feature", _r("median_match"), _r("median_other"), _r("missing"))


@query("a22_prediction_sanity", f"""{LABELLED}, k AS ({oracle.KEPT}), c AS (SELECT s.country, s.s1_id, count(k.t_id) AS n, count(CASE WHEN k.t_id LIKE 'S2-%' THEN 1 END) AS n2, count(CASE WHEN k.t_id LIKE 'S3-%' THEN 1 END) AS n3 FROM spine s LEFT JOIN k ON s.s1_id = k.s1_id GROUP BY s.country, s.s1_id)
SELECT country, count(*) AS entities, round(avg(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END), 6) AS with_match, round(avg(n), 6) AS mean_matches, round(avg(n2), 6) AS mean_s2, round(avg(n3), 6) AS mean_s3 FROM c GROUP BY country""")
def a22_prediction_sanity(spark, sf_dir):
    rows = metrics.prediction_sanity(_kept(spark, sf_dir), fixtures.spine(spark, sf_dir), fixtures.countries(spark, sf_dir))
    return rows.select("country", "entities", *[_r(c) for c in ("with_match", "mean_matches", "mean_s2", "mean_s3")])


@query("a24_ranking_metrics", f"""{LABELLED}, g AS (SELECT p, sum(y) AS pos, count(*) AS n FROM lab GROUP BY p), c AS (SELECT p, pos, n, sum(pos) OVER w AS tp, sum(n) OVER w AS seen FROM g WINDOW w AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT round(sum((n - pos) * (tp - pos) + (n - pos) * pos / 2.0) / (sum(pos) * sum(n - pos)), 6) AS auc, round(sum(pos * CAST(tp AS DOUBLE) / seen) / sum(pos), 6) AS average_precision FROM c""")
def a24_ranking_metrics(spark, sf_dir):
    return metrics.ranking_metrics(labelled(spark, sf_dir)).select(_r("auc"), _r("average_precision"))


_PAIR_TEXTS = "x.business_name AS s1_name, x.business_address AS s1_address, x.country AS s1_country, y.business_name AS t_name, y.business_address AS t_address, y.country AS t_country"


def _errors(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    scored = stored(labelled(spark, sf_dir), "scored")
    found = explore.errors(scored, decision.apply_policy(scored, decision.Policy(threshold=oracle.THRESHOLD)), fixtures.business(spark, sf_dir))[which]
    return found.select("s1_id", "t_id", _r("p"), "s1_name", "s1_address", "s1_country", "t_name", "t_address", "t_country")


@query("s10_false_positives", f"""{LABELLED}, top AS (SELECT * FROM lab WHERE y = 0 AND p >= {oracle.THRESHOLD} ORDER BY p DESC, s1_id, t_id LIMIT 20)
SELECT s1_id, t_id, round(p, 6) AS p, {_PAIR_TEXTS} FROM top JOIN recs x ON s1_id = x.entity_id JOIN recs y ON t_id = y.entity_id""")
def s10_false_positives(spark, sf_dir):
    """The twenty most probable wrong matches."""
    return _errors(spark, sf_dir, "false_positives")


@query("s10_false_negatives", f"""{LABELLED}, top AS (SELECT * FROM lab WHERE y = 1 AND p < {oracle.THRESHOLD} ORDER BY p, s1_id, t_id LIMIT 20)
SELECT s1_id, t_id, round(p, 6) AS p, {_PAIR_TEXTS} FROM top JOIN recs x ON s1_id = x.entity_id JOIN recs y ON t_id = y.entity_id""")
def s10_false_negatives(spark, sf_dir):
    """The twenty least probable missed matches."""
    return _errors(spark, sf_dir, "false_negatives")


@query("a22_unseen_labels", f"""{LABELLED}, k AS ({oracle.KEPT}), unseen AS (SELECT DISTINCT country FROM spine WHERE lower(country) NOT IN (SELECT lower(country) FROM docs WHERE source <> 'S1')
), firsts AS (SELECT s1_id FROM (SELECT s1_id, row_number() OVER (PARTITION BY country ORDER BY s1_id) AS r FROM spine WHERE country IN (SELECT country FROM unseen)) WHERE r <= 5)
SELECT f.s1_id, k.t_id, {_PAIR_TEXTS} FROM firsts f LEFT JOIN k ON f.s1_id = k.s1_id LEFT JOIN recs x ON f.s1_id = x.entity_id LEFT JOIN recs y ON k.t_id = y.entity_id""")
def a22_unseen_labels(spark, sf_dir):
    """Samples of records whose label only S1 has, with what they were matched to: the view of labels that training hasn't seen."""
    rows = fixtures.business(spark, sf_dir)
    there = rows.where("source <> 'S1'").select(F.lower("country").alias("l")).distinct()
    unseen = rows.where("source = 'S1'").select("country", F.lower("country").alias("l")).distinct().join(there, "l", "left_anti")
    return explore.unmatched_labels(_kept(spark, sf_dir), rows, unseen)
