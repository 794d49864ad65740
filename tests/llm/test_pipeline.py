"""The pipeline's rows against its stages in plain Python, and what each stage keeps."""

import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_operators import plain_components, plain_contamination, plain_fingerprint, plain_language, plain_mix

from kithlink.llm import langid, simhash
from kithlink.llm.common import importable

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark):
    return [r.asDict() for r in corpus_pipeline.run(importable(spark), SF).collect()]


def test_against_plain_stages(spark, result):
    """Row by row: languages, classes, items and copies as plain Python finds them; shards by running sums."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    model = langid.learn(docs)
    judged = {r["doc_id"]: plain_language(r["text"] or "", model) for r in rows}
    rows = [r for r in rows if judged[r["doc_id"]] and judged[r["doc_id"]][1] >= 0.3]
    classes = plain_components([r["doc_id"] for r in rows], [plain_fingerprint(r["text"]) for r in rows])
    rows = [r for r in rows if classes[r["doc_id"]] == r["doc_id"]]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {d for d, _ in plain_contamination(bench, [(r["doc_id"], r["text"]) for r in rows])}
    assert held
    rows = [r for r in rows if r["doc_id"] not in held]
    copies = {r["doc_id"]: k for r, (_, _, _, k) in zip(rows, plain_mix([(r["doc_id"], r["text"], r["source"]) for r in rows]), strict=True)}
    want = sorted(i for i, k in copies.items() for _ in range(k))
    assert sorted(r["doc_id"] for r in result) == want and 0 < min(copies.values()) + 1 and max(copies.values()) <= 3
    texts = {r["doc_id"]: r for r in rows}
    total, before, slots = sum(len(texts[i]["text"].encode()) + 1 for i in want), 0, {}
    got = sorted((r["doc_id"], r["shard"], r["slot"]) for r in result)
    for i, (doc, shard, slot) in zip(want, got, strict=True):
        assert doc == i and shard == before * 16 // total and slot == slots.get(shard, 0)
        slots[shard] = slot + 1
        before += len(texts[i]["text"].encode()) + 1
    assert all(r[c] == texts[r["doc_id"]][c] for r in result for c in ("text", "lang", "source", "n_chars"))


def test_shards(result):
    sums = {}
    for r in result:
        assert r["size"] == len(r["text"].encode()) + 1 and r["text_crc32"] == zlib.crc32(r["text"].encode())
        sums.setdefault(r["shard"], []).append(r)
    largest = max(r["size"] for r in result)
    total = sum(r["size"] for r in result)
    for rows in sums.values():
        assert sum(r["size"] for r in rows) <= total / 16 + largest and sorted(r["slot"] for r in rows) == list(range(len(rows)))


def test_stages_keep_the_columns(spark):
    docs = importable(spark).read.parquet(f"{SF}/documents.parquet").withColumn("n_chars", F.lit(None).cast("long"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


CLASHES = ("_size", "_target", "_copies", "_source_size", "_key", "_own_0", "score", "lang_pred", "size", "shard", "slot", "law", "a.b", "_id", "_row", "row", "fp", "_keep0", "component")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_clashing_columns(spark, name):
    """Columns with the names of helpers, one with a dot, a map, repeated ids, null ids and texts: the rows are those without the extra columns."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = importable(spark).read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = docs.limit(4).withColumn("text", F.concat("text", F.lit(" and some more words"))).unionByName(docs.limit(3))
    odd = odd.unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long"))).unionByName(docs.limit(2).withColumn("text", F.lit(None).cast("string")))
    plain = docs.unionByName(odd)
    wide = plain.select("*", *[F.concat(F.lit("x"), F.coalesce(F.col("doc_id"), F.lit(0)).cast("string")).alias(c) for c in CLASHES], F.create_map(F.lit("k"), F.length("source")).alias("m"))
    got = stage(spark, wide, SF)
    last = name == corpus_pipeline.STAGES[-1][0]
    assert last or got.columns == wide.columns
    own = plain.columns if not last else [*plain.columns, "size", "shard", "slot"]
    key = lambda df: sorted(tuple(map(str, r)) for r in df.select(*own).collect())
    assert key(got) == key(stage(spark, plain, SF))
    carried = got.select(F.col("`a.b`").alias("v"), "m", "doc_id").collect()
    assert carried and all(r["v"] == f"x{r['doc_id'] or 0}" and r["m"] for r in carried if r["doc_id"] is not None)
    if last:
        assert {"_shard", "_law", "__size"} <= set(got.columns)


def test_rows_of_one_id_with_other_texts_stay(spark):
    texts = ["alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine", "red orange yellow green blue indigo violet black white"]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (7, texts[0]), (7, texts[2]), (None, texts[0]), (None, texts[0])]
    docs = importable(spark).createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one_each(docs).collect()), key=str)
    assert kept == sorted([(1, texts[0]), (1, texts[1]), (7, texts[2]), (None, texts[0]), (None, texts[0])], key=str)


def test_stored_tables_are_deleted(spark, tmp_path):
    from kithlink.llm import common

    docs = importable(spark).read.parquet(f"{SF}/documents.parquet").limit(20)
    with common.scratch():
        inside = common.materialise(docs, "inside")
        kept = common.materialise(inside, "kept", lasting=True)
    assert kept.count() == 20
    path = spark._jvm.org.apache.hadoop.fs.Path(inside._kithlink_path)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
