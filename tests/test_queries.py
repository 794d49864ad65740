"""Every registered query of the linkage gives rows, and the same ones in Spark and in DuckDB where it has SQL."""

import pytest
from conftest import duck, rows_of

from kithlink.operators import blocking
from kithlink.plans import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def computed_once():
    """What many queries begin with is computed once for this module's queries; each query does it for itself elsewhere."""
    names, kept, found = ("views_of", "candidate_pairs", "labelled", "folds_of", "_grid", "_trained"), {}, {}
    for name in names:
        kept[name] = getattr(queries, name)

        def once(spark, folder, name=name):
            if (name, folder) not in found:
                found[name, folder] = kept[name](spark, folder)
            return found[name, folder]

        setattr(queries, name, once)
    yield
    for name in names:
        setattr(queries, name, kept[name])


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    assert got, "a query without rows shows nothing"
    if name in queries.ORACLE_SQL:
        columns, rows = duck(SF, queries.ORACLE_SQL[name])
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(columns, rows)


def test_what_has_no_sql():
    assert set(queries.QUERIES) - set(queries.ORACLE_SQL) == {"g3_g6_scores", "s10_saved_model", "a25_importances"}


def test_all_blockers_and_features_are_exercised(spark):
    rows = {r["blocker"]: r["pairs_flagged"] for r in queries.QUERIES["a10_by_blocker"](spark, SF).collect()}
    assert all(rows[b] > 0 for b in blocking.BLOCKERS)
    table = queries.QUERIES["f1_f28_features"](spark, SF).drop("s1_id", "t_id", "src")
    values = table.toPandas().nunique()
    assert values[values < 2].index.tolist() == []  # no column is constant


def test_long_texts_differ(spark, tmp_path):
    start = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30))
    rows = [(0, f"{start} alpha", "en", "s0", 0), (1, f"{start} beta", "en", "s0", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["addr_core"].split()[-1] for r in queries.QUERIES["t9_t13_documents"](spark, str(tmp_path)).collect()} == {"alpha", "beta"}
    assert {r["addr_tokens"] for r in queries.QUERIES["a17_completeness_documents"](spark, str(tmp_path)).collect()} == {25.0}
    assert oracle.CONFIG == queries.CONFIG
