"""Repeated rows take no neighbour's place in the multi-index."""

import numpy as np

from kithlink.llm import multiindex
from kithlink.llm.common import importable


def test_rows_many_times(spark):
    importable(spark)
    vectors = np.random.default_rng(9).normal(size=(60, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors) for _ in range(25)], "vec_id long, embedding array<double>")
    got = multiindex.nearest(table, table.where("vec_id < 3"), 20).toPandas()
    assert len(got) == 60
    for q, own in got.sort_values("rank").groupby("query_id"):
        scores = (vectors * vectors[q]).sum(axis=1)
        scores[q] = -np.inf
        assert own["vec_id"].tolist() == np.lexsort((np.arange(60), -scores))[:20].tolist()
