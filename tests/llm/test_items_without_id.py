"""Benchmark items without an id are found and dropped like others."""

import random

from test_operators import prose

from kithlink.llm import decontam


def test_null_item_ids(spark):
    rng = random.Random(14)
    items = [(None, prose(rng, 30)), (None, prose(rng, 20)), (5, prose(rng, 25)), (None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{prose(rng, 20)} {t}") for i, (_, t) in enumerate(items[:3])] + [(3, prose(rng, 60))], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()} == {(0, None), (1, None), (2, 5)}
    assert [r["doc_id"] for r in decontam.drop_contaminated(docs, bench).collect()] == [3]
