"""Benchmark passages with a changed word are found, other texts are not."""

import random

from test_operators import prose

from kithlink.llm import decontam


def test_one_changed_word(spark):
    rng = random.Random(12)
    items = [prose(rng, n).split() for n in (16, 20, 36, 59, 90)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    rows, want = [], set()
    for i, w in enumerate(items):
        for at in {1, len(w) // 2, len(w) - 2, len(w) - 1}:
            for middle in (["changed"], [], ["added", w[at]]):
                want.add((len(rows), i))
                rows.append((len(rows), " ".join([prose(rng, 30), *w[:at], *middle, *w[at + 1 :], prose(rng, 30)])))
    for w in items:  # half of an item, and an item with every fourth word changed
        rows.append((len(rows), " ".join([prose(rng, 30), *w[: len(w) // 2], prose(rng, 30)])))
        rows.append((len(rows), " ".join([prose(rng, 30), *["changed" if k % 4 == 0 else x for k, x in enumerate(w)], prose(rng, 30)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()} == want
    assert {r["doc_id"] for r in decontam.drop_contaminated(docs, bench).collect()} == {d for d, _ in rows} - {d for d, _ in want}
