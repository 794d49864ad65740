"""Linking of records that arrive on a stream against a table of targets.

The linkage itself is a batch; this is an addition. Normalisation is a stateless projection, so it runs on a
stream as it is. Exact keys are a stream-static join; each micro-batch can also be scored in full with ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BlockingConfig
from ..operators import blocking, normalize


def normalize_stream(records: DataFrame) -> DataFrame:
    """``records`` may be a stream."""
    return normalize.normalize_records(records)


def exact_key_stream(incoming: DataFrame, targets: DataFrame, config: BlockingConfig | None = None) -> DataFrame:
    """s1_id, t_id and src of incoming S1 records and targets that share a key; pairs that share both keys come twice. ``targets`` are normalised."""
    config = config or BlockingConfig()
    right = blocking._keys(targets, "t_id")
    small = right.groupBy("src", "kind", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= config.key_max_bucket).drop("n")
    left = blocking._keys(normalize_stream(incoming), "s1_id")
    return left.join(right.join(small, ["src", "kind", "key"], "left_semi"), ["kind", "key"]).select("s1_id", "t_id", "src")
