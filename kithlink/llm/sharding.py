"""Balanced contiguous shards from global prefix sums of byte sizes.

Rows are ordered by ``doc_id`` (null first), then by a hash of the text. Quantile edges of the id cut this
order into as many ranges as there are shuffle partitions; the ranges' totals are summed up in order, and a
row's offset is its range's offset plus a running sum within the range. Shard ``k`` of ``n`` takes the rows
whose first byte lies in ``[k/n, (k+1)/n)`` of all bytes, so each shard misses the equal share by less than
one row at either end. Only DataFrame functions are used: one shuffle of the rows, and joins with one row a
range or a shard.

An id that fills whole ranges gets a range of its own, which is dealt on by the hash of the text, so that no
single key makes a large task. Null texts have size 1; equal rows are interchangeable; texts are measured whole;
an empty table gives an empty result. Columns of the input other than those carried are ignored, whatever their
names; a carried column with the name of one of the result's own columns gets an underscore in front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, shuffle_partitions

#: Parts that a range holding a single id is dealt into.
PARTS = 64
LARGEST = 2**63 - 1
RESULT = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _range_of(key: Column, edges: list[int]) -> Column:
    """Number of edges at or below ``key``, by binary search over a literal array."""
    steps = 1
    while steps <= len(edges):
        steps *= 2
    padded = F.lit(edges + [LARGEST] * (steps - 1 - len(edges))) if steps > 1 else None
    if padded is None:
        return F.lit(0)
    jumps = F.lit([2**i for i in range(steps.bit_length() - 2, -1, -1)])
    return F.aggregate(jumps, F.lit(0), lambda at, jump: F.when(F.get(padded, at + jump - 1) <= key, at + jump).otherwise(at))


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, *, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the ``carry`` columns of ``docs``."""
    spark = docs.sparkSession
    wanted = shuffle_partitions(spark)
    fractions = [i / wanted for i in range(1, wanted)]
    found = []
    if fractions:
        got = docs.agg(F.percentile_approx("doc_id", F.lit(fractions), F.lit(max(10_000, 20 * wanted))).alias("e")).first()
        found = [int(x) for x in (got["e"] or [])]
    alone = sorted({a for a, b in zip(found, found[1:], strict=False) if a == b})
    edges = sorted({*found, *(a + 1 for a in alone if a < LARGEST)})

    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id").cast("long")
    rows = docs.select(
        key.alias("_id"),
        (F.octet_length(text).cast("long") + 1).alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"),
        F.xxhash64(text).alias("_tie"),
        *[c.alias(f"_carry_{i}") for i, c in enumerate(quoted(list(carry)))],
    ).withColumn("_range", F.when(F.col("_id").isNull(), -1).otherwise(_range_of(F.col("_id"), edges)))
    split = F.col("_range") == -1
    if alone:
        split = split | F.col("_id").isin(alone)
    rows = rows.withColumn("_part", F.when(split, F.pmod(F.col("_tie"), F.lit(PARTS))).otherwise(F.lit(0).cast("long")))

    ordered = Window.orderBy("_range", "_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # at most (ranges + 2) * PARTS rows, whatever the input's size
    totals = rows.groupBy("_range", "_part").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    totals = totals.select(
        "_range", "_part",
        F.coalesce(F.sum("_bytes").over(ordered), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(ordered), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(whole).alias("_total"),
    )
    within = Window.partitionBy("_range", "_part").orderBy("_id", "_tie", "_size")
    placed = (
        rows.withColumn("_upto", F.sum("_size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_nth", F.row_number().over(within))
        .join(F.broadcast(totals), ["_range", "_part"])
        .withColumn("_first_byte", (F.col("_bytes_before") + F.col("_upto") - F.col("_size")).cast("decimal(30,0)"))
        .withColumn("_at", F.col("_rows_before") + F.col("_nth") - 1)
        .withColumn("shard", F.expr(f"cast(_first_byte * {int(n_shards)} div _total as int)"))
    )
    used, names = {c.lower() for c in (*RESULT, *carry) if c in RESULT or c.lower() not in RESULT}, []
    for c in carry:
        name = c
        while name.lower() in RESULT or (name != c and name.lower() in used):
            name = f"_{name}"
        used.add(name.lower())
        names.append(name)
    starts = placed.groupBy("shard").agg(F.min("_at").alias("_start"))  # one row a shard
    return placed.join(F.broadcast(starts), "shard").select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", (F.col("_at") - F.col("_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"_carry_{i}").alias(name) for i, name in enumerate(names)],
    )
