"""Mixing sources to target weights by entropy balancing.

The rates ``r`` of documents minimise the relative entropy ``sum(size * (r ln r - r + 1))`` under the constraints
that each category's rated words equal its target, for one or more category columns at once (``op6`` has one, the
source). The dual is convex with one variable a category, and its solution tilts the rates exponentially:
``r = exp(sum of the document's categories' variables)``, cut at ``cap``. Newton's gradient and Hessian are sums over
documents; documents with equal categories share a rate, so each iteration is an aggregate over the cells of
categories, which are counted once. A document has one category of a column, so the Hessian within a column is
diagonal and its Newton step a division in each category's row; columns take their steps in turn. Categories, targets
and variables are tables throughout: the driver sees the largest relative gap of an iteration, nothing else.

Targets share all words by weight, cut at ``cap`` times a source's words, the excess shared again. Sorted by cap over
weight, the sources that are cut come first, so running sums give the share at which no further one is cut.

Rates become whole copies: the whole part for every document, and one more for some. Within a source, sizes are
gone through from the largest down, and each size class takes as many extra copies as brings the words taken so
far closest to the words rated so far: a remainder is carried to smaller sizes, so a source misses its target by
less than a document's size. Which documents of a class take them is decided by the MD5 of doc_id; ranks are
counted within buckets of the hash, with the earlier buckets' counts added, so that no class makes a large task.

What is gathered for a source is one row for each distinct size. Null texts have size 0; null sources are a source of
their own, the last. An empty table gives an empty result; repeated rows are documents of their own, and texts are
counted whole. All columns of the input are carried along, whatever their names and types.
"""

from __future__ import annotations

import math
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, discard, materialise, quoted, row_hash

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
#: Hexadecimal digits of the hash that number a bucket.
BUCKET_DIGITS = 2
#: Rates are rounded to so many digits, over what iterations leave open.
RATE_DIGITS = 9
#: A variable that leaves nothing of a document.
NOTHING = -700.0


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def running(rows: DataFrame, order: list[Column], **sums: str) -> DataFrame:
    """``rows`` with ``_nth`` (from 0) in the order, and for each ``name=column`` the sum of the column over the rows before.

    Rows are sorted in ranges; a range adds the earlier ranges' totals, of which there is one row a range.
    """
    place = F.monotonically_increasing_id()  # the range's number above 33 bits for the row's
    sorted_rows = materialise(rows.orderBy(*order).withColumn("_at", place), "sorted")
    part = F.shiftright("_at", 33)
    totals = sorted_rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_b{c}") for c in ("_n", *(f"_t_{n}" for n in sums))])
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    out = sorted_rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    own = [(F.col(f"_b_t_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items()]
    return out.select(*quoted(rows.columns), (F.col("_b_n") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("_nth"), *own)


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``sources`` (source, words) with ``goal``: shares of all words by weight, cut at ``cap`` times the words, the excess shared again by weight."""
    numbered = running(sources, [F.col("source").isNull(), F.col("source")])
    weighted = numbered.withColumn("weight", F.get(F.lit(list(map(float, weights))), F.pmod("_nth", F.lit(len(weights))).cast("int"))).drop("_nth")
    weighted = weighted.withColumn("level", cap * F.col("words") / F.col("weight"))
    ranked = running(weighted, [F.col("level"), F.col("source").isNull(), F.col("source")], cut="words", used="weight")
    whole = weighted.agg(F.sum("words").alias("_all"), F.sum("weight").alias("_weights"))  # one row
    units = ranked.join(F.broadcast(whole)).withColumn("unit", (F.col("_all") - cap * F.col("cut")) / (F.col("_weights") - F.col("used")))
    unit = units.where(F.col("unit") <= F.col("level")).agg(F.min_by("unit", "_nth").alias("unit"))  # one row; null if all are cut
    return weighted.join(F.broadcast(unit)).select(
        *quoted(sources.columns), F.when(F.col("unit") <= F.col("level"), F.col("unit") * F.col("weight")).otherwise(cap * F.col("words")).cast("double").alias("goal"))


def balance_levels(cells: DataFrame, goals: dict[str, DataFrame], cap: float = CAP, rounds: int = 100, close: float = 1e-9) -> dict[str, DataFrame]:
    """The dual variables of each column's categories: tables of the column and ``level``.

    ``cells`` has the columns of ``goals`` and ``words``; ``goals`` maps a column to a table of its categories (none of
    them null) and their ``goal``; the sums of all columns' goals are equal. A category without words or without goal
    gets ``NOTHING``. Iterations end when every goal is met but for the share ``close`` of it, or nothing improves.
    """
    top = math.log(cap)
    levels = {}
    for c, goal in goals.items():
        words = cells.groupBy(c).agg(F.sum("words").alias("_w"))
        start = F.when((F.col("goal") > 0) & (F.col("_w") > 0), 0.0).otherwise(NOTHING)
        levels[c] = materialise(goal.join(words, c, "left").select(c, F.col("goal").cast("double").alias("goal"), start.alias("level")), "levels")
    worst = math.inf
    for _ in range(rounds):
        gaps = []
        for c in goals:
            joined = cells
            for i, (name, table) in enumerate(levels.items()):
                joined = joined.join(table.select(name, F.col("level").alias(f"_l{i}")), name)
            power = reduce(Column.__add__, [F.col(f"_l{i}") for i in range(len(levels))])
            # beyond the cap the rate's slope is taken as at the cap, so that a step leads back
            rated = joined.groupBy(c).agg(F.sum(F.col("words") * F.exp(F.least(power, F.lit(top)))).alias("_r"))
            off = F.col("goal") - F.col("_r")
            step = F.when(F.col("level") > NOTHING, F.greatest(F.least(off / F.col("_r"), F.lit(2.0)), F.lit(-2.0))).otherwise(0.0)
            old = levels[c]
            gap = F.when(F.col("level") > NOTHING, F.abs(off) / F.col("goal")).otherwise(0.0)
            stepped = old.join(rated, c, "left").select(c, "goal", (F.col("level") + F.coalesce(step, F.lit(0.0))).alias("level"), gap.alias("gap"))
            levels[c] = materialise(stepped, "levels")
            gaps.append(levels[c].agg(F.coalesce(F.max("gap"), F.lit(0.0))).first()[0])
            discard(old)
        if max(gaps) <= close or (max(gaps) < 1e-9 and max(gaps) >= worst):
            break
        worst = max(gaps)
    return {c: table.select(c, "level") for c, table in levels.items()}


def balance(cells: DataFrame, wanted: dict[str, dict], cap: float = CAP, rounds: int = 200, close: float = 1e-9) -> dict[str, dict]:
    """``balance_levels`` for categories that fit the driver: ``wanted`` maps a column to its categories' targets, the result to their variables."""
    spark = cells.sparkSession
    goals = {c: spark.createDataFrame([(k, float(v)) for k, v in own.items()], f"{c} {cells.schema[c].dataType.simpleString()}, goal double") for c, own in wanted.items()}
    found = balance_levels(cells, goals, cap, rounds, close)
    return {c: {r[0]: r[1] if r[1] > NOTHING else -math.inf for r in table.collect()} for c, table in found.items()}


def whole_copies(sizes: np.ndarray, counts: np.ndarray, rates: np.ndarray, cap: int = CAP) -> tuple[np.ndarray, np.ndarray]:
    """Copies that all documents of a size class take, and how many of them take one more; classes in the order of sizes, largest first."""
    base = np.minimum(np.floor(rates + 1e-9), cap).astype(np.int64)
    part = np.maximum(rates - base, 0.0)
    extra, owed = np.zeros(len(sizes), np.int64), 0.0
    for i in range(len(sizes)):
        owed += part[i] * counts[i] * sizes[i]
        if sizes[i] > 0 and base[i] < cap:
            extra[i] = min(max(math.floor(owed / sizes[i] + 0.5), 0), counts[i])
            owed -= extra[i] * sizes[i]
    return base, extra


def _classes(pdf: pd.DataFrame, cap: int) -> pd.DataFrame:
    pdf = pdf.sort_values("_size", ascending=False, kind="stable")
    base, extra = whole_copies(pdf["_size"].to_numpy(), pdf["_n"].to_numpy(), pdf["_rate"].to_numpy(), cap)
    return pd.DataFrame({"_key": pdf["_key"], "_size": pdf["_size"], "_base": base, "_extra": extra})


def _placed(docs: DataFrame, size: Column | None, weights: tuple[float, ...], cap: int) -> DataFrame:
    """``docs`` with its columns as _own_0, _own_1 and so on, and _size, _source_size, _target and _copies."""
    own = [c.alias(f"_own_{i}") for i, c in enumerate(quoted(docs.columns))]
    source = F.col("source").cast("string")
    counted = size if size is not None else size_of(F.col("text").cast("string"))
    order = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 16)
    rows = docs.select(
        *own, F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("_key"), counted.alias("_size"), order.alias("_hash"), row_hash(docs).alias("_tie"))
    rows = rows.withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))
    narrow = materialise(rows.groupBy("_key", "_size", "_bucket").agg(F.count(F.lit(1)).alias("_n")), "mix-sizes")
    cells = materialise(narrow.groupBy("_key").agg(F.sum(F.col("_n") * F.col("_size")).alias("words")), "mix-words")
    named = cells.withColumn("source", F.when(F.col("_key") != "n", F.substring("_key", 2, 2**31 - 1)))
    goals = materialise(source_targets(named, weights, cap), "mix-targets")
    level = balance_levels(cells, {"_key": goals.select("_key", "goal")}, cap, close=1e-13)["_key"]
    rate = F.when(F.col("level") > NOTHING, F.round(F.least(F.exp("level"), F.lit(float(cap))), RATE_DIGITS)).otherwise(0.0)
    sources = goals.join(level, "_key").select("_key", F.col("words").alias("_source_size"), F.col("goal").alias("_target"), rate.alias("_rate"))

    sized = narrow.groupBy("_key", "_size").agg(F.sum("_n").alias("_n")).join(sources.select("_key", "_rate"), "_key")
    classes = sized.groupBy("_key").applyInPandas(partial(_classes, cap=cap), "_key string, _size long, _base long, _extra long")
    before = Window.partitionBy("_key", "_size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = narrow.select("_key", "_size", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).join(classes, ["_key", "_size"])
    buckets = buckets.join(sources.drop("_rate"), "_key")
    within = Window.partitionBy("_key", "_size", "_bucket").orderBy("_hash", "_tie")
    nth = F.col("_before") + F.row_number().over(within)
    placed = rows.join(buckets, ["_key", "_size", "_bucket"]).withColumn("_copies", F.col("_base") + F.when(nth <= F.col("_extra"), 1).otherwise(0))
    return placed.select(*[f"_own_{i}" for i in range(len(docs.columns))], "_size", "_source_size", "_target", "_copies")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, size: Column | None = None) -> DataFrame:
    """``docs`` with the columns _size, _source_size, _target and _copies: how often the mix takes each row.

    A document's size is the number of its text's words, or ``size`` where that is given. Columns of ``docs`` with these four names are left out.
    """
    added = ("_size", "_source_size", "_target", "_copies")
    kept = [F.col(f"_own_{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in added]
    return _placed(docs, size, weights, cap).select(*kept, *added)


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of each row."""
    sized = materialise(docs.select("doc_id", "source", size_of(F.col("text").cast("string")).alias("words")), "sizes")
    return mix(sized, size=F.col("words")).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    taken = _placed(docs, None, WEIGHTS, CAP).where("_copies > 0")
    repeated = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return repeated.select(*[F.col(f"_own_{i}").alias(c) for i, c in enumerate(docs.columns)])


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> dict[str | None, float]:
    """``source_targets`` for sources that fit the driver."""
    named = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(named)}
    left, used = float(sum(sizes.values())), sum(weight.values())
    found = {}
    for s in sorted(named, key=lambda s: cap * sizes[s] / weight[s]):
        found[s] = min(float(cap * sizes[s]), left / used * weight[s])
        left, used = left - found[s], used - weight[s]
    return found
