"""Vector-space operators on long tables: entity_id, term and weight."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..session import by_merge

#: Similarities are rounded to so many digits, so that the order of summation decides nothing.
DIGITS = 9


def token_idf(records: DataFrame, column: str) -> DataFrame:
    """term, df and smooth idf of an array column's distinct elements, over all records."""
    total = F.broadcast(records.agg(F.count(F.lit(1)).alias("_n")))  # one row
    df = records.select(F.explode(F.array_distinct(column)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.join(total).select("term", "df", (F.log((1.0 + F.col("_n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def tfidf(records: DataFrame, column: str, terms: Callable[[Column], Column], min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """entity_id, term and weight: (1 + ln tf) * idf, scaled to length 1 by record.

    Document frequencies are exact, over all records. Terms in fewer than ``min_df`` records or in more than the
    share ``max_df`` of them are left out before weights are scaled.
    """
    total = F.broadcast(records.agg(F.count(F.lit(1)).alias("_n")))  # one row
    counts = records.select("entity_id", F.explode(terms(F.col(column))).alias("term")).groupBy("entity_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(total).where((F.col("df") >= min_df) & (F.col("df") <= max_df * F.col("_n")))
    weights = counts.join(by_merge(df), "term").select(
        "entity_id", "term", ((1.0 + F.log("tf")) * (F.log((1.0 + F.col("_n")) / (1.0 + F.col("df"))) + 1.0)).alias("w"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("entity_id")))
    return weights.select("entity_id", "term", (F.col("w") / length).alias("weight"))


def char_tfidf(records: DataFrame, column: str, low: int = 3, high: int = 4, min_df: int = 5, max_df: float = 1.0) -> DataFrame:
    return tfidf(records, column, lambda c: text.char_grams(c, low, high), min_df, max_df)


def word_tfidf(records: DataFrame, column: str) -> DataFrame:
    return tfidf(records, column, text.words)


def pair_dot(pairs: DataFrame, postings: DataFrame, name: str) -> DataFrame:
    """``pairs`` (s1_id, t_id, ...) with the dot product of both sides' vectors, rounded like the blockers'; 0 where nothing is shared."""
    left = postings.select(F.col("entity_id").alias("s1_id"), "term", F.col("weight").alias("_w1"))
    right = postings.select(F.col("entity_id").alias("t_id"), "term", F.col("weight").alias("_w2"))
    dots = pairs.select("s1_id", "t_id").distinct().join(by_merge(left), "s1_id").join(by_merge(right), ["t_id", "term"])
    dots = dots.groupBy("s1_id", "t_id").agg(F.round(F.sum(F.col("_w1") * F.col("_w2")), DIGITS).alias(name))
    return pairs.join(by_merge(dots), ["s1_id", "t_id"], "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
