"""A training corpus from the documents table, in stages of the operators in ``kithlink.llm``.

Every stage works on all rows that its predecessor kept and reads whole texts; an empty table gives an empty one.
All columns of the table are carried through, whatever their names and types. What each stage makes of null texts,
null ids and repeated rows is said at the stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kithlink.llm import decontam, langid, mixing, sharding, simhash
from kithlink.llm.common import discard, importable, materialise, scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letter in the text, or no language that holds 0.3 of its letters.

    Null and empty texts have no language. Rows are judged by their text alone, so rows without an id and repeated ones stay or go like others.
    """
    return langid.drop_unknown(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest doc_id.

    Repeated rows stay once, rows that share an id as far as their texts differ. Rows without an id all stay. Texts without words are one class.
    """
    return simhash.keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null texts hold none; rows are judged by their text alone, whatever their ids."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: 0 to 3 times.

    A null source is a source of its own. Texts without words weigh nothing and are taken as often as their source's rate says, rounded down. Repeated
    rows are documents of their own.
    """
    return mixing.mixed_rows(docs)


def byte_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with its shard of 16 and its place in the shard, and all columns of the documents.

    Null texts have size 1, null ids come first. A column that has the name of one of the shards' own gets an underscore in front.
    """
    return sharding.shard_by_bytes(docs, 16, carry=tuple(c for c in docs.columns if c != "doc_id"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("byte_shards", byte_shards),
]

#: SQL can't express the fingerprints or the learned languages; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's rows written as Parquet and read again. A stage's input and what it stored on its way are deleted after it."""
    docs = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch():
            kept = materialise(stage(spark, docs, sf_dir), name, lasting=True)
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
