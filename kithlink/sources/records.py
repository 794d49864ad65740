"""Readers of record tables and ground truth, with their contracts."""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

# Columns of the files.
RECORD_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")
SOURCES = ("S1", "S2", "S3")
# End of the fixed values.
#: The environment variable that names the dataset's folder, and a folder that is looked at last.
DATA_ENV = "KITHLINK_DATA_DIR"


class ContractError(ValueError):
    """An input breaks a rule of its format."""


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated text without quoting, every field a string, missing ones empty.

    The header is trimmed and loses a byte order mark; blank lines are skipped; a row with too few fields is padded,
    one with too many is an error (``check_width``). The file is read by Spark's splittable text reader.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    head = lines.limit(1).collect()
    if not head:
        raise ContractError(f"{path}: no header")
    header = head[0]["value"]
    names = [c.strip() for c in header.lstrip("﻿").rstrip("\r").split("\t")]
    rows = lines.where(F.col("value") != F.lit(header)).select(F.split(F.regexp_replace("value", r"\r$", ""), "\t", -1).alias("f"))
    wide = rows.where(F.size("f") > len(names)).limit(1).collect()
    if wide:
        raise ContractError(f"{path}: a row has {len(wide[0]['f'])} fields, the header {len(names)}")
    return rows.select(*[F.coalesce(F.get("f", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(names)])


def _required(df: DataFrame, columns: tuple[str, ...], what: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"{what}: columns {missing} are missing, found {df.columns}")
    return df.select(*[text.strip(F.coalesce(c, F.lit(""))).alias(c) for c in columns])


def check_records(records: DataFrame, prefix: str, what: str = "records") -> DataFrame:
    """The four columns, stripped; ids must be unique and begin with the prefix."""
    records = _required(records, RECORD_COLUMNS, what)
    bad = records.where(~F.col("entity_id").startswith(prefix)).select("entity_id").limit(3).collect()
    if bad:
        raise ContractError(f"{what}: ids without the prefix {prefix}: {[r[0] for r in bad]}")
    twice = records.groupBy("entity_id").count().where("count > 1").limit(3).collect()
    if twice:
        raise ContractError(f"{what}: ids that occur more than once: {[r[0] for r in twice]}")
    return records


def load_records(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    return check_records(read_tsv(spark, path), prefix, path)


def load_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    return _required(read_tsv(spark, path), TRUTH_COLUMNS, path)


def truth_pairs(ground_truth: DataFrame) -> DataFrame:
    """Distinct (s1_id, t_id); records without matches are only in the spine."""
    pairs = ground_truth.select(F.col("source1_entity_id").alias("s1_id"), F.explode(text.id_list(F.col("matched_entity_ids"))).alias("t_id"))
    return pairs.distinct()


@dataclass
class SplitData:
    s1: DataFrame
    s2: DataFrame
    s3: DataFrame
    ground_truth: DataFrame | None = None

    @property
    def targets(self) -> DataFrame:
        return self.s2.withColumn("source", F.lit("S2")).unionByName(self.s3.withColumn("source", F.lit("S3")))

    @property
    def records(self) -> DataFrame:
        return self.s1.withColumn("source", F.lit("S1")).unionByName(self.targets)

    @property
    def spine(self) -> DataFrame:
        """Every S1 record, or every one that the ground truth names."""
        if self.ground_truth is not None:
            return self.ground_truth.select(F.col("source1_entity_id").alias("s1_id")).distinct()
        return self.s1.select(F.col("entity_id").alias("s1_id"))

    @property
    def truth(self) -> DataFrame | None:
        return None if self.ground_truth is None else truth_pairs(self.ground_truth)

    @property
    def countries(self) -> DataFrame:
        return self.s1.select(F.col("entity_id").alias("s1_id"), "country")

    def summary(self) -> dict[str, int]:
        return {r["what"]: r["n"] for r in summary_table(self).collect()}


def summary_table(data: SplitData) -> DataFrame:
    """what and n: records by source and, where there is a ground truth, positive pairs and singletons."""
    parts = [(s.lower(), df) for s, df in zip(SOURCES, (data.s1, data.s2, data.s3), strict=True)]
    if data.ground_truth is not None:
        parts += [("positive_pairs", data.truth), ("singletons", data.spine.join(data.truth, "s1_id", "left_anti"))]
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n") for name, df in parts])


def resolve_dataset_dir(path: str | None = None) -> Path:
    """The argument, the environment's folder, or the first of the working folder and its parents that holds a dataset."""
    here = Path.cwd()
    tried = [Path(path)] if path else [Path(p) for p in [os.environ.get(DATA_ENV)] if p] or [here, *here.parents]
    for place in tried:
        for found in (place, place / "dataset"):
            if (found / "train").is_dir() or (found / "test").is_dir():
                return found
    raise FileNotFoundError(f"no dataset (a folder with train or test) in {[str(p) for p in tried[:3]]}")


def load_split(spark: SparkSession, folder: str, split: str) -> SplitData:
    """``{split}/{split}_source1.tsv`` to 3 and, if it is there, ``{split}_ground_truth.tsv``."""
    base = f"{folder}/{split}/{split}"
    parts = [load_records(spark, f"{base}_source{i}.tsv", f"S{i}-") for i in (1, 2, 3)]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{base}_ground_truth.tsv")
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return SplitData(*parts, load_ground_truth(spark, f"{base}_ground_truth.tsv") if there else None)


def check_ground_truth(data: SplitData) -> DataFrame:
    """check, value, ok: counts that must be 0; the last one only informs."""
    gt = data.ground_truth.withColumn("ids", text.id_list(F.col("matched_entity_ids")))
    s1, targets = data.s1.select(F.col("entity_id").alias("source1_entity_id")), data.targets.select(F.col("entity_id").alias("t_id"))
    named = gt.select(F.explode("ids").alias("t_id"))
    count = lambda df: df.agg(F.count(F.lit(1)).alias("value"))
    # The checks' names.
    checks = [
        ("S1 ids missing from ground truth", count(s1.join(gt, "source1_entity_id", "left_anti")), True),
        ("ground-truth rows with unknown S1 id", count(gt.join(s1, "source1_entity_id", "left_anti")), True),
        ("duplicated S1 rows in ground truth", gt.agg((F.count(F.lit(1)) - F.countDistinct("source1_entity_id")).alias("value")), True),
        ("matched ids not found in S2/S3", count(named.join(targets, "t_id", "left_anti")), True),
        ("self matches / S1 ids in matched lists", count(named.where(F.col("t_id").startswith("S1-"))), True),
        ("rows with duplicated ids inside the list", count(gt.where(F.size("ids") != F.size(F.array_distinct("ids")))), True),
        ("targets linked to >1 S1 entity", count(truth_pairs(data.ground_truth).groupBy("t_id").count().where("count > 1")), False),
    ]
    # End of the fixed values.
    out = None
    for name, value, zero in checks:
        row = value.select(F.lit(name).alias("check"), F.col("value").cast("long").alias("value"), (F.col("value") == 0 if zero else F.lit(True)).alias("ok"))
        out = row if out is None else out.unionByName(row)
    return out
