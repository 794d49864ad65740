"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import partial
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What separates words, as a Java and a Python character class.
WORD_RE = r"[^\x20\x09-\x0D]+"

#: Rows of text that are turned into Python objects at a time.
TEXT_ROWS = 256


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package; a cluster has it installed or gets it by ``addPyFile``."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary folder only where that is unset and Spark runs in one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":  # local-cluster has processes of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    fallback = tempfile.mkdtemp(prefix="kithlink-")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


_temporary: ContextVar[list | None] = ContextVar("temporary", default=None)


def materialise(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage is cut there, and what follows survives lost executors.

    Inside ``scratch`` the table lives to the end of the block, unless it is ``lasting``; else until the folder is cleaned or it is discarded.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kithlink_path = path
    if not lasting and _temporary.get() is not None:
        _temporary.get().append(out)
    return out


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that are materialised inside the block are deleted at its end."""
    token = _temporary.set([])
    try:
        yield
    finally:
        for table in _temporary.get():
            discard(table)
        _temporary.reset(token)


def discard(df: DataFrame | None) -> None:
    """Delete a table written by ``materialise`` once nothing reads it any more."""
    path = getattr(df, "_kithlink_path", None)
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def quoted(columns: list[str]) -> list[Column]:
    """The named columns, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"_{name}"
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        out.append(name)
    return out


def filter_by_text(df: DataFrame, judge: Callable[[Iterable, str], Iterable]) -> DataFrame:
    """The rows of ``df`` that ``judge`` leaves of its Arrow batches, whose column of texts has the name it is told; all columns are carried, whatever their names."""
    at = next(i for i, c in enumerate(df.columns) if c.lower() == "text")
    plain = df.select(*[c.alias(f"_own_{i}") for i, c in enumerate(quoted(df.columns))])
    if df.schema.fields[at].dataType.simpleString() == "string":
        kept = plain.mapInArrow(partial(judge, text=f"_own_{at}"), plain.schema)
    else:
        plain = plain.withColumn("_text", F.col(f"_own_{at}").cast("string"))
        kept = plain.mapInArrow(partial(judge, text="_text"), plain.schema)
    return kept.select(*[F.col(f"_own_{i}").alias(c) for i, c in enumerate(df.columns)])


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns, maps (which can't be hashed as they are) by their JSON."""
    parts = [F.to_json(F.struct(c.alias("v"))) if "map<" in f.dataType.simpleString() else c for c, f in zip(quoted(df.columns), df.schema.fields, strict=True)]
    return F.xxhash64(*parts)


def learn_remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    return learn_remainder(doc_id) == 1


def first_by_hash(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Of each ``key`` at most ``n`` rows, the first by a hash of doc_id.

    Keys with more than twice as many rows are cut by the hash before rows are ranked, so ranking sees some 2 * n rows a key.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))  # one row a key
    near = rows.withColumn("_place", place).join(F.broadcast(sizes), key).where(F.col("_place") * F.col("_size") <= F.lit(2.0 * n * (1 << 40)))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_place", "doc_id"))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= n).select(rows.columns)


def text_slices(batch, column: str = "text", rows: int = TEXT_ROWS):
    """(offset, list of str or None) over an Arrow batch, a few rows at a time, so that few texts are Python objects at once."""
    values = batch.column(batch.schema.get_field_index(column))
    for start in range(0, len(values), rows):
        yield start, values.slice(start, rows).to_pylist()
