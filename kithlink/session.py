"""What plans need of a session: shared folders, importable workers, and tables written once."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package; a cluster has it installed or gets it by ``addPyFile``."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where it is unset and Spark runs in one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kithlink-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def by_merge(df: DataFrame) -> DataFrame:
    """``df``, to be joined by sorting whatever size Spark expects of it.

    Sizes of packed files and of exploded lists are guessed far too small; tables that grow with the records would be broadcast through the driver.
    """
    return df.hint("merge")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, with its lineage cut."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file(spark: SparkSession, path: str) -> tuple:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _without_checksum(spark: SparkSession, path: str) -> None:
    """Local files lose the checksum that Hadoop keeps beside them, so that other programs may edit them."""
    target, system = _file(spark, path)
    if system.getScheme() == "file":
        system.getRawFileSystem().delete(spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.crc"), False)


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _file(spark, path)
    return system.exists(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as a file, on any file system that Spark reaches."""
    target, system = _file(spark, path)
    out = system.create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    _without_checksum(spark, path)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path).collect())


def write_one_file(lines: DataFrame, path: str) -> None:
    """The only column of a DataFrame of one partition as a text file of that name: written beside it, then renamed."""
    spark, part = lines.sparkSession, f"{path}-{uuid.uuid4().hex}"
    lines.write.text(part)
    folder, system = _file(spark, part)
    target, _ = _file(spark, path)
    for status in system.listStatus(folder):
        if status.getPath().getName().startswith("part-") and status.getLen() > 0:
            system.delete(target, False)
            system.mkdirs(target.getParent())
            if not system.rename(status.getPath(), target):
                raise OSError(f"{path} could not be written")
            _without_checksum(spark, path)
    system.delete(folder, True)
