import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plain(value):
    """A value that both engines give alike."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if value != value else round(value, 5) + 0.0
    if hasattr(value, "item"):
        return plain(value.item())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if type(value).__name__ == "Decimal":
        return plain(float(value)) if value != int(value) else int(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(folder, sql):
    """Columns and rows of a query over the tables in the folder."""
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = Path(folder, f"{t}.parquet")
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()
