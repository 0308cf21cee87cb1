from __future__ import annotations

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from kerbstat.schema import ACCIDENTS  # noqa: E402
from kerbstat.session import local_session  # noqa: E402
from kerbstat.sources import driver_tables  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g")
    session.sparkContext.setLogLevel("OFF")
    session.conf.set("spark.sql.maxMetadataStringLength", 1000)  # whole schemas in plan texts
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture(scope="session")
def accidents(spark, folder):
    return driver_tables.accidents(spark, folder)


@pytest.fixture(scope="session")
def small(spark):
    return driver_tables.accidents(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


@pytest.fixture(scope="session")
def make(spark):
    """A table with the accident schema from partial rows; absent columns are null."""

    def build(rows: list[dict], columns: list[str] | None = None):
        names = columns or ACCIDENTS.names
        schema = type(ACCIDENTS)([ACCIDENTS[n] for n in names])
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return build
