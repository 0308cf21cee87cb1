"""Every registered query against the SQL that defines it, on whole tables."""

from __future__ import annotations

import math

import pandas as pd
import pytest

import __spark_entry__ as registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return pd.Timestamp(value).isoformat() if hasattr(value, "isoformat") else value


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(name, spark, folder, duck):
    result = QUERIES[name](spark, folder)
    expected = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(expected.columns)
    columns = sorted(result.columns)
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: SPARK_TO_DUCK[t] for c, t in result.dtypes} == kinds
    position = {c: i for i, c in enumerate(expected.columns)}
    wanted = in_order(tuple(plain(row[position[c]]) for c in columns) for row in expected.fetchall())
    found = in_order(tuple(plain(row[c]) for c in columns) for row in result.collect())
    assert found == wanted
    assert found, "the check would be empty"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_gives_rows(name, spark, folder):
    assert QUERIES[name](spark, folder).take(1)


def test_flagship(spark):
    rows = registry.entry(spark).collect()
    scores = [r.danger_score for r in rows]
    assert rows and scores == sorted(scores, reverse=True)
    assert all(r.total_accidents > 100 for r in rows)


@pytest.mark.parametrize("name", ["severity_heatmap", "danger_score", "road_segments", "state_map", "stream_latest"])
def test_ranked_queries_come_out_in_order(name, spark, folder, duck):
    expected = duck.sql(ORACLES[name])
    columns = expected.columns
    wanted = [tuple(plain(v) for v in row) for row in expected.fetchall()]
    if name == "state_map":
        wanted.sort(key=lambda row: (-row[1], row[0]))
    found = [tuple(plain(row[c]) for c in columns) for row in QUERIES[name](spark, folder).collect()]
    assert found == wanted
