"""Physical plans: what must hold at any size of the table."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from kerbstat.operators import features, splits
from kerbstat.plans import analytics, reshaped, trends
from kerbstat.sources import driver_tables, files

ROUND_TRIPS = {"csv_round_trip", "parquet_round_trip"}
TRAINED = set(registry.queries()) - set(registry.oracle_sql())
# Operators on texts and vectors run Python by their methods and have tests of their own; checks of models end in a stored table.
OTHERS = re.compile(r"stream_.*|op\d+_.*|pipeline|.*_checks")
BATCH = sorted(n for n in registry.queries() if not OTHERS.fullmatch(n) and n not in ROUND_TRIPS | TRAINED)


def plan_of(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text


@pytest.fixture(scope="module")
def stored(spark, accidents, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "table")
    files.write_parquet(accidents, path)
    return files.read_parquet(spark, path)


@pytest.fixture
def on_stored(stored, monkeypatch):
    monkeypatch.setattr(driver_tables, "accidents", lambda spark, folder: stored)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(name, spark, folder, on_stored):
    text = plan_of(registry.queries()[name](spark, folder))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert forbidden not in text


def test_driver_tables_are_joined_by_key(accidents):
    text = plan_of(accidents)
    assert "Join" in text and not re.search("CartesianProduct|NestedLoop|Python|InPandas", text)


def test_weekday_table_has_no_join(stored):
    assert "Join" not in plan_of(reshaped.heatmap_pivot(stored))


@pytest.mark.parametrize(
    "name, columns",
    [
        ("danger_score", {"severity", "state"}),
        ("severity_heatmap", {"severity", "start_time"}),
        ("weather_by_severity", {"severity", "weather_condition"}),
        ("road_segments", {"severity", "street", "city", "state"}),
        ("table_size", set()),
        ("state_map", {"severity", "state"}),
        ("severity_distribution", {"severity"}),
        ("weather_correlation", {"severity", "weather_condition"}),
        ("rule_class_report", {"severity", "start_time", "distance_mi", "humidity_pct", "visibility_mi", "wind_speed_mph"}),
        ("rolling_15m", {"severity", "start_time", "street", "city", "state"}),
        ("top_cities_severe", {"severity", "city", "state"}),
    ],
)
def test_one_scan_of_the_needed_columns(name, columns, spark, folder, on_stored):
    text = plan_of(registry.queries()[name](spark, folder))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert len(schemas) == 1
    assert {c.split(":")[0] for c in schemas[0].split(",") if c} == columns


def test_filters_reach_the_scan(stored):
    assert "GreaterThanOrEqual(severity,3)" in plan_of(analytics.top_cities_severe(stored))
    assert "IsNotNull(street)" in plan_of(analytics.road_segments(stored))
    years = plan_of(analytics.by_year(stored))
    assert "GreaterThanOrEqual(start_time,2016-01-01" in years and "LessThan(start_time,2024" in years


def test_groups_are_combined_before_the_shuffle_and_ranked_without_a_sort(stored):
    text = plan_of(analytics.danger_score(stored))
    assert "partial_count(1)" in text and "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


def test_split_does_not_shuffle_the_table(stored):
    split = splits.stratified_split(features.labelled(stored))
    outer = plan_of(split).split("Subquery")[0]
    assert "Exchange" not in outer


def hot_table(make, n=3000):
    """One segment, state, condition and class hold nine rows of ten."""
    base = dt.datetime(2024, 5, 1)
    rows = []
    for i in range(n):
        hot = i % 10 != 0
        rows.append({
            "id": f"A-{i}", "severity": 2 if hot else 1 + i % 4,
            "street": "Hot" if hot else f"S{i % 7}", "city": "C", "state": "HH" if hot else f"S{i % 5}",
            "weather_condition": "Clear" if hot else "Fog",
            "start_time": base + dt.timedelta(seconds=(i * 37) % 200_000),
        })
    return rows, make(rows)


def test_hot_groups_give_exact_results(make):
    rows, df = hot_table(make)
    counts = Counter(r["state"] for r in rows)
    assert {r.state: r["count"] for r in analytics.state_counts(df, limit=None).collect()} == counts
    split = splits.stratified_split(features.labelled(df)).groupBy("severity", "split").count().collect()
    for level, n in Counter(r["severity"] for r in rows).items():
        assert {r.split: r["count"] for r in split if r.severity == level}["train"] == int(n * 0.8)
    times = sorted((r["start_time"] - dt.datetime(1970, 1, 1)).total_seconds() for r in rows if r["street"] == "Hot")
    found = {r.second: r.accidents for r in trends.rolling_severity(df).filter("street = 'Hot'").collect()}
    for second in list(found)[::97]:
        assert found[second] == sum(second - 900 < t <= second for t in times)


def test_rolling_groups_are_bounded_by_a_day(make):
    _, df = hot_table(make)
    per_group = trends.rolling_severity(df).groupBy("street", F.floor(F.col("second") / 86400)).count()
    assert per_group.agg(F.max("count")).first()[0] <= 86400
