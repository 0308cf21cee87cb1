"""Null groups, thresholds, ties and properties of the grouped queries."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbstat.plans import analytics, profile, reshaped, trends

NOON = dt.datetime(2024, 1, 1, 12)


@pytest.fixture(scope="module")
def null_keys(make):
    full = dict(severity=3, street="A", city="B", state="C", weather_condition="Rain", junction=True,
                traffic_signal=False, start_time=NOON)
    rows = [dict(full, id="0")]
    for i, missing in enumerate(["state", "street", "city", "start_time", "junction", "weather_condition"], 1):
        rows.append({**full, "id": str(i), missing: None})
    return make(rows)


def test_null_groups_are_kept_or_dropped(null_keys):
    keys = lambda df, key: {r[key] for r in df.collect()}
    assert keys(analytics.severity_heatmap(null_keys, min_count=0), "hour_of_day") == {12, None}
    assert keys(analytics.severity_heatmap(null_keys, min_count=0, require_time=True), "hour_of_day") == {12}
    assert keys(analytics.danger_score(null_keys, min_count=0), "state") == {"C", None}
    assert keys(analytics.weather_risk(null_keys, min_count=0), "weather_condition") == {"Rain"}
    assert keys(analytics.weather_avg(null_keys, min_count=0), "weather_condition") == {"Rain", None}
    assert keys(analytics.common_weather(null_keys), "weather_condition") == {"Rain", None}
    assert keys(analytics.state_profile(null_keys), "state") == {"C"}
    assert keys(analytics.weather_by_severity(null_keys), "weather_condition") == {"Rain"}
    assert keys(analytics.compound_risk(null_keys, min_count=0), "junction") == {True, None}
    assert keys(analytics.compound_risk(null_keys, min_count=0), "time_of_day") == {"Midday", "Night"}
    assert keys(analytics.compound_risk(null_keys, min_count=0, require_time=True), "time_of_day") == {"Midday"}
    assert sum(r.total_accidents for r in analytics.road_segments(null_keys, min_count=0).collect()) == 6
    assert keys(analytics.road_segments_labelled(null_keys, min_count=0), "road_label") == {"A, B", None}


def test_threshold_is_exclusive(null_keys):
    assert analytics.danger_score(null_keys, min_count=5).count() == 1
    assert analytics.danger_score(null_keys, min_count=6).count() == 0


def test_ties_are_settled_by_the_keys(make):
    df = make([{"id": str(i), "state": s, "severity": 2} for i, s in enumerate("DBCA")])
    assert [r.state for r in analytics.state_counts(df, limit=2).collect()] == ["A", "B"]


def test_year_range_is_inclusive(make):
    df = make([{"id": str(y), "start_time": dt.datetime(y, m, d)} for y, m, d in
               [(2015, 12, 31), (2016, 1, 1), (2023, 12, 31), (2024, 1, 1)]] + [{"id": "none"}])
    assert [(r.year, r["count"]) for r in analytics.by_year(df).collect()] == [(2016, 1), (2023, 1)]


def test_top_conditions_keep_all_their_severities(make):
    rows = [("Rain", 1), ("Rain", 2), ("Rain", 2), ("Snow", 3), ("Snow", None), ("Fog", 4), (None, 1), (None, 1), (None, 1)]
    df = make([{"id": str(i), "weather_condition": w, "severity": s} for i, (w, s) in enumerate(rows)])
    found = {(r.weather_condition, r.severity, r["count"]) for r in analytics.weather_by_severity(df, k=2).collect()}
    assert found == {("Rain", 1, 1), ("Rain", 2, 2), ("Snow", 3, 1)}


def test_heatmap_has_every_day_and_hour(make):
    df = make([{"id": "1", "severity": 4, "start_time": NOON}, {"id": "2", "severity": 1}])
    rows = reshaped.heatmap_pivot(df).collect()
    assert [r.day_of_week for r in rows] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert rows[0].h12 == 4.0 and rows[0].h00 is None and rows[5].h12 is None
    assert len(rows[0]) == 26


def test_profile_of_columns(make):
    df = make([{"id": str(i), "severity": 2, "state": "X" if i else None} for i in range(4)], ["id", "severity", "state", "city"])
    profiled = [(r.column_name, r.null_count, r.null_pct) for r in profile.null_profile(df).collect()]
    assert profiled == [("city", 4, 100.0), ("state", 1, 25.0)]
    assert profile.null_profile(df, only_missing=False).count() == 4
    assert profile.drop_sparse_columns(df).columns == ["id", "severity", "state"]
    assert profile.drop_sparse_columns(df, above_pct=24.9).columns == ["id", "severity"]
    listing = profile.schema_listing(df).orderBy("position").collect()
    assert [(r.column_name, r.type) for r in listing] == [("id", "string"), ("severity", "int"), ("state", "string"), ("city", "string")]
    assert profile.table_size(df).first() == (4, 4)


def test_profile_of_an_empty_table(make):
    empty = make([], ["id", "severity"])
    assert profile.null_profile(empty).count() == 0


def test_correlation_uses_complete_pairs(make):
    rows = [(1, 10.0), (2, 20.0), (3, None), (None, 99.0), (4, 35.0)]
    df = make([{"id": str(i), "severity": s, "humidity_pct": h, "temperature_f": 50.0, "start_time": NOON}
               for i, (s, h) in enumerate(rows)])
    found = {r.column_name: r.correlation for r in profile.severity_correlation(df).collect()}
    import numpy as np

    assert found["humidity_pct"] == pytest.approx(np.corrcoef([1, 2, 4], [10, 20, 35])[0, 1])
    assert found["temperature_f"] is None and found["wind_speed_mph"] is None


def brute_rolling(rows, seconds):
    found = {}
    for street, when, _ in rows:
        second = int(when.replace(tzinfo=dt.timezone.utc).timestamp())
        inside = [s for st_, w, s in rows if st_ == street
                  and second - seconds < int(w.replace(tzinfo=dt.timezone.utc).timestamp()) <= second]
        found[(street, second)] = (len(inside), sum(s >= 3 for s in inside), sum(inside) / len(inside))
    return found


def test_rolling_windows_across_midnight(make):
    base = dt.datetime(2024, 3, 9, 23, 50)
    steps = [0, 0.4, 60, 599, 600, 601, 899, 900, 901, 1500, 86400, 86400 + 899, 2 * 86400]
    rows = [(street, base + dt.timedelta(seconds=s * k), 1 + i % 4)
            for k, street in ((1, "A"), (1.5, "B")) for i, s in enumerate(steps)]
    df = make([{"id": str(i), "street": a, "start_time": t, "severity": s} for i, (a, t, s) in enumerate(rows)])
    for seconds in (900, 60, 200_000):
        found = {(r.street, r.second): (r.accidents, r.severe_accidents, pytest.approx(r.avg_severity))
                 for r in trends.rolling_severity(df, seconds=seconds).collect()}
        assert brute_rolling(rows, seconds) == found


def test_week_over_week_by_hand(make):
    days = [1, 2, 8, 9, 10, 22]
    df = make([{"id": str(d), "state": "X", "start_time": dt.datetime(2024, 1, d)} for d in days])
    found = [(r.week.day, r.accidents, r.previous, r.growth_pct) for r in trends.week_over_week(df).orderBy("week").collect()]
    assert found == [(1, 2, None, None), (8, 3, 2, 50.0), (22, 1, 3, -66.67)]


levels = st.one_of(st.none(), st.integers(1, 4))
row = st.fixed_dictionaries({"severity": levels, "state": st.sampled_from(["A", "B", None]),
                             "weather_condition": st.sampled_from(["Rain", "Snow", None])})


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=30))
def test_properties_of_any_table(make, rows):
    df = make([dict(r, id=str(i)) for i, r in enumerate(rows)], ["id", "severity", "state", "weather_condition"])
    danger = analytics.danger_score(df, min_count=0, limit=None).collect()
    assert sum(r.total_accidents for r in danger) == len(rows)
    assert all(0.4 <= r.danger_score <= 2.2 for r in danger if r.danger_score is not None)
    weather = analytics.weather_risk(df, min_count=0, limit=None).collect()
    assert sum(r.total_accidents for r in weather) == sum(r["weather_condition"] is not None for r in rows)
    assert all(0 <= r.risk_index_pct <= 100 for r in weather)
    shares = analytics.severity_distribution(df).select(F.sum("pct")).first()[0]
    assert shares == pytest.approx(100)
