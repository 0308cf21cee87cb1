"""Scalar functions on hand-written rows, nulls above all."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbstat.functions import clock, flags, labels, risk

SUNDAY = dt.datetime(2024, 1, 7, 6, 30)


def value(spark, column, **inputs):
    types = {dt.datetime: "timestamp_ntz", str: "string", int: "int", float: "double", bool: "boolean"}
    source = spark.range(1).select(
        *[
            (F.lit(str(v) if isinstance(v, dt.datetime) else v).cast(types[type(v)]) if not isinstance(v, tuple) else F.lit(v[0]).cast(v[1])).alias(k)
            for k, v in inputs.items()
        ]
        or ["id"]
    )
    return source.select(column.alias("v")).first().v


def test_three_weekday_conventions(spark):
    t = F.col("t")
    assert value(spark, clock.weekday_from_sunday(t), t=SUNDAY) == 1
    assert value(spark, clock.weekday_from_monday(t), t=SUNDAY) == 6
    assert value(spark, clock.weekday_from_sunday_zero(t), t=SUNDAY) == 0
    assert value(spark, clock.weekday_name(t), t=SUNDAY) == "Sunday"
    assert value(spark, clock.weekday_name(t, short=True), t=SUNDAY) == "Sun"


@pytest.mark.parametrize(
    "hour, band, period",
    [
        (5, "Night", "Off Peak"),
        (6, "Morning Rush", "Off Peak"),
        (7, "Morning Rush", "Rush Hour"),
        (9, "Morning Rush", "Rush Hour"),
        (10, "Midday", "Off Peak"),
        (15, "Midday", "Off Peak"),
        (16, "Evening Rush", "Rush Hour"),
        (18, "Evening Rush", "Rush Hour"),
        (19, "Evening Rush", "Off Peak"),
        (20, "Night", "Off Peak"),
    ],
)
def test_bands_include_both_ends(spark, hour, band, period):
    time = SUNDAY.replace(hour=hour)
    assert value(spark, clock.time_band(F.col("t")), t=time) == band
    assert value(spark, clock.rush_period(F.col("t")), t=time) == period


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on that day
        for time in (dt.datetime(2024, 3, 10, 2, 30, 5), dt.datetime(1969, 12, 31, 23, 59, 59)):
            seconds = int(time.replace(tzinfo=dt.timezone.utc).timestamp())
            assert value(spark, clock.epoch_seconds(F.col("t")), t=time) == seconds
            back = clock.from_instant(clock.as_instant(F.col("t")))
            assert value(spark, back, t=time) == time
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_missing_time(spark):
    missing = (None, "timestamp_ntz")
    assert value(spark, clock.time_band(F.col("t")), t=missing) == "Night"
    assert value(spark, clock.rush_period(F.col("t")), t=missing) == "Off Peak"
    assert value(spark, clock.weekday_name(F.col("t")), t=missing) is None
    assert value(spark, clock.hour_of_day(F.col("t")), t=missing) is None


def test_lenient_timestamp(spark):
    text = F.col("t")
    assert value(spark, clock.lenient_timestamp(text), t="2016-02-08 05:46:00") == dt.datetime(2016, 2, 8, 5, 46)
    assert value(spark, clock.lenient_timestamp(text), t="2016-02-08 05:46:00.123456789").microsecond == 123456
    assert value(spark, clock.lenient_timestamp(text), t="not a time") is None


def test_flags_read_null_as_zero(spark):
    assert value(spark, flags.night_flag(F.col("s")), s=(None, "string")) == 0
    assert value(spark, flags.flag(F.col("b")), b=(None, "boolean")) == 0
    assert value(spark, flags.severe_flag(F.col("n")), n=(None, "int")) == 0
    assert value(spark, flags.severe_flag(F.col("n")), n=3) == 1


@pytest.mark.parametrize("text, expected", [("True", 1), ("False", 0), ("1", 1), ("0", 0), ("x", 0)])
def test_text_flag(spark, text, expected):
    assert value(spark, flags.text_flag(F.col("s")), s=text) == expected


def test_text_flag_of_boolean(spark):
    assert value(spark, flags.text_flag(F.col("b")), b=True) == 1
    assert value(spark, flags.text_flag(F.col("b")), b=(None, "boolean")) == 0


def test_labels(spark):
    road = labels.road_type(F.col("j"), F.col("s"))
    assert value(spark, road, j=True, s=(None, "boolean")) == "Junction + No Signal"
    assert value(spark, road, j=False, s=True) == "No Junction + Signal"
    place = labels.place_label(F.col("a"), F.col("b"))
    assert value(spark, place, a="Main St", b="Miami") == "Main St, Miami"
    assert value(spark, place, a="Main St", b=(None, "string")) is None
    assert value(spark, labels.severity_label(F.col("n")), n=4) == "Critical"
    assert value(spark, labels.severity_label(F.col("n")), n=0) is None
    assert value(spark, labels.severity_label(F.col("n")), n=(None, "int")) is None
    assert value(spark, labels.severity_response(F.col("n")), n=1) == "None needed"


def test_risk_bands(spark):
    band = risk.risk_band(F.col("v"), risk.RISK_PCT_CUTS)
    assert [value(spark, band, v=x) for x in (48.0, 47.9, 43.0, 42.9)] == ["high", "medium", "medium", "low"]
    strict = risk.risk_band(F.col("v"), risk.STATE_SEVERITY_CUTS, strict=True)
    assert [value(spark, strict, v=x) for x in (2.41, 2.4, 2.3)] == ["high", "medium", "low"]
    assert value(spark, band, v=(None, "double")) is None


def test_rule_risk_by_hand(spark):
    rule = risk.rule_risk(F.col("v"), F.col("d"), F.col("h"), F.col("w"), F.col("hour"))
    inputs = dict(v=2.0, d=20.0, h=50.0, w=40.0)
    expected = 0.25 * 0.8 + 0.20 * 1.0 + 0.15 * 0.5 + 0.10 * 0.5
    assert value(spark, rule, **inputs, hour=8) == pytest.approx(expected + 0.08)
    assert value(spark, rule, **inputs, hour=9) == pytest.approx(expected)
    assert value(spark, rule, **inputs, hour=(None, "int")) == pytest.approx(expected)
    assert value(spark, rule, **{**inputs, "v": (None, "double")}, hour=8) is None


@pytest.mark.parametrize("r, level", [(0.0, 1), (0.1, 1), (0.3, 3), (0.5, 3), (0.7, 4), (5.0, 4)])
def test_rule_severity_rounds_half_to_even(spark, r, level):
    assert value(spark, risk.rule_severity(F.col("r")), r=r) == level == min(4, max(1, round(r * 5) + 1))


def test_rule_severity_of_missing_risk(spark):
    assert value(spark, risk.rule_severity(F.col("r")), r=(None, "double")) is None
