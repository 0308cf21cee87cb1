"""Grouped analytics over the accident table.

Thresholds and limits are arguments; their defaults are the published ones.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstat.functions import clock, labels, risk
from kerbstat.operators.grouping import (
    danger_index,
    grouped,
    mean_severity,
    row_count,
    severe_count,
    severe_percent,
    with_share,
)

TIME = "start_time"


def _timed(df: DataFrame, require_time: bool) -> DataFrame:
    return df.filter(F.col(TIME).isNotNull()) if require_time else df


# --- severity and risk ---------------------------------------------------------------


def severity_heatmap(
    df: DataFrame, *, min_count: int = 100, limit: int | None = 10, require_time: bool = False
) -> DataFrame:
    """Hours and weekdays with the worst mean severity."""
    time = F.col(TIME)
    return grouped(
        _timed(df, require_time),
        {"hour_of_day": clock.hour_of_day(time), "day_of_week": clock.weekday_name(time)},
        {"total_accidents": row_count(), "avg_severity": mean_severity()},
        min_count=min_count,
        descending=["avg_severity"],
        limit=limit,
    )


def danger_score(df: DataFrame, *, min_count: int = 500, limit: int | None = 10) -> DataFrame:
    """States by a score of mean severity and share of severe accidents."""
    return grouped(
        df,
        ["state"],
        {
            "total_accidents": row_count(),
            "avg_severity": mean_severity(),
            "high_severity_count": severe_count(),
            "danger_score": danger_index(),
        },
        min_count=min_count,
        descending=["danger_score"],
        limit=limit,
    )


def weather_risk(df: DataFrame, *, min_count: int = 1000, limit: int | None = 10) -> DataFrame:
    """Weather conditions by the percentage of accidents that are severe."""
    return grouped(
        df.filter(F.col("weather_condition").isNotNull()),
        ["weather_condition"],
        {
            "total_accidents": row_count(),
            "high_severity_count": severe_count(),
            "risk_index_pct": severe_percent(),
            "avg_severity": mean_severity(),
        },
        min_count=min_count,
        descending=["risk_index_pct"],
        limit=limit,
    )


def weather_risk_bands(df: DataFrame, *, min_count: int = 1000, limit: int | None = 8) -> DataFrame:
    """The weather risk index with the band it falls in."""
    ranked = weather_risk(df, min_count=min_count, limit=limit)
    return ranked.select(
        "weather_condition",
        "total_accidents",
        "risk_index_pct",
        "avg_severity",
        risk.risk_band(F.col("risk_index_pct"), risk.RISK_PCT_CUTS).alias("risk_band"),
    )


def compound_risk(
    df: DataFrame, *, min_count: int = 200, limit: int | None = 12, require_time: bool = False
) -> DataFrame:
    """Junction, signal and time of day taken together."""
    return grouped(
        _timed(df, require_time),
        {
            "junction": F.col("junction"),
            "traffic_signal": F.col("traffic_signal"),
            "time_of_day": clock.time_band(F.col(TIME)),
        },
        {
            "accidents": row_count(),
            "avg_severity": mean_severity(),
            "high_severity_pct": severe_percent(),
        },
        min_count=min_count,
        descending=["avg_severity"],
        limit=limit,
    )


def road_segments(df: DataFrame, *, min_count: int = 5, limit: int | None = 10) -> DataFrame:
    """Road segments with the most severe accidents."""
    return grouped(
        df.filter(F.col("street").isNotNull()),
        ["street", "city", "state"],
        {
            "total_accidents": row_count(),
            "avg_severity": mean_severity(),
            "worst_severity": F.max("severity"),
            "serious_accidents": severe_count(),
        },
        min_count=min_count,
        descending=["serious_accidents", "avg_severity"],
        limit=limit,
    )


def road_segments_labelled(df: DataFrame, *, min_count: int = 5, limit: int | None = 10) -> DataFrame:
    """Road segments under one ``street, city`` label; equal labels of two states stay apart."""
    ranked = road_segments(df, min_count=min_count, limit=limit)
    return ranked.select(
        labels.place_label(F.col("street"), F.col("city")).alias("road_label"),
        "total_accidents",
        "avg_severity",
        "serious_accidents",
    )


def rush_vs_offpeak(df: DataFrame) -> DataFrame:
    return grouped(
        df,
        {"time_period": clock.rush_period(F.col(TIME))},
        {"accident_count": row_count(), "avg_severity": mean_severity()},
        descending=["avg_severity"],
    )


def weather_severity(df: DataFrame, *, min_count: int = 10000, limit: int | None = 8) -> DataFrame:
    return grouped(
        df.filter(F.col("weather_condition").isNotNull()),
        ["weather_condition"],
        {
            "total": row_count(),
            "avg_severity": mean_severity(2),
            "high_severity_count": severe_count(),
        },
        min_count=min_count,
        descending=["avg_severity"],
        limit=limit,
    )


def weather_avg(df: DataFrame, *, min_count: int = 5000, limit: int | None = 12) -> DataFrame:
    """Unrounded mean severity per weather condition, with its band; a missing condition is a group."""
    ranked = grouped(
        df,
        ["weather_condition"],
        {"avg_severity": mean_severity(None), "total": row_count()},
        min_count=min_count,
        descending=["avg_severity"],
        limit=limit,
    )
    band = risk.risk_band(F.col("avg_severity"), risk.WEATHER_SEVERITY_CUTS)
    return ranked.withColumn("severity_band", band)


def junction_signal(df: DataFrame) -> DataFrame:
    return grouped(
        df,
        ["junction", "traffic_signal"],
        {"accidents": row_count(), "avg_severity": mean_severity()},
        descending=["avg_severity"],
    )


# --- counts --------------------------------------------------------------------------


def top_states(df: DataFrame, *, limit: int | None = 10) -> DataFrame:
    return grouped(
        df,
        ["state"],
        {"total_accidents": row_count(), "avg_severity": mean_severity(2)},
        descending=["total_accidents"],
        limit=limit,
    )


def state_counts(df: DataFrame, *, limit: int | None = 10) -> DataFrame:
    return grouped(df, ["state"], {"count": row_count()}, descending=["count"], limit=limit)


def state_profile(df: DataFrame, *, limit: int | None = 15) -> DataFrame:
    """Rated accidents and mean severity per known state."""
    return grouped(
        df.filter(F.col("state").isNotNull()),
        ["state"],
        {"total": F.count("severity"), "avg": mean_severity(None)},
        descending=["total"],
        limit=limit,
    )


def top_cities(df: DataFrame, *, limit: int | None = 10) -> DataFrame:
    ranked = grouped(df, ["city", "state"], {"count": row_count()}, descending=["count"], limit=limit)
    return ranked.withColumn("label", labels.place_label(F.col("city"), F.col("state")))


def top_cities_severe(df: DataFrame, *, limit: int | None = 10) -> DataFrame:
    return grouped(
        df.filter(F.col("severity") >= 3),
        ["city", "state"],
        {"high_severity_accidents": row_count()},
        descending=["high_severity_accidents"],
        limit=limit,
    )


def severity_distribution(df: DataFrame) -> DataFrame:
    """Accidents per severity level, their share of all, and the level's texts."""
    counts = df.groupBy("severity").agg(row_count().alias("count"))
    level = F.col("severity")
    return (
        with_share(counts, "count")
        .withColumns(
            {
                "label": labels.severity_label(level),
                "description": labels.severity_description(level),
            }
        )
        .orderBy(F.asc_nulls_last("severity"))
    )


def by_hour(df: DataFrame, *, require_time: bool = False) -> DataFrame:
    return grouped(
        _timed(df, require_time), {"hour": clock.hour_of_day(F.col(TIME))}, {"count": row_count()}
    )


def by_year(df: DataFrame, *, first: int = 2016, last: int = 2023) -> DataFrame:
    """Accidents per year. The years become a time range, which reaches the file scan."""
    start, end = (clock.moment(dt.datetime(year, 1, 1)) for year in (first, last + 1))
    in_range = df.filter((F.col(TIME) >= start) & (F.col(TIME) < end))
    return grouped(in_range, {"year": clock.calendar_year(F.col(TIME))}, {"count": row_count()})


def avg_temp(df: DataFrame) -> DataFrame:
    return grouped(df, ["severity"], {"avg_temp": F.round(F.avg("temperature_f"), 2)})


def common_weather(df: DataFrame, *, limit: int | None = 10) -> DataFrame:
    return grouped(df, ["weather_condition"], {"count": row_count()}, descending=["count"], limit=limit)


def weather_by_severity(df: DataFrame, *, k: int = 8) -> DataFrame:
    """Counts per condition and severity for the ``k`` most common conditions.

    A condition's counts travel as one short list while the conditions are ranked, so the
    table is scanned once and joined with nothing. A list has one entry per severity.
    """
    counts = (
        df.filter(F.col("weather_condition").isNotNull())
        .groupBy("weather_condition", "severity")
        .agg(row_count().alias("count"))
    )
    common = (
        counts.groupBy("weather_condition")
        .agg(F.sum("count").alias("total"), F.collect_list(F.struct("severity", "count")).alias("levels"))
        .orderBy(F.desc("total"), F.asc("weather_condition"))
        .limit(k)
    )
    return common.select("weather_condition", F.inline("levels")).filter(F.col("severity").isNotNull())


# --- state map -----------------------------------------------------------------------


def state_map(df: DataFrame, *, limit: int | None = None) -> DataFrame:
    """Total, mean severity and share of all accidents per known state."""
    counts = (
        df.filter(F.col("state").isNotNull())
        .groupBy("state")
        .agg(row_count().alias("total_accidents"), mean_severity().alias("avg_severity"))
    )
    ranked = with_share(counts, "total_accidents").orderBy(F.desc("total_accidents"), F.asc("state"))
    return ranked if limit is None else ranked.limit(limit)


def state_map_worst(df: DataFrame, *, limit: int = 5) -> DataFrame:
    """The states with the highest mean severity and the band of each."""
    ranked = grouped(
        df.filter(F.col("state").isNotNull()),
        ["state"],
        {"avg_severity": mean_severity()},
        descending=["avg_severity"],
        limit=limit,
    )
    band = risk.risk_band(F.col("avg_severity"), risk.STATE_SEVERITY_CUTS, strict=True)
    return ranked.withColumn("severity_band", band)
