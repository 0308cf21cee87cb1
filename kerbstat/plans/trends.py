"""Change over time and the link between weather and severe accidents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbstat.functions import clock
from kerbstat.functions.flags import severe_flag
from kerbstat.operators.grouping import over_groups, row_count, severe_count

SEGMENT = ("street", "city", "state")
DAY_SECONDS = 24 * 60 * 60


def week_over_week(df: DataFrame) -> DataFrame:
    """Accidents per state and week, and the growth on the state's previous listed week.

    The window runs over weekly counts: its largest group is one state's weeks, however
    many accidents the state has.
    """
    weekly = (
        df.filter(F.col("start_time").isNotNull() & F.col("state").isNotNull())
        .groupBy("state", F.to_date(F.date_trunc("week", "start_time")).alias("week"))
        .agg(row_count().alias("accidents"))
    )
    previous = F.lag("accidents").over(Window.partitionBy("state").orderBy("week"))
    growth = (F.col("accidents") - F.col("previous")).cast("double") * 100.0 / F.col("previous")
    return weekly.withColumn("previous", previous).withColumn("growth_pct", F.round(growth, 2))


def calendar_weeks(df: DataFrame) -> DataFrame:
    """Accidents per state and calendar week from its first to its last, and the growth on the week before.

    Weeks without accidents count 0. Growth on such a week is null. The weeks of a state are generated, not looked for in the data.
    """
    counted = week_over_week(df).select("state", "week", "accidents")
    bounds = counted.groupBy("state").agg(F.min("week").alias("first"), F.max("week").alias("last"))
    spine = bounds.select("state", F.explode(F.sequence("first", "last", F.expr("INTERVAL 7 DAYS"))).alias("week"))
    weekly = spine.join(counted, ["state", "week"], "left").withColumn("accidents", F.coalesce("accidents", F.lit(0)))
    previous = F.lag("accidents").over(Window.partitionBy("state").orderBy("week"))
    growth = (F.col("accidents") - F.col("previous")).cast("double") * 100.0 / F.nullif("previous", F.lit(0))
    return weekly.withColumn("previous", previous).withColumn("growth_pct", F.round(growth, 2))


def rolling_severity(df: DataFrame, *, seconds: int = 15 * 60) -> DataFrame:
    """For each second in which a road segment has accidents, the trailing window ending in it.

    A segment may hold a large part of the table, so it is not one window group. Rows
    are first combined per second, and the seconds of a segment are cut into days. The
    seconds that the next day's first windows look back on are copied to that day. A group then
    holds at most one day's seconds plus one window length, and the result is exact.
    """
    per_second = (
        df.filter(F.col("start_time").isNotNull() & F.col("street").isNotNull())
        .groupBy(*SEGMENT, clock.epoch_seconds(F.col("start_time")).alias("second"))
        .agg(
            F.count("severity").alias("n"),
            F.sum("severity").alias("total"),
            severe_count().alias("severe"),
        )
    )
    own_day = F.floor(F.col("second") / DAY_SECONDS)
    last_needed = F.floor((F.col("second") + (seconds - 1)) / DAY_SECONDS)
    chunks = per_second.withColumn("own_day", own_day).withColumn(
        "day", F.explode(F.sequence(F.col("own_day"), last_needed))
    )
    trailing = (
        Window.partitionBy(*SEGMENT, "day").orderBy("second").rangeBetween(-(seconds - 1), Window.currentRow)
    )
    return (
        chunks.withColumns(
            {
                "accidents": F.sum("n").over(trailing),
                "severity_total": F.sum("total").over(trailing),
                "severe_accidents": F.sum("severe").over(trailing),
            }
        )
        .filter(F.col("day") == F.col("own_day"))
        .select(
            *SEGMENT,
            "second",
            "accidents",
            "severe_accidents",
            F.try_divide(F.col("severity_total").cast("double"), "accidents").alias("avg_severity"),
        )
    )


def top_rolling_segments(df: DataFrame, *, seconds: int = 15 * 60, limit: int | None = 10) -> DataFrame:
    """Road segments by the most severe accidents within one trailing window."""
    ranked = (
        rolling_severity(df, seconds=seconds)
        .groupBy(*SEGMENT)
        .agg(
            F.max("severe_accidents").alias("peak_severe"),
            F.max("accidents").alias("peak_accidents"),
            F.round(F.max("avg_severity"), 3).alias("peak_avg_severity"),
        )
        .orderBy(
            F.desc("peak_severe"),
            F.desc_nulls_last("peak_avg_severity"),
            F.desc("peak_accidents"),
            *[F.asc_nulls_last(c) for c in SEGMENT],
        )
    )
    return ranked if limit is None else ranked.limit(limit)


def weather_correlation(df: DataFrame) -> DataFrame:
    """Correlation of "this condition" with "severe", for every known condition.

    Both sides are 0/1, so the coefficient follows from four counts: one grouped pass
    replaces one pass per condition.
    """
    severe = severe_flag(F.col("severity"))
    counts = (
        df.filter(F.col("weather_condition").isNotNull() & F.col("severity").isNotNull())
        .groupBy("weather_condition")
        .agg(row_count().alias("accidents"), F.sum(severe).alias("severe_accidents"))
    )
    totals = {
        "n": over_groups(F.sum("accidents")).cast("double"),
        "s": over_groups(F.sum("severe_accidents")).cast("double"),
    }
    a, b = F.col("accidents").cast("double"), F.col("severe_accidents").cast("double")
    n, s = F.col("n"), F.col("s")
    spread = F.sqrt(a * (n - a)) * F.sqrt(s * (n - s))
    return (
        counts.withColumns(totals)
        .withColumn("correlation", F.when(spread > 0, (n * b - a * s) / spread))
        .drop("n", "s")
        .orderBy(F.desc_nulls_last("correlation"), "weather_condition")
    )

