"""Long results turned into the wide tables behind the heatmaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstat.functions import clock, labels
from kerbstat.operators.grouping import mean_severity, row_count

TIME = "start_time"
WEEK_FROM_MONDAY = clock.SHORT_DAY_NAMES[1:] + clock.SHORT_DAY_NAMES[:1]
BAND_ORDER = tuple(sorted([*clock.TIME_BANDS, clock.NIGHT]))


def heatmap_pivot(df: DataFrame) -> DataFrame:
    """Mean severity with one row per weekday, Monday first, and one column per hour.

    All seven days are present, as are all 24 hours; a pair without accidents is null. A row without an hour
    for each day joins the rows, so that no table need be joined.
    """
    time, week = F.col(TIME), F.array(*[F.lit(d) for d in WEEK_FROM_MONDAY])
    hours = df.filter(time.isNotNull()).select(
        clock.weekday_name(time, short=True).alias("day_of_week"), clock.hour_of_day(time).alias("__hour"), "severity"
    )
    none = df.sparkSession.range(1).select(
        F.explode(week).alias("day_of_week"), F.lit(None).cast("int").alias("__hour"), F.lit(None).cast("int").alias("severity")
    )
    wide = hours.unionByName(none).groupBy("day_of_week").pivot("__hour", list(range(24))).agg(mean_severity())
    order = (F.array_position(week, F.col("day_of_week")) - 1).cast("int").alias("day_order")
    return wide.select(order, "day_of_week", *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in range(24)]).orderBy("day_order")


def compound_pivot(df: DataFrame, *, min_count: int = 200) -> DataFrame:
    """Mean severity with one row per road type and one column per time band.

    A pair at or below the threshold is null; a road type without any pair above it is left out.
    """
    pairs = (
        df.groupBy(
            labels.road_type(F.col("junction"), F.col("traffic_signal")).alias("road_type"),
            clock.time_band(F.col(TIME)).alias("time_of_day"),
        )
        .agg(row_count().alias("n"), mean_severity().alias("avg_severity"))
        .filter(F.col("n") > min_count)
    )
    wide = pairs.groupBy("road_type").pivot("time_of_day", list(BAND_ORDER)).agg(F.first("avg_severity"))
    named = [F.col(f"`{b}`").alias(b.lower().replace(" ", "_")) for b in BAND_ORDER]
    return wide.select("road_type", *named).orderBy("road_type")
