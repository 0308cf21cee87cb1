"""Event-time windows over a stream of accidents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstat.functions import clock
from kerbstat.functions.flags import flag
from kerbstat.operators.grouping import mean_severity, row_count, severe_count

# Documented window widths and lateness.
WIDTHS = ("5 minutes", "15 minutes", "60 minutes")
WATERMARK = "10 minutes"
ALERT_FROM = 3


def event_time(df: DataFrame) -> DataFrame:
    """Rows that have a time, with the type that watermarks accept."""
    time = F.col("start_time")
    return df.filter(time.isNotNull()).withColumn("start_time", clock.as_instant(time))


def windowed_severity(
    accidents: DataFrame,
    width: str,
    *,
    slide: str | None = None,
    keys: Sequence[str] = ("state",),
    watermark: str = WATERMARK,
    alert_from: int = ALERT_FROM,
) -> DataFrame:
    """Accidents, mean severity, severe and alert counts per window and key.

    Tumbling unless ``slide`` is given. A stream has one query per width, since windows of two
    widths cannot share a grouping. State holds one row per open window and key, and the
    watermark closes windows; tasks combine their rows before the shuffle. The window
    bounds come out as zone-less times, as the input had them. Batch input gives the
    same rows for all windows at once.
    """
    timed = event_time(accidents)
    measures = [
        row_count().alias("accidents"),
        mean_severity().alias("avg_severity"),
        severe_count().alias("severe_count"),
    ]
    if "predicted_severity" in accidents.columns:
        measures.append(F.sum(flag(F.col("predicted_severity") >= alert_from)).alias("alert_count"))
    windows = F.window("start_time", width, slide) if slide else F.window("start_time", width)
    grouped = timed.withWatermark("start_time", watermark).groupBy(windows.alias("window"), *keys).agg(*measures)
    bounds = [clock.from_instant(F.col(f"window.{b}")).alias(f"window_{b}") for b in ("start", "end")]
    return grouped.select(*bounds, *[c for c in grouped.columns if c != "window"])


def rolling_segments(accidents: DataFrame, *, width: str = "15 minutes", slide: str = "5 minutes") -> DataFrame:
    """Sliding windows per road segment, the streaming form of the rolling severity."""
    known = accidents.filter(F.col("street").isNotNull())
    return windowed_severity(known, width, slide=slide, keys=("street", "city", "state"))
