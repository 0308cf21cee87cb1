"""Scoring without a trained model, by the rule-based risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstat.functions import clock, risk


def score_by_rule(df: DataFrame, rush: bool = True) -> DataFrame:
    """Batch or stream: accidents with ``risk``, ``predicted_severity`` and four probabilities.

    Columns only, so it adds no shuffle. A missing measure gives a null outcome.
    """
    hour = clock.hour_of_day(F.col("start_time")) if rush else None
    value = risk.rule_risk(
        F.col("visibility_mi"), F.col("distance_mi"), F.col("humidity_pct"), F.col("wind_speed_mph"), hour
    )
    scored = df.withColumn("risk", value)
    level = risk.rule_severity(F.col("risk"))
    return scored.withColumns(
        {
            "predicted_severity": level,
            "prediction": (level - 1).cast("double"),
            **{
                f"probability_s{i}": p
                for i, p in enumerate(risk.rule_probabilities(F.col("risk")), start=1)
            },
        }
    )
