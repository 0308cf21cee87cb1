"""Risk bands and the rule-based severity scorer that needs no trained model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbstat.functions.flags import flag

# Weights of the rule, the hours that add to it, and the scale of each measure.
VISIBILITY_WEIGHT, VISIBILITY_CAP = 0.25, 10.0
DISTANCE_WEIGHT, DISTANCE_CAP = 0.20, 10.0
HUMIDITY_WEIGHT, HUMIDITY_SCALE = 0.15, 100.0
WIND_WEIGHT, WIND_SCALE = 0.10, 80.0
RUSH_WEIGHT, RUSH_HOURS = 0.08, (7, 8, 17, 18)

# Cut points of the published colour bands, highest first.
RISK_PCT_CUTS = (48.0, 43.0)
WEATHER_SEVERITY_CUTS = (2.5, 2.2)
STATE_SEVERITY_CUTS = (2.4, 2.3)
BANDS = ("high", "medium", "low")

# Probability of each level before they are normalised, as (at no risk, change per unit of risk).
PROBABILITIES = ((0.1, -0.05), (0.5, -0.2), (0.3, 0.1), (0.1, 0.1))


def risk_band(value: Column, cuts: Sequence[float], strict: bool = False) -> Column:
    """high / medium / low by two descending cut points; ``strict`` excludes the cut itself."""
    high, medium = cuts
    above = (lambda cut: value > cut) if strict else (lambda cut: value >= cut)
    return (
        F.when(above(high), F.lit(BANDS[0]))
        .when(above(medium), F.lit(BANDS[1]))
        .when(value.isNotNull(), F.lit(BANDS[2]))
    )


def _capped(value: Column, cap: float) -> Column:
    # least() skips nulls and would read a missing measure as the cap.
    return F.when(value > cap, F.lit(cap)).otherwise(value)


def rule_risk(
    visibility: Column,
    distance: Column,
    humidity: Column,
    wind: Column,
    hour: Column | None = None,
) -> Column:
    """Weighted risk of one accident; null when a measure is missing. ``hour`` adds the rush part."""
    risk = (
        F.lit(VISIBILITY_WEIGHT) * (F.lit(1.0) - _capped(visibility, VISIBILITY_CAP) / VISIBILITY_CAP)
        + F.lit(DISTANCE_WEIGHT) * _capped(distance, DISTANCE_CAP) / DISTANCE_CAP
        + F.lit(HUMIDITY_WEIGHT) * (humidity / HUMIDITY_SCALE)
        + F.lit(WIND_WEIGHT) * (wind / WIND_SCALE)
    )
    if hour is None:
        return risk
    return risk + F.lit(RUSH_WEIGHT) * flag(hour.isin(*RUSH_HOURS))


def rule_severity(risk: Column) -> Column:
    """Severity 1-4 of a risk; halves round to even."""
    level = F.rint(risk * 5) + 1
    return F.when(level > 4, 4).when(level < 1, 1).otherwise(level.cast("int"))


def rule_probabilities(risk: Column) -> list[Column]:
    """Four class probabilities of a risk, normalised to sum to 1."""
    first, *others = [F.lit(base) + risk * change for base, change in PROBABILITIES]
    parts = [F.when(first < 0, F.lit(0.0)).otherwise(first), *others]
    total = parts[0] + parts[1] + parts[2] + parts[3]
    return [p / total for p in parts]
