"""0/1 columns; a null input always gives 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEVERE_FROM = 3


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def severe_flag(severity: Column, threshold: int = SEVERE_FROM) -> Column:
    return flag(severity >= threshold)


def night_flag(sunrise_sunset: Column) -> Column:
    return flag(sunrise_sunset == "Night")


def text_flag(value: Column) -> Column:
    """Boolean or its text form (``True/False/1/0``) as 0/1; any other text is 0."""
    return flag(value.cast("string").isin("True", "true", "1"))
