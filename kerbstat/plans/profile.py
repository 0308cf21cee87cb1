"""Profiles of the table: size, schema, nulls, summaries and correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbstat.functions import clock

SUMMARY_COLUMNS = (
    "severity",
    "distance_mi",
    "temperature_f",
    "visibility_mi",
    "wind_speed_mph",
    "humidity_pct",
)
MEASURES = (
    "temperature_f",
    "humidity_pct",
    "visibility_mi",
    "wind_speed_mph",
    "pressure_in",
    "distance_mi",
)


def table_size(df: DataFrame) -> DataFrame:
    """Row and column count; the scan reads no column at all."""
    return df.agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def schema_listing(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, type string, nullable boolean")


def _per_column(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """One aggregate over the table for all columns, then one result row per column."""
    aggregates = [
        F.struct(F.lit(c).alias("column_name"), *[make(F.col(c)).alias(name) for name, make in measures.items()])
        for c in columns
    ]
    one_row = df.agg(F.array(*aggregates).alias("columns"))
    return one_row.select(F.inline("columns"))


def null_profile(df: DataFrame, *, only_missing: bool = True) -> DataFrame:
    """Null count and percentage of every column, in a single pass."""
    counts = _per_column(
        df,
        df.columns,
        {"null_count": lambda c: F.count_if(c.isNull()), "total": lambda c: F.count("*")},
    )
    pct = F.round(F.try_divide(F.col("null_count").cast("double"), "total") * 100.0, 2)
    profile = counts.select("column_name", "null_count", pct.alias("null_pct"))
    if only_missing:
        profile = profile.filter(F.col("null_pct") > 0)
    return profile.orderBy(F.desc("null_pct"), F.asc("column_name"))


def drop_sparse_columns(df: DataFrame, *, above_pct: float = 25.0) -> DataFrame:
    """The table without the columns whose null percentage is above the threshold.

    The profile has one row per column, so it is small enough to read on the driver.
    """
    sparse = null_profile(df).filter(F.col("null_pct") > above_pct)
    return df.drop(*[row.column_name for row in sparse.collect()])


def numeric_summary(df: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum, one row per column."""
    return _per_column(
        df,
        columns,
        {
            "count": F.count,
            "mean": F.avg,
            "stddev": F.stddev_samp,
            "min": lambda c: F.min(c).cast("double"),
            "max": lambda c: F.max(c).cast("double"),
        },
    )


def _severity_correlation(value: Column) -> Column:
    # corr() divides by zero for a constant column, which is an error in ANSI mode; here it is null.
    severity = F.col("severity")
    spread = F.stddev_pop(F.when(severity.isNotNull(), value)) * F.stddev_pop(F.when(value.isNotNull(), severity))
    return F.try_divide(F.covar_pop(value, severity), spread)


def severity_correlation(df: DataFrame) -> DataFrame:
    """Pearson correlation of the measures, hour and month with severity, lowest first.

    Each pair uses the rows where both sides are known.
    """
    time = F.col("start_time")
    wide = df.select(
        "severity", *MEASURES, clock.hour_of_day(time).alias("hour"), clock.month_of_year(time).alias("month")
    )
    result = _per_column(wide, [*MEASURES, "hour", "month"], {"correlation": _severity_correlation})
    return result.orderBy(F.asc_nulls_last("correlation"), "column_name")
