"""CSV and Parquet forms of the accident table, views and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstat.functions import clock
from kerbstat.operators.grouping import over_groups
from kerbstat.schema import ACCIDENTS, TIME_FORMAT, canonical, header_name

PREVIEW_COLUMNS = ("severity", "state", "temperature_f", "humidity_pct", "weather_condition", "distance_mi")


def _typed(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        return clock.lenient_timestamp(value)
    if isinstance(dtype, T.IntegerType):
        number = value.try_cast("double")  # "3.0" is an integer to the writers of such files, "3.7" is none
        return F.when(number == F.floor(number), number.try_cast(dtype))
    typed = value.try_cast(dtype)
    return F.when(~F.isnan(typed), typed) if isinstance(dtype, T.DoubleType) else typed


def conform(df: DataFrame) -> DataFrame:
    """Rename every column to its canonical name and cast the known ones to the schema.

    A value that does not parse becomes null, and so does ``NaN``. Unknown columns keep their type.
    """
    return df.select(_conformed(df))


def _conformed(df: DataFrame) -> list[Column]:
    types = {f.name: f.dataType for f in ACCIDENTS}
    columns = []
    for header in df.columns:
        name = canonical(header)
        value = F.col("`" + header.replace("`", "``") + "`")
        if name in types and df.schema[header].dataType != types[name]:
            value = _typed(value, types[name])
        columns.append(value.alias(name))
    return columns


REJECTED = "_rejected"
# Why a value is not taken, by the type that it should have.
REASONS = {T.IntegerType: "no integer", T.DoubleType: "no number", T.TimestampNTZType: "no time", T.BooleanType: "no truth value"}


def conform_with_rejects(df: DataFrame) -> DataFrame:
    """``conform``, with what it nulls kept beside the row: ``_rejected`` holds column, raw text and reason of each such value.

    Empty text and ``NaN`` are missing values, not rejected ones.
    """
    types = {f.name: f.dataType for f in ACCIDENTS}
    rejects = []
    for header in df.columns:
        name, value = canonical(header), F.col("`" + header.replace("`", "``") + "`")
        reason = REASONS.get(type(types.get(name)))
        if reason and isinstance(df.schema[header].dataType, T.StringType):
            given = (F.trim(value) != "") & (F.lower(F.trim(value)) != "nan")
            lost = value.isNotNull() & given & _typed(value, types[name]).isNull()
            rejects.append(F.when(lost, F.struct(F.lit(name).alias("column_name"), value.alias("raw"), F.lit(reason).alias("reason"))))
    empty = F.expr("cast(array() as array<struct<column_name string, raw string, reason string>>)")
    found = F.array_compact(F.array(*rejects)) if rejects else empty
    return df.select(*_conformed(df), found.alias(REJECTED))


def read_csv_with_rejects(spark: SparkSession, path: str | list[str], target: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """The table of CSV files and the values that did not parse, as ``id, column_name, raw, reason``, both from one scan.

    The scan is stored under ``target``, rejected values beside their rows; both results read that.
    """
    raw = _csv_text(spark, path, multi_line)
    conformed = conform_with_rejects(raw)
    conformed.write.mode("overwrite").parquet(target)
    stored = spark.read.schema(conformed.schema).parquet(target)
    key = [F.col("id")] if "id" in stored.columns else []
    return stored.drop(REJECTED), stored.filter(F.size(REJECTED) > 0).select(*key, F.inline(REJECTED))


def _csv_text(spark: SparkSession, path: str | list[str], multi_line: bool) -> DataFrame:
    reader = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"')
    return reader.option("multiLine", multi_line).csv(path)


def read_csv(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Scan CSV files with a header line.

    Only the header line is read up front: types come from the schema, not from a pass
    over the data. ``enforceSchema=false`` makes a file with another header fail instead
    of being read by position. Quotes inside a quoted value are doubled, as such files have them; values
    with line breaks need ``multi_line``, which keeps a file from being split.
    """
    return conform(_csv_text(spark, path, multi_line))


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return conform(spark.read.parquet(*paths))


def write_parquet(df: DataFrame, path: str, by_year: bool = False) -> None:
    """Store the table once in columnar form, so that later queries prune and push down.

    ``by_year`` adds partition folders. Rows are rebalanced by year first: adaptive
    execution splits a year that holds most rows and joins small ones, so that files come
    out near the advisory partition size instead of one per task and year.
    """
    if not by_year:
        df.write.mode("overwrite").parquet(path)
        return
    dated = df.withColumn("year", clock.calendar_year(F.col("start_time")))
    dated.hint("rebalance", "year").write.mode("overwrite").partitionBy("year").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Store the table as CSV files under the published headers."""
    writer = with_header_names(df).write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("timestampNTZFormat", TIME_FORMAT).csv(path)


def with_header_names(df: DataFrame) -> DataFrame:
    """The table under its published headers, for SQL text written against those."""
    return df.toDF(*[header_name(c) for c in df.columns])


def add_time_columns(df: DataFrame) -> DataFrame:
    """Add hour, month, day_of_week (0 = Monday) and year where they are missing."""
    time = F.col("start_time")
    derived = {
        "hour": clock.hour_of_day(time),
        "month": clock.month_of_year(time),
        "day_of_week": clock.weekday_from_monday(time),
        "year": clock.calendar_year(time),
    }
    return df.withColumns({name: value for name, value in derived.items() if name not in df.columns})


def register_view(df: DataFrame, name: str = "accidents", header_names: bool = False) -> None:
    """Make the table visible to ``spark.sql``."""
    (with_header_names(df) if header_names else df).createOrReplaceTempView(name)


def preview(df: DataFrame, columns: Sequence[str] = PREVIEW_COLUMNS, rows: int = 8) -> DataFrame:
    """A few rows of those wanted columns that the table has."""
    return df.select([c for c in columns if c in df.columns]).limit(rows)


def random_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def _reached_bucket(counts: DataFrame, rows: Column) -> DataFrame:
    """From counts per bucket, one row with the ``last`` bucket that the first ``rows`` rows reach.

    Beside the ``bucket``: how many rows come ``before`` it, and how many are in any bucket at all.
    """
    before = F.sum("n").over(Window.orderBy("bucket")) - F.col("n")
    return (
        counts.filter(F.col("bucket").isNotNull())
        .withColumns({"before": before, "dated": over_groups(F.sum("n"))})
        .filter(F.col("before") < rows)
        .agg(F.max(F.struct("bucket", "before", "dated")).alias("last"))
    )


def earliest_rows(df: DataFrame, rows: int, time: str = "start_time", tie: str = "id") -> DataFrame:
    """The first ``rows`` rows in time order; rows without a time come last.

    A plain sort with a large limit would send that many rows of every partition to one
    task. So rows are counted by day, and those of the day in which the sample ends by
    second. Only rows up to that second are sorted. The running counts see one row per
    day, and one per second of a day, whatever the size of the table.
    """
    when, count = F.col(time), F.count("*").alias("n")
    by_day = df.groupBy(F.to_date(when).alias("bucket")).agg(count)
    last_day = _reached_bucket(by_day, F.lit(rows)).scalar()
    on_last_day = df.filter(F.to_date(when) == last_day["bucket"])
    by_second = on_last_day.groupBy(F.date_trunc("second", when).alias("bucket")).agg(count)
    last_second = _reached_bucket(by_second, F.lit(rows) - last_day["before"])
    # The end is a bare subquery, which the file scan can take as a bound.
    after = F.col("last.bucket") + F.expr("INTERVAL 1 SECOND")
    end = last_second.select(after.cast(df.schema[time].dataType)).scalar()
    dated = F.coalesce(last_day["dated"], F.lit(0))
    reached = df.filter((when < end) | (when.isNull() & (dated < rows)))
    return reached.orderBy(F.asc_nulls_last(time), F.asc_nulls_last(tie)).limit(rows)
