"""Replay of a stored table as a stream."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstat.functions import clock
from kerbstat.session import scratch_dir
from kerbstat.sources.messages import to_messages
from kerbstat.streaming.sinks import write_parquet_stream

# A time after any accident: the row that carries it moves the watermark past all windows.
END_OF_STREAM = dt.datetime(9999, 1, 1)
RANGE = "__range"
VALUE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def even_boundaries(table: DataFrame, ranges: int) -> list[dt.datetime]:
    """The inner edges of time ranges of equal length; none where no row has a time."""
    low, high = table.agg(F.min("start_time"), F.max("start_time")).first()
    return [] if low is None else [low + (high - low) * k // ranges for k in range(1, ranges)]


def row_boundaries(table: DataFrame, ranges: int, error: float = 0.001) -> list[dt.datetime]:
    """The inner edges of time ranges of about equal numbers of rows, to the second; fewer where many rows share a time."""
    seconds = table.select(clock.epoch_seconds(F.col("start_time")).cast("double").alias("second")).filter("second IS NOT NULL")
    found = seconds.approxQuantile("second", [k / ranges for k in range(1, ranges)], error) if ranges > 1 else []
    first = seconds.agg(F.min("second")).first()[0]
    return [dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s) for s in sorted(set(found)) if s > first]


def short_ranges(table: DataFrame, seconds: int) -> DataFrame:
    """``range, rows`` of the time ranges of ``seconds`` that have rows, on one grid; rows without a time have a null range."""
    number = F.floor(clock.epoch_seconds(F.col("start_time")) / seconds)
    return table.groupBy(number.alias("range")).agg(F.count("*").alias("rows"))


def in_ranges(
    table: DataFrame, boundaries: list[dt.datetime], late: Column | None = None, delay: int = 3
) -> list[DataFrame]:
    """The table by time range, oldest first; rows without a time come with the first.

    The table is derived and read once, and stored in a folder per range, so that a range reads its own files only.
    Rows for which ``late`` holds come ``delay`` ranges after their own, if there are so many.
    """
    steps = [(F.col("start_time") >= clock.moment(b)).cast("int") for b in boundaries]
    own = F.coalesce(sum(steps, F.lit(0)), F.lit(0))
    if late is not None:
        own = F.when(late & (own + delay <= len(boundaries)), own + delay).otherwise(own)
    spark, folder = table.sparkSession, scratch_dir(table.sparkSession, "ranges")
    table.withColumn(RANGE, own).write.partitionBy(RANGE).parquet(folder)
    stored = spark.read.schema(T.StructType([*table.schema, T.StructField(RANGE, T.IntegerType())])).parquet(folder)
    return [stored.filter(F.col(RANGE) == k).drop(RANGE) for k in range(len(boundaries) + 1)]


def as_stream(
    table: DataFrame,
    end_marker: dict[str, str] | None = None,
    *,
    ranges: int = 4,
    files_per_range: int | None = None,
    rows_per_file: int = 250_000,
    late: Column | None = None,
) -> DataFrame:
    """Store a table and read it back as a stream, one time range per micro-batch, oldest first.

    What the table is derived by (joins with skewed keys above all) thus runs as a batch
    job, which adaptive execution tunes; stateful streams run without it. The watermark moves
    on from range to range, so state holds the open windows only. Ranges have about equal numbers of rows, or equal lengths where rows
    are to come ``late``. More ``ranges`` make smaller micro-batches;
    ``files_per_range`` is the number of tasks that write and read one, by default as many as keep files at ``rows_per_file``; no range may have fewer rows than that.

    ``end_marker`` adds one row far in the future, as the newest file, so that the last windows close. The
    marker's own window never closes and so never comes out. Its columns are null but for
    the given ones, which let it pass the filters of a query. ``late`` is that of ``in_ranges``.
    """
    spark, folder = table.sparkSession, scratch_dir(table.sparkSession, "stream")
    if files_per_range is None:
        files_per_range = max(1, -(-table.count() // (ranges * rows_per_file)))
    for chunk in in_ranges(table, even_boundaries(table, ranges) if late is not None else row_boundaries(table, ranges), late):
        chunk.repartition(files_per_range).write.mode("append").parquet(folder)
    if end_marker is not None:
        known = {"start_time": clock.moment(END_OF_STREAM), **{k: F.lit(v) for k, v in end_marker.items()}}
        columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]
        spark.range(0, 1, 1, 1).select(columns).write.mode("append").parquet(folder)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_range).parquet(folder)


def run_to_table(stream: DataFrame, label: str, *, own_state: bool = False) -> DataFrame:
    """Process all available data into Parquet files and return them as a table; ``own_state`` is that of the sink."""
    path = scratch_dir(stream.sparkSession, label)
    write_parquet_stream(stream, path, own_state=own_state).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_to_totals(stream: DataFrame, label: str) -> DataFrame:
    """Process all available data of a streaming aggregate and return its last result, which must be small: it is kept on the driver."""
    spark, name = stream.sparkSession, f"{label}_{uuid.uuid4().hex}"
    writer = stream.writeStream.outputMode("complete").format("memory").queryName(name)
    writer.option("checkpointLocation", scratch_dir(spark, label)).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


def write_chunks(
    df: DataFrame,
    path: str,
    boundaries: list[dt.datetime],
    files_per_chunk: int = 1,
    end_marker: bool = False,
) -> None:
    """Store the rows as JSON messages, one job per time range, oldest first; rows without a time come with the first.

    A file stream reads files in the order of their age. So a reader that takes
    ``files_per_chunk`` files per micro-batch releases one time range after the other.
    ``end_marker`` adds a last file whose one row closes all windows.
    """
    for chunk in in_ranges(df, boundaries):
        to_messages(chunk).select("value").repartition(files_per_chunk).write.mode("append").text(path)
    if end_marker:
        write_end_marker(df.sparkSession, path)


def write_end_marker(spark: SparkSession, path: str) -> None:
    """Add the row that closes all windows as the newest file of a replay folder."""
    time = clock.moment(END_OF_STREAM).alias("start_time")
    to_messages(spark.range(0, 1, 1, 1).select(time), key="start_time").select("value").write.mode("append").text(path)


def message_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A file stand-in for the topic: raw JSON messages, a bounded number of files per micro-batch."""
    reader = spark.readStream.schema(VALUE_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)
