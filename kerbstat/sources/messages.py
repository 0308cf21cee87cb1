"""Accidents as JSON messages: Kafka source and sink, and the parser they share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstat.schema import ACCIDENTS, TIME_FORMAT

# Defaults of the documented topic.
TOPIC = "traffic-accidents"
BROKERS = "localhost:9092"

MALFORMED = "_malformed"


def kafka_stream(
    spark: SparkSession,
    brokers: str = BROKERS,
    topic: str = TOPIC,
    starting: str = "earliest",
    max_offsets: int | None = None,
    **options: str,
) -> DataFrame:
    """Raw messages of a topic. ``max_offsets`` bounds the records of one micro-batch."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def parse_messages(
    raw: DataFrame, schema: T.StructType = ACCIDENTS, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Typed accidents from a JSON ``value`` column, batch or stream.

    ``keep`` names columns of the message itself to carry along, such as ``offset``.

    A field that is absent is null. Text that is no JSON of this shape is kept in
    ``_malformed``, so no message is lost.
    """
    with_malformed = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    parsed = F.from_json(
        F.col(value).cast("string"),
        with_malformed,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED},
    )
    return raw.select(*keep, parsed.alias("event")).select(*keep, "event.*")


def to_messages(
    df: DataFrame, topic: str = TOPIC, key: str = "id", topic_per_state: bool = False
) -> DataFrame:
    """One ``(topic, key, value)`` row per accident, the value being its JSON.

    ``key`` decides the Kafka partition: the id spreads rows evenly, while ``state`` keeps
    a state in order but lets a large state fill one partition. ``topic_per_state`` gives
    each state its own topic.
    """
    name = F.lit(topic)
    if topic_per_state:
        slug = F.regexp_replace(F.coalesce(F.col("state"), F.lit("unknown")), "[^A-Za-z0-9._-]", "_")
        name = F.concat(name, F.lit("-"), slug)
    return df.select(
        name.alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns), {"timestampNTZFormat": TIME_FORMAT}).alias("value"),
    )


def publish(df: DataFrame, brokers: str = BROKERS, **kwargs) -> None:
    """Write the table to Kafka, every partition in parallel."""
    to_messages(df, **kwargs).write.format("kafka").option("kafka.bootstrap.servers", brokers).save()
