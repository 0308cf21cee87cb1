"""The accident table derived from the event, customer and nation tables.

Each event stands for one accident. Its customer gives the city and state, and the rest
follows from the event id and value. Missing values are deliberate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns in use; a declared schema spares a job that reads file footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
}


def _missing_every(n: int, value: Column) -> Column:
    return F.when(F.col("event_id") % n != 0, value)


def accidents_from(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """No join side is hinted: customers grow with the data, so Spark decides from the file
    size whether one is small enough to broadcast, and splits skewed keys otherwise.
    """
    key, value = F.col("event_id"), F.col("value")
    severity = F.when(value < 2, 1).when(value < 45, 2).when(value < 150, 3).otherwise(4)
    visibility = F.greatest(F.lit(0.25), F.lit(10.0) - value / 20.0)
    daylight = F.when(F.hour("ts").between(6, 17), "Day").otherwise("Night")
    place = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("c_mktsegment").alias("city"), F.col("n_name").alias("state")
    )
    return events.join(place, F.col("user_id") == F.col("c_custkey")).select(
        F.concat(F.lit("A-"), key.cast("string")).alias("id"),
        severity.alias("severity"),
        _missing_every(211, F.col("ts")).alias("start_time"),
        _missing_every(41, F.concat(F.lit("ST_"), (key % 23).cast("string"))).alias("street"),
        "city",
        "state",
        _missing_every(37, F.col("event_type")).alias("weather_condition"),
        _missing_every(53, ((key * 7) % 97 - 5).cast("double")).alias("temperature_f"),
        _missing_every(59, (20 + (key * 13) % 81).cast("double")).alias("humidity_pct"),
        _missing_every(61, visibility).alias("visibility_mi"),
        _missing_every(67, ((key * 11) % 40).cast("double")).alias("wind_speed_mph"),
        _missing_every(3, (key % 10).cast("double") / 100.0).alias("precipitation_in"),
        (F.lit(29.0) + (key % 20).cast("double") / 10.0).alias("pressure_in"),
        (value / 100.0).alias("distance_mi"),
        (F.col("user_id") % 3 == 0).alias("junction"),
        (key % 5 < 2).alias("traffic_signal"),
        (key % 4 == 0).alias("crossing"),
        _missing_every(97, daylight).alias("sunrise_sunset"),
    )


def _static(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def accidents(spark: SparkSession, folder: str) -> DataFrame:
    return accidents_from(*[_static(spark, folder, name) for name in ("events", "customer", "nation")])
