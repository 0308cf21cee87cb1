"""The accident table: one explicit schema, and the mapping from file headers to it."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Times carry no zone, so they are TIMESTAMP_NTZ: hour and weekday never depend on the
# session time zone. Only the streaming path casts to TIMESTAMP, which watermarks need.
ACCIDENTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("severity", T.IntegerType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("start_lng", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField("end_lng", T.DoubleType()),
        T.StructField("distance_mi", T.DoubleType()),
        T.StructField("street", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("temperature_f", T.DoubleType()),
        T.StructField("wind_chill_f", T.DoubleType()),
        T.StructField("humidity_pct", T.DoubleType()),
        T.StructField("pressure_in", T.DoubleType()),
        T.StructField("visibility_mi", T.DoubleType()),
        T.StructField("wind_speed_mph", T.DoubleType()),
        T.StructField("precipitation_in", T.DoubleType()),
        T.StructField("weather_condition", T.StringType()),
        T.StructField("junction", T.BooleanType()),
        T.StructField("traffic_signal", T.BooleanType()),
        T.StructField("crossing", T.BooleanType()),
        T.StructField("sunrise_sunset", T.StringType()),
        T.StructField("civil_twilight", T.StringType()),
    ]
)

# The published header of each column whose unit suffix or capitals
# cannot be derived back from the canonical name.
HEADER_NAMES = {
    "id": "ID",
    "distance_mi": "Distance(mi)",
    "temperature_f": "Temperature(F)",
    "wind_chill_f": "Wind_Chill(F)",
    "humidity_pct": "Humidity(%)",
    "pressure_in": "Pressure(in)",
    "visibility_mi": "Visibility(mi)",
    "wind_speed_mph": "Wind_Speed(mph)",
    "precipitation_in": "Precipitation(in)",
}

# Text form of times on output; the default of text formats keeps milliseconds only.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def canonical(header: str) -> str:
    """``" Humidity(%) "`` -> ``humidity_pct``: trimmed, lower snake case, unit kept."""
    name = header.strip().lower().replace("%", "pct")
    return re.sub(r"[^0-9a-z]+", "_", name).strip("_")


def header_name(column: str) -> str:
    """The file header that belongs to a canonical column name."""
    return HEADER_NAMES.get(column, "_".join(p.capitalize() for p in column.split("_")))
