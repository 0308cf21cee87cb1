"""Model inputs: feature frames, encoders and class weights."""

from __future__ import annotations

from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstat.functions import clock, flags
from kerbstat.operators.grouping import over_groups

# Inputs of the three published models.
IMPUTED = (
    "temperature_f",
    "visibility_mi",
    "wind_speed_mph",
    "humidity_pct",
    "precipitation_in",
    "distance_mi",
)
FOREST_FEATURES = (*IMPUTED, "hour_of_day", "day_of_week", "is_night", "junction_int", "traffic_signal_int")

WEIGHTED_FEATURES = (
    "temperature_f",
    "humidity_pct",
    "visibility_mi",
    "wind_speed_mph",
    "pressure_in",
    "distance_mi",
    "junction",
    "crossing",
    "traffic_signal",
)

CATEGORIES = ("weather_condition", "state", "sunrise_sunset")
CODES = tuple(f"{c}_code" for c in CATEGORIES)
MISSING = "nan"
BOOSTED_FEATURES = (*WEIGHTED_FEATURES[:6], "hour", "day_of_week", "month", *WEIGHTED_FEATURES[6:], *CODES)


def labelled(df: DataFrame) -> DataFrame:
    """Rows with a severity, as a label counted from 0."""
    return df.dropna(subset=["severity"]).withColumn("label", (F.col("severity") - 1).cast("double"))


def forest_frame(df: DataFrame) -> DataFrame:
    """The eleven forest features beside the columns of the table."""
    time = F.col("start_time")
    return df.withColumns(
        {
            "hour_of_day": clock.hour_of_day(time),
            "day_of_week": clock.weekday_from_sunday(time),
            "is_night": flags.night_flag(F.col("sunrise_sunset")),
            "junction_int": flags.flag(F.col("junction")),
            "traffic_signal_int": flags.flag(F.col("traffic_signal")),
        }
    )


def weighted_frame(df: DataFrame) -> DataFrame:
    """The nine features of the class-balanced forest; a row with any of them missing is left out."""
    complete = df.dropna(subset=list(WEIGHTED_FEATURES))
    return complete.withColumns({c: flags.text_flag(F.col(c)) for c in WEIGHTED_FEATURES[6:]})


def boosted_frame(df: DataFrame) -> DataFrame:
    """Inputs of the boosted model.

    A missing category is a category of its own; a row with any other feature missing is
    left out. The category codes are added later, by the fitted encoder.
    """
    time = F.col("start_time")
    dated = df.withColumns(
        {
            "hour": clock.hour_of_day(time),
            "day_of_week": clock.weekday_from_monday(time),
            "month": clock.month_of_year(time),
            **{c: F.coalesce(F.col(c), F.lit(MISSING)) for c in CATEGORIES},
        }
    )
    inputs = [f for f in BOOSTED_FEATURES if f not in CODES]
    complete = dated.dropna(subset=inputs)
    return complete.withColumns({c: flags.text_flag(F.col(c)) for c in WEIGHTED_FEATURES[6:]})


def mean_imputer() -> Imputer:
    """Fills null and NaN by the column mean; all means come from one pass."""
    return Imputer(inputCols=list(IMPUTED), outputCols=list(IMPUTED), strategy="mean")


def assembler(features: tuple[str, ...]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def category_encoder() -> StringIndexer:
    """Alphabetical integer codes; a category unseen in training gets the next free code."""
    return StringIndexer(
        inputCols=list(CATEGORIES),
        outputCols=[f"{c}_index" for c in CATEGORIES],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )


def plain_codes() -> SQLTransformer:
    """Codes without category metadata: trees then split them as numbers, for any number of categories."""
    columns = ", ".join(f"{c}_index + 0D AS {c}_code" for c in CATEGORIES)
    return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def category_codes(df: DataFrame) -> DataFrame:
    """The integer codes of each row's categories."""
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(MISSING)) for c in CATEGORIES})
    coded = category_encoder().fit(filled).transform(filled)
    return coded.select("id", *[F.col(f"{c}_index").cast("int").alias(f"{c}_code") for c in CATEGORIES])


def impute_means(df: DataFrame) -> DataFrame:
    """The fill value of each imputed column."""
    model = mean_imputer().fit(labelled(df))
    fills = model.surrogateDF
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("mean")) for c in IMPUTED])
    return fills.select(F.inline(pairs))


def class_weights(df: DataFrame) -> DataFrame:
    """Balanced weight of each class: rows / (classes x rows of the class)."""
    counts = df.groupBy("label").agg(F.count("*").alias("rows"))
    total, classes = over_groups(F.sum("rows")), over_groups(F.count("*"))
    return counts.withColumn("weight", total.cast("double") / (classes * F.col("rows")))


def with_class_weight(df: DataFrame, weights: DataFrame) -> DataFrame:
    """Attach the class weight to every row without shuffling the rows.

    The weights become one map, which reaches the rows as a scalar subquery. The map has
    one entry per class.
    """
    lookup = weights.agg(F.map_from_entries(F.collect_list(F.struct("label", "weight")))).scalar()
    return df.withColumn("weight", lookup[F.col("label")])
