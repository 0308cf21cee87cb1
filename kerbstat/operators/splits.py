"""Train/test splits whose result does not depend on how the rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAIN, TEST = "train", "test"


def random_split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split. Which rows fall where depends on the partitioning."""
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, test


def _digest(key: str, seed: int) -> Column:
    """A null key counts as empty text, so that its rows fall on one side and are not lost."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"#{seed}")))


def hash_split(
    df: DataFrame, train_fraction: float = 0.8, seed: int = 42, key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """A split by the digest of the key: no shuffle, no sort, and a lost task repeats it exactly."""
    digits = 8
    cut = f"{int(train_fraction * 16**digits):0{digits}x}"
    in_train = F.lit(True) if train_fraction >= 1 else F.substring(_digest(key, seed), 1, digits) < cut
    return df.filter(in_train), df.filter(~in_train)


def stratified_split(
    df: DataFrame,
    train_fraction: float = 0.8,
    seed: int = 42,
    key: str = "id",
    label: str = "label",
    prefix_digits: Sequence[int] = (3, 6),
) -> DataFrame:
    """Add ``split``: in each class, exactly ``floor(train_fraction x rows)`` rows are train.

    The rows of a class are ordered by the digest of their key, and the first ones train.
    A class may hold most of the table, so it is never sorted as one group:

    1. rows are counted per class and digest prefix, and the running count shows the one
       prefix in which the cut of the class falls;
    2. the rows of that prefix are counted by a longer prefix, which narrows the cut again;
    3. what is left, one row in 16^6 of a class, is ranked, which gives its last train digest;
    4. every row compares its own digest with that of its class.

    Each step hands the next one map with an entry per class, so the table is neither
    shuffled nor joined. Keys must be unique.
    """
    digest = _digest(key, seed)
    keyed = df.select(F.col(label).alias("cls"), digest.alias("digest"))
    by_class = Window.partitionBy("cls")
    rank = F.floor(F.sum("n").over(by_class) * F.lit(float(train_fraction)))
    candidates = keyed
    for digits in prefix_digits:
        prefix = F.substring("digest", 1, digits)
        counts = candidates.groupBy("cls", prefix.alias("prefix")).agg(F.count("*").alias("n"))
        before = F.sum("n").over(by_class.orderBy("prefix")) - F.col("n")
        reached = (
            counts.withColumns({"before": before, "rank": rank})
            .filter((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n")))
            .select("cls", F.struct("prefix", (F.col("rank") - F.col("before")).alias("rank")).alias("cut"))
        )
        cut = _by_class(reached, "cut")[F.col("cls")]
        rank = cut["rank"]
        candidates = keyed.filter(prefix == cut["prefix"])
    position = F.row_number().over(by_class.orderBy("digest"))
    last_train = _by_class(candidates.withColumn("position", position).filter(F.col("position") == rank), "digest")
    in_train = digest <= last_train[F.col(label)]
    return df.withColumn("split", F.when(in_train, TRAIN).otherwise(TEST))


def _by_class(df: DataFrame, value: str) -> Column:
    """A scalar map from class to value; ``df`` has one row per class."""
    return df.agg(F.map_from_entries(F.collect_list(F.struct("cls", value)))).scalar()


def split_frames(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of a frame with a ``split`` column."""
    side = F.col("split")
    return df.filter(side == TRAIN).drop("split"), df.filter(side == TEST).drop("split")
