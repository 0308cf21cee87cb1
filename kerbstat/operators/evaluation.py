"""Metrics of scored rows. One grouped pass gives the confusion counts; the rest follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = (0, 1, 2, 3)


def confusion_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per pair of true and predicted class, both counted from 0."""
    return scored.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("count"))


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """One row per true class and one column per predicted class; pairs that never occur are 0.

    Rows without a prediction, or with one that is no class, are counted as ``predicted_other``, and a label that is no
    class has a row of its own, so that all rows are counted once.
    """
    hits = lambda c: F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("count"))), F.lit(0))
    known = F.coalesce(F.col("prediction").isin(*CLASSES), F.lit(False))
    other = F.coalesce(F.sum(F.when(~known, F.col("count"))), F.lit(0))
    classes = counts.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in CLASSES])).alias("label"))
    none = classes.select("label", F.lit(None).cast("int").alias("prediction"), F.lit(0).cast("bigint").alias("count"))
    return (
        counts.unionByName(none)
        .groupBy("label")
        .agg(*[hits(c).alias(f"predicted_{c}") for c in CLASSES], other.alias("predicted_other"))
        .orderBy("label")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(0.0)


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each class; a ratio without a base is 0.

    Every count is given to its true and to its predicted class, so one grouping of
    the few counts serves all columns.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    none, count = F.lit(0).cast("bigint"), F.col("count")

    def share(of: str, support: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(of).alias("class"), support.alias("support"), predicted.alias("predicted"), hits.alias("hits")
        )

    shares = F.array(share("label", count, none, hit), share("prediction", none, count, none))
    per_class = (
        counts.select(F.inline(shares))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    precision, recall = F.col("precision"), F.col("recall")
    return (
        per_class.withColumns(
            {
                "precision": _ratio(F.col("hits"), F.col("predicted")),
                "recall": _ratio(F.col("hits"), F.col("support")),
            }
        )
        .withColumn("f1", _ratio(2 * precision * recall, precision + recall))
        .select("class", "precision", "recall", "f1", "support", "hits")
    )


def overall_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, as one row."""
    support = F.sum("support")
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / support
    return class_report(counts).agg(
        (F.sum("hits").cast("double") / support).alias("accuracy"),
        weighted("f1").alias("f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
    )
