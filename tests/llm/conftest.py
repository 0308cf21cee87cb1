from __future__ import annotations

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def load(spark, folder):
    return lambda name, base=folder: spark.read.parquet(f"{base}/{name}.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in all columns, empty and very long texts, repeated rows, and a column that clashes with results."""
    rows = [
        (1, "the cat sat on the mat and looked at the dog for a long while", "en", "x"),
        (1, "the cat sat on the mat and looked at the dog for a long while", "en", "x"),
        (2, "the cat sat on the mat and looked at the dog for a long while", "en", None),
        (3, None, None, None),
        (4, "", "fr", "x"),
        (5, " \n\t ", None, "x"),
        (6, "1234 !!! ---", "en", "x"),
        (7, "a", "en", "x"),
        (8, "lorem ipsum dolor " * 30_000, "en", "x"),
        (9, "x" * 200_000, "de", "x"),
        (None, "no id here at all, just text under the MIT License", "en", "x"),
        (10, "\U0001f600 naïve ÀÉ 日本語 \x00 end", "fr", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.withColumn("score", F.lit("clash")).withColumn("node", F.lit(0)).withColumn("n", F.lit(1))


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 11)] + [(None, 1, 0), (3, None, None), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
