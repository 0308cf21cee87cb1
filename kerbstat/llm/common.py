"""What several operators share: hold-out rule, bounded samples, logistic calibration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def held_out(key: Column, parts: int, part: int) -> Column:
    """True where crc32 of the key as text leaves ``part`` modulo ``parts``. A null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part


BATCH_ROWS = 500


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let an Arrow batch hold at most ``rows`` rows: texts are long, and the default of 10,000 takes too much of a
    task's memory. A smaller setting of the session stays; the setting holds for the session.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, rows)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only key and text, under fixed names, so that further columns of any name do no harm."""
    small_batches(docs.sparkSession)
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def in_parts(batch: pa.RecordBatch, name: str = "text", chars: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """A batch cut so that the texts of a part hold about ``chars`` characters or are one text; each part with its texts."""
    lines, start, held = column(batch, name).to_pylist(), 0, 0
    for i, line in enumerate(lines):
        held += len(line or "")
        if held >= chars or i == len(lines) - 1:
            yield batch.slice(start, i + 1 - start), lines[start : i + 1]
            start, held = i + 1, 0


def beside_ids(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The ids of a batch, untouched, beside columns of as many values."""
    return pa.RecordBatch.from_arrays([column(batch, "doc_id"), *columns.values()], names=["doc_id", *columns])


def bounded_sample(labelled: DataFrame, rows: int) -> DataFrame:
    """``(doc_id, label)``: at most ``rows`` rows, those with the smallest hash of the id; one per id.

    Ids that occur with several labels get the smallest. The result is bounded by its parameter,
    so it may be broadcast.
    """
    one = labelled.dropna().groupBy("doc_id").agg(F.min("label").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Weights of a logistic regression, intercept last, by damped Newton steps on the driver's bounded sample."""
    x = np.column_stack([np.asarray(x, float).reshape(len(y), -1), np.ones(len(y))])
    w, y = np.zeros(x.shape[1]), np.asarray(y, float)
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve + 1e-9 * np.eye(len(w)), slope)
        w -= step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
