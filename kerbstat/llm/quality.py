"""Quality from compression: which of two dictionaries makes a text smaller.

A zstandard dictionary is trained on good labelled text and one on bad. A text is compressed with each
and with none. The normalised difference ``(good - bad) / (good + bad)`` says which kind it
resembles; the size without dictionary against the raw size says how repetitive it is. A logistic
fit on labelled rows that trained neither dictionary turns them into a score from 0 to 1.

Null and empty texts get the score of an empty text. Repeated rows get equal scores. Without
usable labels of both kinds every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstat.llm.common import beside_ids, bounded_sample, fit_logistic, in_parts, logistic, small_batches, texts

SAMPLE_ROWS = 12_000
PIECES, PIECE = 1_500, 2_000  # per label: pieces of a dictionary's text, characters of a piece
DICTIONARY = 64_000  # bytes
BLOCK = 1 << 20  # bytes compressed at a time
THRESHOLD = 0.7


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray | None


class Sizes:
    """Compressed sizes of texts; made once per task."""

    def __init__(self, good: bytes, bad: bytes):
        self.by = [zstandard.ZstdCompressor(level=3, dict_data=self.loaded(d)) for d in (good, bad)]
        self.by.append(zstandard.ZstdCompressor(level=3))

    @staticmethod
    def loaded(raw: bytes) -> zstandard.ZstdCompressionDict:
        made = zstandard.ZstdCompressionDict(raw)
        made.precompute_compress(level=3)
        return made

    def features(self, text: str | None) -> list[float]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        size = [0, 0, 0]
        for at in range(0, max(1, len(raw)), BLOCK):
            block = raw[at : at + BLOCK]
            for i, tool in enumerate(self.by):
                size[i] += len(tool.compress(block)) - 9
        good, bad, plain = (max(1, s) for s in size)
        length = max(1, len(raw))
        towards = (bad - good) / (good + bad)
        ratio, log = plain / length, np.log(length)
        gain = (plain - good) / plain
        return [towards, towards * log, abs(towards), gain, min(ratio, 1.2), min(ratio, 1.2) ** 2, np.log(ratio), np.log(ratio) * log, log, log * log]


def dictionary(pieces: list[bytes]) -> bytes:
    """Trained, or where there is too little text to train on, that text itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[:DICTIONARY] or b" " * 8


def learn(
    docs: DataFrame,
    labels: DataFrame,
    usable=None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn from at most ``sample_rows`` labelled rows; ``usable`` is a condition on the labels' rows.

    A third of them, by hash, supplies pieces for the dictionaries (a bounded number), the rest the fit.
    """
    known = labels if usable is None else labels.filter(usable)
    sample = bounded_sample(known.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label")), sample_rows)
    chosen = texts(docs, id_col, text_col).dropna().join(F.broadcast(sample), "doc_id")
    part = F.pmod(F.xxhash64("doc_id", F.lit("fit")), 3)
    piece = F.explode(F.sequence(F.lit(0), (F.length("text") / PIECE).cast("int")))
    pieces = chosen.filter(part == 0).withColumn("at", piece)
    pieces = pieces.select("label", F.expr(f"substring(text, at * {PIECE} + 1, {PIECE})").alias("piece")).filter("piece <> ''").distinct()
    by = {}
    # A share of the distinct pieces, by hash, that holds some 3 * PIECES however many there are; the driver keeps the first PIECES.
    for row in pieces.groupBy("label").count().collect():
        share = F.lit(min(1.0, 3 * PIECES / row["count"]) * 2.0**63)
        drawn = pieces.filter((F.col("label") == row["label"]) & ((F.xxhash64("piece").bitwiseAND(F.lit((1 << 63) - 1))).cast("double") < share))
        rows = sorted((r["order"], r["piece"]) for r in drawn.select(F.xxhash64("piece").bitwiseAND(F.lit((1 << 63) - 1)).alias("order"), "piece").toLocalIterator())
        by[row["label"]] = [piece.encode("utf-8", "surrogatepass") for _, piece in rows[:PIECES]]
    good, bad = dictionary(by.get(1, [])), dictionary(by.get(0, []))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = Sizes(good, bad)
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "x": [sizes.features(t) for t in batch["text"]]})

    fitted = chosen.filter(part != 0).select("label", "text").mapInPandas(measure, "label int, x array<double>").toPandas()
    if fitted["label"].nunique() < 2 or len(by) < 2:
        return Model(good, bad, None)
    x = np.array(fitted["x"].tolist())
    shift, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = fit_logistic((x - shift) / scale, fitted["label"].to_numpy(), penalty=1.0)
    return Model(good, bad, np.concatenate([w[:-1] / scale, [w[-1] - (w[:-1] * shift / scale).sum()]]))


def scores(model: Model, sizes: Sizes, batch: list[str | None]) -> np.ndarray:
    if model.weights is None:
        return np.full(len(batch), 0.5)
    x = np.array([sizes.features(t) for t in batch]).reshape(len(batch), -1)
    return logistic(x, model.weights) if len(batch) else np.zeros(0)


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id, score, predicted``."""
    source = texts(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value.good, shared.value.bad)
        for batch in batches:
            for part, lines in in_parts(batch):
                score = scores(shared.value, sizes, lines)
                yield beside_ids(part, score=pa.array(score), predicted=pa.array((score >= THRESHOLD).astype(np.int32)))

    schema = T.StructType().add("doc_id", source.schema["doc_id"].dataType).add("score", "double")
    return source.mapInArrow(run, schema.add("predicted", "integer"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, whole, whose score is at least ``least``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value.good, shared.value.bad)
        for batch in batches:
            for part, lines in in_parts(batch, text_col):
                yield part.filter(pa.array(scores(shared.value, sizes, lines) >= least))

    return docs.mapInArrow(run, docs.schema)
