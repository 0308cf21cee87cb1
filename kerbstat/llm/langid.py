"""Language identification by bit-sliced Bloom filters over character n-grams.

Slot s of the filter holds one bit per language. The AND of a gram's slots is the set of all
languages that contain the gram. A text's hits per language are the popcounts of that
language's bit over all its grams; the hits that the filter's fill lets one expect by chance are
taken off; the language with most hits left decides.

Grams are three characters of the lower-cased text, anything but letters counting as one blank, with a
letter in the middle. Null texts and texts without a letter are ``und`` with score 0. If nothing is
left after the correction, the most common language is given, with score 0. Ties go to the name that sorts first.
Repeated rows get equal results. With no labelled rows every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstat.llm.common import beside_ids, bounded_sample, in_parts, small_batches, texts

SAMPLE_ROWS = 20_000
GRAMS = 6_000  # per language
SHARE = 0.2  # a language contains a gram if its rate there is this much of the largest rate
HASHES = 3
UNKNOWN = "und"
ACCEPTED = 0.25  # a filtering stage keeps texts of which the language explains this share of grams

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """A flag per code point, made once per process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def grams(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all grams of the texts, the number of grams of each text, and whether it has a letter."""
    joined = "\n" + "\n".join(t.lower().replace("\n", " ") for t in batch) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[points]
    owner = np.cumsum(points == 10) - 1
    plain = np.where(letter, points, 32).astype(np.uint64)
    middle = np.flatnonzero(letter[1:-1]) + 1
    codes = (plain[middle - 1] << np.uint64(42)) | (plain[middle] << np.uint64(21)) | plain[middle + 1]
    counts = np.bincount(owner[middle], minlength=len(batch))[: len(batch)]
    return codes, counts, counts > 0


def slots(codes: np.ndarray, size: int) -> list[np.ndarray]:
    """``HASHES`` slots for each code; ``size`` is a power of two."""
    mixed = codes * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    step = np.uint64(64 // HASHES)
    return [((mixed >> (step * np.uint64(k))) & np.uint64(size - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass
class Model:
    languages: list[str]
    common: int  # the most common language
    filter: np.ndarray  # slots x words of 64 languages
    by_chance: np.ndarray  # rate of false hits per language

    def hits(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Corrected hits: a row per text, a column per language."""
        ends = np.cumsum(counts)
        out = np.zeros((len(counts), len(self.languages)))
        at = slots(codes, len(self.filter))
        for word in range(self.filter.shape[1]):
            column = self.filter[:, word]
            found = column[at[0]]
            for more in at[1:]:
                found &= column[more]
            for bit in range(min(64, len(self.languages) - 64 * word)):
                total = np.concatenate([[0], np.cumsum((found >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
                out[:, 64 * word + bit] = total[ends] - total[ends - counts]
        chance = self.by_chance[None, :]
        return np.maximum(0, (out - counts[:, None] * chance) / (1 - chance))


def learn(
    docs: DataFrame,
    usable=None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    grams_kept: int = GRAMS,
) -> Model:
    """Learn from at most ``sample_rows`` labelled rows for which ``usable`` holds; whole texts are counted.

    Counting runs on Spark; the driver gets at most ``grams_kept`` counts per language.
    """
    known = docs if usable is None else docs.filter(usable)
    sample = bounded_sample(known.select(docs[id_col].alias("doc_id"), docs[label_col].alias("label")), sample_rows)
    chosen = texts(known, id_col, text_col).dropna().join(F.broadcast(sample), "doc_id")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for label, part in batch.groupby("label"):
                codes, counts = np.unique(grams(list(part["text"]))[0], return_counts=True)
                yield pd.DataFrame({"label": label, "code": codes.astype(np.int64), "n": counts})

    counted = chosen.select("label", "text").mapInPandas(count, "label string, code long, n long")
    counted = counted.groupBy("label", "code").agg(F.sum("n").alias("n"))
    total = counted.groupBy("label").agg(F.sum("n").alias("total"))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "code")))
    rows = ranked.filter(F.col("rank") <= grams_kept).join(F.broadcast(total), "label")
    table = rows.select("label", "code", (F.col("n") / F.col("total")).alias("rate"), "total").toPandas()
    return build(table)


def build(table: pd.DataFrame) -> Model:
    languages = sorted(table["label"].unique())
    size = 1 << max(10, int(np.ceil(np.log2(16 * max(1, table.groupby("label").size().max() if len(table) else 1)))))
    words = max(1, -(-len(languages) // 64))
    bits = np.zeros((size, words), np.uint64)
    best = table.groupby("code")["rate"].transform("max")
    table = table[table["rate"] >= SHARE * best]
    fill = np.zeros(len(languages))
    for i, name in enumerate(languages):
        codes = table.loc[table["label"] == name, "code"].to_numpy().astype(np.uint64)
        for at in slots(codes, size):
            bits[at, i // 64] |= np.uint64(1 << (i % 64))
        fill[i] = ((bits[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()
    totals = table.groupby("label")["total"].max()
    common = int(np.argmax([totals.get(n, 0) for n in languages])) if languages else 0
    return Model(languages, common, bits, fill**HASHES)


def predict(model: Model, batch: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """For each text its language, that one's part of the two best, and its share of the grams."""
    lines = [t or "" for t in batch]
    if not lines or not model.languages:
        return [UNKNOWN] * len(lines), np.zeros(len(lines)), np.zeros(len(lines))
    codes, counts, has = grams(lines)
    hits = model.hits(codes, counts)
    best = np.where(hits.max(axis=1) > 0, hits.argmax(axis=1), model.common)
    top = hits[np.arange(len(lines)), best]
    second = np.partition(hits, -2, axis=1)[:, -2] if hits.shape[1] > 1 else np.zeros(len(lines))
    names = np.array(model.languages, object)
    score = np.where(has & (top > 0), top / np.maximum(top + second, 1e-12), 0.0)
    explained = np.where(has, np.minimum(1.0, top / np.maximum(counts, 1)), 0.0)
    return np.where(has, names[best], UNKNOWN).tolist(), score, explained


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id, lang_pred, score, explained``."""
    source = texts(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, lines in in_parts(batch):
                names, score, explained = predict(shared.value, lines)
                yield beside_ids(part, lang_pred=pa.array(names, pa.string()), score=pa.array(score), explained=pa.array(explained))

    key = source.schema["doc_id"].dataType
    schema = T.StructType().add("doc_id", key).add("lang_pred", "string").add("score", "double")
    return source.mapInArrow(run, schema.add("explained", "double"))


def keep_known(docs: DataFrame, model: Model, text_col: str = "text", least: float = ACCEPTED) -> DataFrame:
    """The rows, whole, whose text has a language that explains at least ``least`` of its grams."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, lines in in_parts(batch, text_col):
                names, _, explained = predict(shared.value, lines)
                yield part.filter(pa.array([name != UNKNOWN and share >= least for name, share in zip(names, explained)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
