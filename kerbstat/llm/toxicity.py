"""Toxicity by a weighted finite-state grammar over clauses.

A lexical transducer maps each word to a tag (insult, threat, target, negation, report or none)
and a weight. Three small transducers read a clause's tags and scale the weight of insults and
threats: a target in the clause strengthens them, a negation shortly before weakens them, a verb of reporting
before weakens them for the rest of the clause. They are composed once into a single machine. A
document's features are sums over its matched clauses, never over isolated words, and a logistic fit
turns them into a score.

The tags' word lists are fixed; insults and threats, whole words or word beginnings, are also learned from labelled
rows. Null and empty texts have no clauses and get the score of a document without a match.
Repeated rows get equal scores. Without labels of both kinds the score is ``1 - exp(-sum / 4)``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstat.llm.common import beside_ids, bounded_sample, fit_logistic, in_parts, logistic, texts

SAMPLE_ROWS = 30_000
LEARNED = 4_000  # lexicon entries at most
LEAST_DOCS = 3
STEMS = (4, 5, 6)  # lengths of word beginnings that may be learned
THRESHOLD = 0.7
REMEMBERED = 300_000  # words per task
TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
STOPS = frozenset(".!?;:\n")

# The grammar's own words.
INSULTS = "idiot moron stupid loser pathetic worthless disgusting scum trash clown imbecile fool dumb jerk vermin".split()
THREATS = "kill hurt destroy beat smash punish stab shoot".split()
TARGETS = "you your yours yourself they them their he she him her we us du ihr sie tu vous ils usted ellos".split()
NEGATIONS = "not no never none neither nor nicht kein keine ne pas jamais nunca".split()
REPORTS = "said says wrote writes claimed claims reported reports told quoted asked sagte sagt dit dijo".split()

NONE, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)


@dataclass
class Transducer:
    """Arcs ``(state, tag) -> (next state, factor)``; a missing arc stays and has factor 1."""

    arcs: dict[tuple[int, int], tuple[int, float]]
    states: int

    def then(self, other: Transducer) -> Transducer:
        """The composition: both read every tag, the factors multiply."""
        arcs = {}
        for a in range(self.states):
            for b in range(other.states):
                for tag in range(6):
                    to_a, by_a = self.arcs.get((a, tag), (a, 1.0))
                    to_b, by_b = other.arcs.get((b, tag), (b, 1.0))
                    arcs[(a * other.states + b, tag)] = (to_a * other.states + to_b, by_a * by_b)
        return Transducer(arcs, self.states * other.states)


def negation(reach: int = 3, factor: float = 0.5) -> Transducer:
    """After a negation the next ``reach`` words count less."""
    arcs: dict[tuple[int, int], tuple[int, float]] = {(s, NEGATION): (reach, 1.0) for s in range(reach + 1)}
    for s in range(1, reach + 1):
        arcs |= {(s, t): (s - 1, factor if t in (INSULT, THREAT) else 1.0) for t in range(6) if t != NEGATION}
    return Transducer(arcs, reach + 1)


def reported(factor: float = 0.6) -> Transducer:
    """After a verb of reporting the rest of the clause counts less."""
    return Transducer({(0, REPORT): (1, 1.0), (1, INSULT): (1, factor), (1, THREAT): (1, factor)}, 2)


def target(factor: float = 1.3) -> Transducer:
    """After a target insults count more and threats doubly so."""
    return Transducer({(0, TARGET): (1, 1.0), (1, INSULT): (1, factor), (1, THREAT): (1, factor * factor)}, 2)


GRAMMAR = negation().then(reported()).then(target())


@dataclass
class Lexicon:
    """The lexical transducer: whole words and word beginnings with tag and weight."""

    words: dict[str, tuple[int, float]]
    stems: dict[str, float] = field(default_factory=dict)
    known: dict[str, tuple[int, float]] = field(default_factory=dict)

    def tag(self, word: str) -> tuple[int, float]:
        found = self.known.get(word)
        if found is None:
            found = self.words.get(word)
            if found is None:
                stem = max((self.stems.get(word[:n], 0.0) for n in STEMS if len(word) > n), default=0.0)
                found = (INSULT, stem) if stem else (NONE, 0.0)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = found
        return found


def default_lexicon() -> Lexicon:
    words = {}
    for tag, weight, group in (
        (INSULT, 1.0, INSULTS),
        (THREAT, 0.5, THREATS),
        (TARGET, 0.0, TARGETS),
        (NEGATION, 0.0, NEGATIONS),
        (REPORT, 0.0, REPORTS),
    ):
        words.update({w: (tag, weight) for w in group})
    return Lexicon(words)


def clauses(lexicon: Lexicon, text: str | None) -> list[float]:
    """Scores of the matched clauses of a text, in order."""
    arcs, tag, found = GRAMMAR.arcs, lexicon.tag, []
    tokens = TOKEN.findall((text or "").lower())
    tags = [tag(t) for t in tokens]
    if not any(t[1] for t in tags):
        return found
    state = total = behind = 0
    for token, (kind, weight) in zip(tokens, tags):
        if token in STOPS:
            if total:
                found.append(total)
            state = total = behind = 0
            continue
        state, factor = arcs[(state, kind)]
        if kind == TARGET and total and not behind:
            total, behind = total * 1.15, 1  # a target after the match
        if weight:
            total += weight * factor
    if total:
        found.append(total)
    return found


def features(lexicon: Lexicon, text: str | None) -> list[float]:
    scored = clauses(lexicon, text)
    words = max(1, len(text or "") / 6)
    total = sum(scored)
    return [max(scored, default=0.0), math.log1p(total), float(bool(scored)), min(1.0, 20 * total / words)]


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray | None


def learn(
    docs: DataFrame,
    labels: DataFrame,
    usable=None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn from at most ``sample_rows`` labelled rows; ``usable`` is a condition on the labels' rows.

    Half of them, by hash, give the lexicon: terms counted over distinct texts on Spark, at most ``LEARNED`` kept. The other half fit the score.
    """
    known = labels if usable is None else labels.filter(usable)
    sample = bounded_sample(known.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label")), sample_rows)
    chosen = texts(docs, id_col, text_col).dropna().join(F.broadcast(sample), "doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit("fit")), 2)
    lexicon = default_lexicon()
    fixed = set(lexicon.words)

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, label in zip(batch["text"], batch["label"]):
                found = {w for w in TOKEN.findall(text.lower()) if w not in STOPS}
                for term in found | {w[:n] + "*" for w in found for n in STEMS if len(w) > n}:
                    n = seen.setdefault(term, [0, 0])
                    n[0] += 1
                    n[1] += label
            yield pd.DataFrame({"term": list(seen), "n": [v[0] for v in seen.values()], "bad": [v[1] for v in seen.values()]})

    counted = chosen.filter(half == 0).groupBy("text").agg(F.min("label").alias("label")).mapInPandas(terms, "term string, n long, bad long")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    rate = chosen.filter(half == 0).agg(F.avg("label").alias("p")).first()["p"]
    if rate and 0 < rate < 1:
        lift = F.log((F.col("bad") + 0.1) / (F.col("n") - F.col("bad") + 0.1)) - math.log(rate / (1 - rate))
        good = counted.filter((F.col("bad") >= LEAST_DOCS) & (F.col("bad") >= 0.6 * F.col("n")))
        top = good.withColumn("weight", lift).orderBy(F.desc(F.col("weight") * F.log1p("bad")), "term").limit(LEARNED).toPandas()
        for term, weight in zip(top["term"], top["weight"]):
            if term.endswith("*"):
                lexicon.stems[term[:-1]] = float(weight) / 4
            else:
                tag = lexicon.words.get(term, (INSULT, 0.0))[0] if term in fixed else INSULT
                lexicon.words[term] = (tag if tag in (INSULT, THREAT) else INSULT, float(weight) / 4)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "x": [features(lexicon, t) for t in batch["text"]]})

    fitted = chosen.filter(half == 1).select("label", "text").mapInPandas(measure, "label int, x array<double>").toPandas()
    if fitted["label"].nunique() < 2:
        return Model(lexicon, None)
    return Model(lexicon, fit_logistic(np.array(fitted["x"].tolist()), fitted["label"].to_numpy()))


def scores(model: Model, batch: list[str | None]) -> np.ndarray:
    x = np.array([features(model.lexicon, t) for t in batch]).reshape(len(batch), 4)
    return 1 - np.exp(-np.expm1(x[:, 1]) / 4) if model.weights is None else logistic(x, model.weights)


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id, score, predicted``."""
    source = texts(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            for part, lines in in_parts(batch):
                score = scores(found, lines)
                yield beside_ids(part, score=pa.array(score), predicted=pa.array((score >= THRESHOLD).astype(np.int32)))

    schema = T.StructType().add("doc_id", source.schema["doc_id"].dataType).add("score", "double")
    return source.mapInArrow(run, schema.add("predicted", "integer"))
