"""Language-model scores by deleted interpolation of word bigrams.

The probability of a token after another is a mixture of maximum-likelihood estimates, of the bigram, of the token, and the uniform one
over the vocabulary and the unknown; the weights depend on how often the context occurs, in buckets of powers of two. They are learned by
expectation-maximisation on held-out counts: each training document in turn is held out, its own counts deleted from the corpus's, and all
of its tokens are events. An event only matters by its bucket and its counts, rounded to quarters of an octave; so the events of all documents
become a table of cells whose size does not grow, on which the driver runs the rounds. Nothing is sampled or pruned: all bigrams of all documents count.

Tasks look at bundles of documents. A bundle asks for the counts of its distinct words and bigrams, as sorted 64-bit hashes cut by their leading bits into shards, and
adds its own counts of training text; a shard sums what it gets and answers every bundle. So a word that all documents use costs a
row per bundle, and the shuffle carries some six bytes per distinct bigram of a bundle. Bundles and shards are bounded by ``bundle_tokens`` and ``shard_bytes``; as
each bundle meets each shard, both should be raised (with the memory of a task) for corpora beyond some hundred GB.

Null and empty texts are one token, the end. Repeated rows get equal results, and count as often as they occur. With no training
text every probability is uniform. A null in ``usable`` keeps a row out of training. A text longer than ``SLICE`` bytes is cut at white space into parts that
may lie in several bundles (for the weights, each part is held out by itself). Columns are taken by name up front, so others may have any name. The documents should be a stored table: a
task that is repeated must meet the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbstat.llm.common import texts
from kerbstat.session import scratch_dir

BUNDLE_TOKENS = 2_000_000
SHARD_BYTES = 4_000_000  # of text whose n-grams a shard counts
SLICE = 1 << 20  # bytes of a text looked at together
REMEMBERED = 100_000  # words
BUCKETS = 64  # of contexts, by the binary logarithm of their counts
STEPS = 4  # of an octave, by which events are rounded
ROUNDS = 200
ODD = np.uint64(0x9E3779B97F4A7C15)
START, END = (np.uint64(xxhash.xxh64_intdigest(b"\x20" + name)) for name in (b"start", b"end"))  # no word holds a blank
WHITE = re.compile(rb"[\x20\x09-\x0D]")
DOCS, WORDS, PAIRS = 0, 1, 2


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


# --- arrays as bytes ---------------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, compressed: high bytes are mostly equal."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(raw: bytes, kind=np.uint64) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(kind).ravel()


def packed_sorted(hashes: np.ndarray) -> bytes:
    return packed(np.diff(hashes, prepend=np.uint64(0)))


def unpacked_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw), dtype=np.uint64)


def pair_hashes(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    h = context * ODD + token
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(31))


# --- bundles -------------------------------------------------------------------------------------


def parts(text: str | None) -> Iterator[bytes]:
    """A text with its A-Z lower-cased, in parts that end at white space."""
    raw, at = (text or "").encode("utf-8", "surrogatepass").lower(), 0  # changes A-Z only
    while len(raw) - at > SLICE and (cut := WHITE.search(raw, at + SLICE)):
        yield raw[at : cut.start()]
        at = cut.start()
    yield raw[at:]


class Bundle:
    """Tokens of some documents or parts of documents."""

    def __init__(self):
        self.tokens, self.lengths, self.first, self.train, self.rows, self.ids, self.size = [], [], [], [], [], [], 0

    def add(self, tokens: np.ndarray, first: np.uint64, train: bool, row: int, doc_id) -> None:
        self.tokens.append(tokens)
        self.lengths.append(len(tokens))
        self.first.append(int(first.astype(np.int64)))
        self.train.append(train)
        self.rows.append(row)
        self.ids.append(doc_id)
        self.size += len(tokens)


def contexts(tokens: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[np.cumsum(lengths) - lengths] = first
    return out


def asked(bundle: Bundle, number: int, shards: int) -> Iterator[dict]:
    """The rows of a bundle: its tokens as ranks of its vocabulary, and for each shard the hashes asked for with the bundle's own training counts."""
    tokens, lengths = np.concatenate(bundle.tokens), np.array(bundle.lengths)
    first, train = np.array(bundle.first, np.int64).astype(np.uint64), np.array(bundle.train, bool)
    counted = np.repeat(train, lengths)
    words = np.unique(np.concatenate([tokens, first]))
    place = np.searchsorted(words, tokens)
    own = np.bincount(place[counted], minlength=len(words))
    own[words == START] = (train & (first == START)).sum()
    common = np.argsort(-np.bincount(place, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[common] = np.arange(len(words), dtype=np.uint32)
    yield {
        "bundle": number, "shard": number % shards, "part": DOCS, "a": packed(rank[place]), "b": packed(common.astype(np.uint32)),
        "ids": bundle.ids, "rows": bundle.rows, "train": bundle.train, "lengths": bundle.lengths, "first": bundle.first,
    }
    pairs = pair_hashes(contexts(tokens, lengths, first), tokens)
    del tokens, place, rank, common
    every, both = np.unique(pairs), np.sort(pairs[counted])
    del pairs
    found = np.searchsorted(both, every, "right") - np.searchsorted(both, every, "left")
    edges = np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)
    for part, hashes, counts in ((WORDS, words, own), (PAIRS, every, found)):
        cuts = np.r_[0, np.searchsorted(hashes, edges), len(hashes)]
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            low, high = cuts[shard], cuts[shard + 1]
            yield {"bundle": number, "shard": shard, "part": part, "a": packed_sorted(hashes[low:high]), "b": packed(counts[low:high].astype(np.uint64))}


def answered(table: pa.Table) -> Iterator[dict]:
    """A shard's answers: for each row of hashes their counts in all training text, with the hashes where they are words'."""
    kinds = np.array(table.column("part").to_pylist())
    rows = table.select(["bundle", "shard", "part"]).to_pylist()
    for part in (WORDS, PAIRS):
        at = np.flatnonzero(kinds == part)
        if not len(at):
            continue
        lists = [unpacked_sorted(table.column("a")[i].as_py()) for i in at.tolist()]
        own = np.concatenate([unpacked(table.column("b")[i].as_py()) for i in at.tolist()]).astype(np.int64)
        hashes, place = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.zeros(len(hashes), np.int64)
        np.add.at(total, place, own)
        ends = np.cumsum([len(x) for x in lists])
        for i, x, end in zip(at.tolist(), lists, ends.tolist()):
            same = {"b": table.column("a")[i].as_py()} if part == WORDS else {}
            yield {**rows[i], "a": packed(total[place[end - len(x) : end]].astype(np.uint64)), **same}
        if part == WORDS:
            real = total[hashes != START]
            yield {"bundle": -1, "shard": rows[at[0]]["shard"], "part": WORDS, "types": int((real > 0).sum()), "total": int(real.sum())}


# --- counts by token ---------------------------------------------------------------------------


@dataclass
class Counts:
    """What the tokens of a bundle need: counts in training text of the token, its context and the pair."""

    lengths: np.ndarray
    token: np.ndarray
    context: np.ndarray
    pair: np.ndarray
    rank: np.ndarray  # of the token in the bundle's vocabulary
    pair_place: np.ndarray  # of the pair among the bundle's
    starts: np.ndarray  # whether a part begins its document


def pair_codes(rank: np.ndarray, lengths: np.ndarray, before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each token's context, and the two ranks as one number."""
    context = contexts(rank, lengths, before)
    return context, context * size + rank


def counts_of(row: dict) -> Counts:
    lengths, rank = np.array(row["lengths"], np.int64), unpacked(row["a"], np.uint32).astype(np.int64)
    by_word, by_pair = (unpacked(row[c]).astype(np.int64) for c in ("words", "pairs"))
    context, codes = pair_codes(rank, lengths, np.array(row["before"], np.int64), len(by_word))
    place = np.unique(codes, return_inverse=True)[1]
    return Counts(lengths, by_word[rank], by_word[context], by_pair[place], rank, place, np.array(row["starts"], bool))


def by_rank(row: dict, words: np.ndarray, word_counts: np.ndarray, pair_counts: np.ndarray) -> dict:
    """A bundle's row of tokens with the answers in the order of its own ranks and pairs of ranks, so that hashes are needed no more."""
    common = unpacked(row["b"], np.uint32).astype(np.int64)
    ranks = np.empty_like(common)
    ranks[common] = np.arange(len(common))
    first = np.array(row["first"], np.int64).astype(np.uint64)
    before, lengths = ranks[np.searchsorted(words, first)], np.array(row["lengths"], np.int64)
    rank = unpacked(row["a"], np.uint32).astype(np.int64)
    context, codes = pair_codes(rank, lengths, before, len(words))
    hashes = words[common]
    pairs = pair_hashes(hashes[context], hashes[rank])
    at = np.unique(codes, return_index=True)[1]
    own = np.searchsorted(np.unique(pairs), pairs[at])
    kept = {c: row[c] for c in ("a", "ids", "rows", "train", "lengths")}
    return kept | {"before": before.tolist(), "starts": (first == START).tolist(), "words": packed(word_counts[common]), "pairs": packed(pair_counts[own])}


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context that never occurs, else one more than its binary logarithm."""
    return np.frexp(context.astype(float))[1] * (context > 0)


def cells(counts: Counts, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The events of training documents, each with its own document's counts deleted: cell and number of events."""
    owner = np.repeat(np.arange(len(counts.lengths)), counts.lengths)
    event = np.repeat(train, counts.lengths)

    def own(place: np.ndarray) -> np.ndarray:
        """How often the token's document holds it."""
        _, at, many = np.unique(owner * (int(place.max(initial=0)) + 1) + place, return_inverse=True, return_counts=True)
        return many[at]

    of_token = own(counts.rank)
    token = (counts.token - of_token)[event]
    context = (counts.context - contexts(of_token, counts.lengths, counts.starts.astype(np.int64)))[event]
    pair = (counts.pair - own(counts.pair_place))[event]
    step = lambda x: np.rint(STEPS * np.log2(x)).astype(np.int64) + 1
    by_pair, by_token = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
    by_pair[pair > 0] = step(context[pair > 0] / pair[pair > 0])
    by_token[token > 0] = step(token[token > 0])
    return np.unique((bucket(context) << 16) + (by_pair << 8) + by_token, return_counts=True)


def gathered(table: pa.Table) -> Iterator[dict]:
    """A bundle's tokens with the answers for it, and its events by cell; for the bundle -1, the totals of all training text."""
    rows = table.select(["bundle", "shard", "part", "types", "total"]).to_pylist()
    if rows[0]["bundle"] < 0:
        yield {"types": sum(r["types"] for r in rows), "total": sum(r["total"] for r in rows)}
        return
    order = sorted(range(len(rows)), key=lambda i: (rows[i]["part"], rows[i]["shard"]))
    joined = lambda part, column, read: np.concatenate([read(table.column(column)[i].as_py()) for i in order if rows[i]["part"] == part])
    row = table.slice(order[0], 1).to_pylist()[0]
    row = by_rank(row, joined(WORDS, "b", unpacked_sorted), joined(WORDS, "a", unpacked), joined(PAIRS, "a", unpacked))
    yield row
    at, many = cells(counts_of(row), np.array(row["train"], bool))
    for cell, n in zip(at.tolist(), many.tolist()):
        yield {"cell": cell, "n": n}


# --- weights -------------------------------------------------------------------------------------


@dataclass
class Model:
    types: int  # distinct tokens of the training text
    total: int  # its tokens
    weights: np.ndarray  # of bigram, token and uniform, by bucket


def maximised(cell: np.ndarray, n: np.ndarray, types: int, total: int, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights by bucket from the events of all cells; each part of a mixture has half an event to begin with.

    Buckets without events take the weights of the next lower one that has any.
    """
    of, by_pair, by_token = cell >> 16, (cell >> 8) & 255, cell & 255
    p = np.zeros((len(cell), 3))
    p[by_pair > 0, 0] = 2.0 ** (-(by_pair[by_pair > 0] - 1) / STEPS)
    p[by_token > 0, 1] = 2.0 ** ((by_token[by_token > 0] - 1) / STEPS) / max(1, total)
    p[:, 2] = 1 / (types + 1)
    allowed = np.ones((BUCKETS + 1, 3))
    allowed[0, 0] = 0  # no bigram follows a context that never occurs
    if not total:
        allowed[:, :2] = 0
    weights = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        share = weights[of] * p
        share *= (n / share.sum(axis=1))[:, None]
        new = 0.5 * allowed
        np.add.at(new, of, share)
        new /= new.sum(axis=1, keepdims=True)
        moved, weights = np.abs(new - weights).max(), new
        if moved < 1e-9:
            break
    seen = np.unique(of)
    for b in range(1, BUCKETS + 1):
        if b not in seen and b > 1:
            weights[b] = weights[b - 1]
    return weights


def scored(row: dict, model: Model) -> dict:
    """Sums over the tokens of each document or part of the bundle."""
    c, n = counts_of(row), max(1, model.total)
    base = np.log10((c.token + 1) / (model.total + model.types + 1))
    weight = model.weights[bucket(c.context)]
    p = weight[:, 0] * c.pair / np.maximum(1, c.context) + weight[:, 1] * c.token / n + weight[:, 2] / (model.types + 1)
    at = np.cumsum(c.lengths) - c.lengths
    sums = lambda x: np.add.reduceat(x, at)
    return {"row": row["rows"], "doc_id": row["ids"], "trained": row["train"], "n_tokens": c.lengths, "n_known": sums((c.token > 0).astype(np.int64)), "base_score": sums(base), "score": sums(np.log10(p))}


# --- the job -------------------------------------------------------------------------------------


def arrow_rows(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for row in rows:
        yield pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], f.type) for f in schema], schema=schema)


class Corpus:
    """Documents in bundles, with the counts that their tokens need, in the shared scratch folder."""

    def __init__(self, docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", bundle_tokens: int = BUNDLE_TOKENS, shard_bytes: int = SHARD_BYTES):
        self.spark = docs.sparkSession
        trained = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), F.coalesce(usable, F.lit(False)).alias("train"))
        texts(docs, id_col, text_col)  # bounds the batches
        self.key = trained.schema["doc_id"].dataType.simpleString()
        size = docs.agg(F.sum(F.octet_length(docs[text_col]))).first()[0] or 0
        shards = max(1, -(-size // shard_bytes))
        lists = f"ids array<{self.key}>, rows array<long>, train array<boolean>, lengths array<long>"
        asks = f"bundle long, shard int, part int, a binary, b binary, {lists}, first array<long>, types long, total long"
        final = f"a binary, {lists}, before array<long>, starts array<boolean>, words binary, pairs binary, types long, total long, cell long, n long"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, number, row, hashes, schema, bundle = TaskContext.get().partitionId(), 0, 0, WordHashes(), None, Bundle()
            end = np.array([END])
            for batch in batches:
                schema = schema or arrow_schema(asks, batch.schema.field("doc_id").type)
                for doc_id, text, train in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "train"))):
                    first, rest = START, list(parts(text))
                    for i, piece in enumerate(rest):
                        words = piece.split()
                        tokens = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                        if i == len(rest) - 1:
                            tokens = np.concatenate([tokens, end])
                        if len(tokens):
                            bundle.add(tokens, first, train, (task << 32) + row, doc_id)
                            first = tokens[-1]
                        if bundle.size >= bundle_tokens:
                            yield from arrow_rows(asked(bundle, (task << 32) + number, shards), schema)
                            bundle, number = Bundle(), number + 1
                    row += 1
            if bundle.size:
                yield from arrow_rows(asked(bundle, (task << 32) + number, shards), schema)

        def answer(table: pa.Table) -> pa.Table:
            kept = table.filter(pc.equal(table.column("part"), DOCS))
            return pa.concat_tables([kept, pa.Table.from_batches(arrow_rows(answered(table), table.schema), table.schema)])

        def gather(table: pa.Table) -> pa.Table:
            schema = arrow_schema(final, table.schema.field("ids").type.value_type)
            rows = list(gathered(table))
            return pa.Table.from_pylist(rows, schema=schema)

        folder = scratch_dir(self.spark, "interpolation")
        found = trained.mapInArrow(run, asks).groupBy("shard").applyInArrow(answer, asks).groupBy("bundle").applyInArrow(gather, final)
        found.write.parquet(folder)
        self.rows = self.spark.read.schema(found.schema).parquet(folder)

    def model(self) -> Model:
        """The model of the training text; only the table of cells, of bounded size, reaches the driver."""
        totals = self.rows.filter("total is not null").agg(F.sum("types"), F.sum("total")).first()
        types, total = (int(x or 0) for x in totals)
        table = self.rows.filter("cell is not null").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        return Model(types, total, maximised(table["cell"].to_numpy(), table["n"].to_numpy(), types, total))

    def scores(self, model: Model) -> DataFrame:
        """``doc_id, trained, n_tokens, n_known, base_score, score`` per document."""
        shared = self.spark.sparkContext.broadcast(model)
        columns = f"row long, doc_id {self.key}, trained boolean, n_tokens long, n_known long, base_score double, score double"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                schema = arrow_schema(columns, batch.schema.field("ids").type.value_type)
                for i in range(batch.num_rows):
                    found = scored(batch.slice(i, 1).to_pylist()[0], shared.value)
                    yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in schema], schema=schema)

        by_part = self.rows.filter("rows is not null").select("a", "ids", "rows", "train", "lengths", "before", "starts", "words", "pairs").mapInArrow(run, columns)
        sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
        return by_part.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("trained").alias("trained"), *sums).drop("row")


def arrow_schema(columns: str, key: pa.DataType) -> pa.Schema:
    """The Arrow form of a list of columns; the key's type is given, as it may be any."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    own = {"ids": pa.list_(key), "doc_id": key}
    return pa.schema([(name, own.get(name) or kinds[kind]) for name, kind in (c.split(" ", 1) for c in columns.split(", "))])


def score_documents(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", bundle_tokens: int = BUNDLE_TOKENS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, trained, n_tokens, n_known, train_tokens, base_score, score`` per document; the model learns from the ``usable`` rows.

    ``score`` is the log10 probability of the text by the mixture, ``base_score`` that by single tokens with one added to each count.
    """
    corpus = Corpus(docs, usable, id_col, text_col, bundle_tokens, shard_bytes)
    model = corpus.model()
    return corpus.scores(model).withColumn("train_tokens", F.lit(model.total).cast("long"))
