"""Exact Jaccard join of documents over word n-grams, by token-combination prefixes.

A document's tokens are the 64-bit hashes of its distinct n-word shingles. Documents with equal sets are one node.
Tokens are ordered: rare ones first, frequent ones last, by hash in each class. Two nodes that
link share at least ``k`` tokens among their first ``size - least overlap + k``. With k = 2 a linked pair
thus shares a rare token there, or two frequent ones: rare tokens are indexed singly, frequent ones in pairs. Sets of
more than ``PAIRED`` shingles index frequent tokens singly too, and sets whose partners may lie on either side of that size do both.
The class of a token is decided by counts over all documents, of those tokens that occur twice in what a task counts together; it only steers the order, so results never depend on it.

Index lists are not expanded into pairs. Lists with the same members count once. In a first round each
member meets its list's smallest node only; verified links are joined into components. A second round looks at lists that still hold
several components: members of different components meet in blocks of bounded size, where an upper bound of the
overlap (counts of tokens by bucket) leaves few pairs to verify. Pairs inside a component need no look:
they are connected already.

Bit filters of fixed size spare steps most rows; what they let through by mistake is sorted out after them.
Empty and null texts have no set and link with nothing. Repeated rows get equal results. Null ids are kept and never name a component unless all of its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstat.llm.common import column, texts
from kerbstat.llm.components import components
from kerbstat.session import scratch_dir

PAIRED = 128  # shingles up to which frequent tokens are indexed in pairs
FREQUENT = 32  # documents from which on a token is frequent
FREQUENT_TOKENS = 4_000_000  # at most so many
COUNTED = 1_000_000  # tokens counted together in a task
BITS = 1 << 26  # of a filter
BUCKETS = 1024
BLOCK = 4096  # members of a block; two of them, 1 KB a member, are what a task holds
FIRST_LISTS = 64  # lists of a member that tell whether two meet elsewhere
REMEMBERED = 100_000
ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingles:
    """Sorted distinct hashes of a text's n-word shingles; made once per task."""

    def __init__(self, n: int):
        self.n, self.hashes = n, WordHashes()

    def of(self, text: str | None) -> np.ndarray:
        # bytes.lower() changes A-Z only, and bytes.split() cuts at the six ASCII white spaces.
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        w = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(w))
        h = w[: len(w) - n + 1].copy()
        for i in range(1, n):
            h = h * ODD + w[i : len(w) - n + 1 + i]
        return np.unique(mixed(h + np.uint64(n)))


def node_of(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes())).astype(np.int64))


def least_overlap(size: int, percent: int) -> int:
    return -(-percent * size // 100)


def check_percent(percent: int) -> None:
    if not 50 < percent <= 100:
        raise ValueError("percent must lie above 50 and be 100 at most")


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The index entries of a set: single rare tokens and pairs of frequent ones from its extended prefix."""
    size = len(tokens)
    if size == 1:
        return tokens
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        is_frequent = frequent[at] == tokens
    else:
        is_frequent = np.zeros(size, bool)
    prefix = size - least_overlap(size, percent) + 2
    rare = tokens[~is_frequent][:prefix]
    out = [rare]
    often = tokens[is_frequent][: max(0, prefix - len(rare))]
    if len(often):
        if size * percent <= PAIRED * 100:
            i, j = np.triu_indices(len(often), 1)
            out.append(mixed(often[i] * ODD + often[j]))
        if size * 100 > PAIRED * percent:
            out.append(often)
    return np.concatenate(out)


def bit_filter(keys: DataFrame, key: str) -> np.ndarray:
    """Words of a two-hash filter of ``BITS`` bits over hashed long keys; its size does not depend on the data's."""
    at = F.explode(F.array(F.expr(f"{key} & {BITS - 1}"), F.expr(f"shiftrightunsigned({key}, 32) & {BITS - 1}")))
    words = keys.select(at.alias("at")).groupBy(F.expr("at >> 6").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    rows = words.toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint64)
    return out


def passes(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    keys, mask = keys.astype(np.uint64), np.uint64(BITS - 1)
    hit = lambda at: (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
    return (hit(keys & mask) & hit((keys >> np.uint64(32)) & mask)).astype(bool)


def buckets(tokens: np.ndarray) -> bytes:
    """Tokens by bucket, 255 standing for that or more."""
    counts = np.bincount((tokens >> np.uint64(40)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def most_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An upper bound of the overlap from two rows of counts; full buckets may hold anything."""
    least = np.minimum(a, b)
    return least.sum(axis=1, dtype=np.int64) + (1 << 40) * (least == 255).any(axis=1)


def unpacked(counts: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(counts), np.uint8).reshape(-1, BUCKETS)


class Join:
    """One join; the steps share the documents, the parameters and the scratch folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int):
        check_percent(percent)
        self.spark, self.words, self.percent = docs.sparkSession, words, percent
        self.source = texts(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
        self.folder = scratch_dir(self.spark, "ngram-join")

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Written to the shared scratch folder, so that lost executors cost no more than this step."""
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    # --- nodes and token classes -----------------------------------------------------------

    def survey(self) -> tuple[DataFrame, np.ndarray]:
        """``doc_id, key, node, n, counts`` per document, counts by bucket, and the frequent tokens, sorted."""
        n = self.words
        names = ["doc_id", "key", "node", "n", "counts", "token", "df"]
        types = dict(zip(names[1:], [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingles, held, seen, size, id_type = Shingles(n), [], set(), 0, None

            def rows(many: int, **given: pa.Array) -> pa.RecordBatch:
                kinds = {"doc_id": id_type, **types}
                return pa.RecordBatch.from_arrays([given[c] if c in given else pa.nulls(many, kinds[c]) for c in names], names=names)

            def counted() -> pa.RecordBatch:
                tokens, df = np.unique(np.concatenate(held), return_counts=True)
                often = df > 1
                return rows(int(often.sum()), token=pa.array(tokens[often].astype(np.int64)), df=pa.array(df[often].astype(np.int64)))

            for batch in batches:
                id_type = column(batch, "doc_id").type
                nodes, sizes, spread = [], [], []
                for text in column(batch, "text").to_pylist():
                    tokens = shingles.of(text)
                    sizes.append(len(tokens))
                    nodes.append(node_of(tokens) if len(tokens) else None)
                    spread.append(buckets(tokens) if len(tokens) else None)
                    if len(tokens) and nodes[-1] not in seen:
                        seen.add(nodes[-1])
                        held.append(tokens)
                        size += len(tokens)
                    if size >= COUNTED:
                        yield counted()
                        held, seen, size = [], set(), 0
                ids, own = column(batch, "doc_id"), column(batch, "key")
                yield rows(len(nodes), doc_id=ids, key=own, node=pa.array(nodes, pa.int64()), n=pa.array(sizes, pa.int32()), counts=pa.array(spread, pa.binary()))
            if held:
                yield counted()

        key = self.source.schema["doc_id"].dataType
        schema = T.StructType().add("doc_id", key).add("key", "long").add("node", "long").add("n", "integer").add("counts", "binary").add("token", "long").add("df", "long")
        both = self.stored(self.source.mapInArrow(run, schema), "survey")
        counts = both.filter("token is not null").groupBy("token").agg(F.sum("df").alias("df"))
        total = counts.agg(F.sum("df").alias("s")).first()["s"] or 0
        # Tokens with at least this count are at most FREQUENT_TOKENS many, as all counts add up to the total.
        least = max(FREQUENT, -(-total // FREQUENT_TOKENS))
        frequent = counts.filter(F.col("df") >= least).select("token").toArrow()["token"].to_numpy().astype(np.uint64)
        return both.filter("token is null").select("doc_id", "key", "node", "n", "counts"), np.sort(frequent)

    # --- index -------------------------------------------------------------------------------

    def index(self, frequent: np.ndarray) -> DataFrame:
        """``sig, node, n``: the index entries of every node, copies of it in other tasks included."""
        n, percent = self.words, self.percent
        frequent = self.spark.sparkContext.broadcast(frequent)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shingles, seen = Shingles(n), set()
            for batch in batches:
                sigs, nodes, sizes = [], [], []
                for text in batch["text"]:
                    tokens = shingles.of(text)
                    node = node_of(tokens) if len(tokens) else None
                    if node is None or node in seen:
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(node)
                    sigs.append(signatures(tokens, frequent.value, percent))
                    nodes.append(node)
                    sizes.append(len(tokens))
                if sigs:
                    many = [len(s) for s in sigs]
                    yield pd.DataFrame(
                        {
                            "sig": np.concatenate(sigs).astype(np.int64),
                            "node": np.repeat(np.array(nodes, np.int64), many),
                            "n": np.repeat(np.array(sizes, np.int32), many),
                        }
                    )

        return self.source.select("text").mapInPandas(run, "sig long, node long, n int")

    def members(self, frequent: np.ndarray) -> DataFrame:
        """``list, pivot, members, node, n``: the index lists of at least two nodes, equal lists once."""
        entries = self.stored(self.index(frequent), "entries")
        ends = entries.groupBy("sig").agg(F.min("node").alias("low"), F.max("node").alias("high"))
        let = self.spark.sparkContext.broadcast(bit_filter(ends.filter("low <> high"), "sig"))

        def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch[passes(let.value, batch["sig"].to_numpy(np.int64))]

        rows = self.stored(entries.mapInPandas(shared, entries.schema).distinct(), "index")
        lists = rows.groupBy("sig").agg(
            F.count("*").alias("members"),
            F.min("node").alias("pivot"),
            F.bit_xor(F.xxhash64("node")).alias("x"),
            F.bit_xor(F.xxhash64(F.lit(1), F.col("node"))).alias("y"),
        )
        lists = lists.filter("members > 1").groupBy("members", "pivot", "x", "y").agg(F.min("sig").alias("sig"))
        joined = rows.join(lists.select("sig", "pivot", "members"), "sig")
        return self.stored(joined.select(F.col("sig").alias("list"), "pivot", "members", "node", "n"), "members")

    def node_table(self, wanted: DataFrame) -> DataFrame:
        """``node, n, counts, doc_id`` of the wanted nodes; the smallest id of the documents that share the set."""
        docs = self.docs.filter("node is not null")
        once = docs.groupBy("node").agg(F.min("n").alias("n"), F.min("doc_id").alias("doc_id")).join(wanted, "node", "left_semi")
        counts = docs.select(F.col("node").alias("_node"), F.col("doc_id").alias("_id"), "counts")
        found = once.join(counts, (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_id")))
        return self.stored(found.dropDuplicates(["_node", "_id"]).select("node", "n", "doc_id", "counts"), "nodes")

    # --- verification ------------------------------------------------------------------------

    def sets(self, wanted: DataFrame, name: str) -> DataFrame:
        """``node, tokens`` for the wanted nodes. Texts are read again, but only those of one document
        per node are cut into shingles.
        """
        n = self.words
        chosen = self.nodes.join(wanted, "node", "left_semi").select(F.xxhash64("doc_id").alias("key"))
        let = self.spark.sparkContext.broadcast(bit_filter(chosen, "key"))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shingles, seen = Shingles(n), set()
            for batch in batches:
                rows = []
                for text in batch["text"][passes(let.value, batch["key"].to_numpy(np.int64))]:
                    tokens = shingles.of(text)
                    node = node_of(tokens) if len(tokens) else None
                    if node is not None and node not in seen:
                        seen.add(node)
                        rows.append((node, tokens.tobytes()))
                if rows:
                    yield pd.DataFrame(rows, columns=["node", "tokens"])

        keyed = self.source.select(F.xxhash64("doc_id").alias("key"), "text")
        found = keyed.mapInPandas(run, "node long, tokens binary")
        return self.stored(found.join(wanted, "node", "left_semi").dropDuplicates(["node"]), name)

    def beside(self, pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(table.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
        return pairs

    def likely(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs ``a, b`` that sizes and counts by bucket do not rule out."""
        percent = self.percent

        def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    most = most_common(unpacked(batch["counts_a"]), unpacked(batch["counts_b"]))
                    total = batch["n_a"].to_numpy(np.int64) + batch["n_b"].to_numpy(np.int64)
                    yield batch.loc[100 * most >= percent * (total - most), ["a", "b"]]

        sized = self.beside(pairs, self.nodes, "n").filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        counted = self.beside(sized, self.nodes, "counts")
        return self.stored(counted.mapInPandas(bounded, "a long, b long"), name)

    def linked(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs ``a, b`` that link, by their sets."""
        percent = self.percent
        sets = self.sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), f"{name}-sets")

        def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keep = np.zeros(len(batch), bool)
                for i, (x, y) in enumerate(zip(batch["tokens_a"], batch["tokens_b"])):
                    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = np.intersect1d(a, b, assume_unique=True).size
                    keep[i] = 100 * both >= percent * (len(a) + len(b) - both)
                yield batch.loc[keep, ["a", "b"]]

        return self.stored(self.beside(pairs, sets, "tokens").mapInPandas(exact, "a long, b long"), f"{name}-links")

    # --- rounds ------------------------------------------------------------------------------

    def mixed_pairs(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs of members of one list in different components that sizes and counts do not rule out.

        Members meet in blocks of bounded size. The pivot has met all members before. A pair is left out where the first lists of both
        show that an earlier list holds them too.
        """
        percent = self.percent
        known = members.filter("node <> pivot").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        sides = known.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        rows = self.stored(known.join(sides.filter("low <> high").select("list"), "list", "left_semi"), "mixed")
        first = rows.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("list")), 1, FIRST_LISTS).alias("first"))
        about = self.nodes.select("node", "counts").join(first, "node")
        blocks = F.ceil(F.col("members") / BLOCK).cast("int")
        rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        rows = rows.join(about, "node").select(
            "list", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "component", "counts", "first"
        )
        corner = {m: np.triu_indices(m, 1) for m in range(65)}

        def pairs_of(this: int, between: bool, own, node, n, comp, counts, first) -> list[tuple[int, int]]:
            m = len(node)
            if m <= 64:
                steps = [corner[m]]
            else:
                steps = ((np.full(m - x - 1, x), np.arange(x + 1, m)) for x in range(m - 1))
            out = []
            for x, y in steps:
                may = (comp[y] != comp[x]) & (100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x]))
                if between:
                    may &= own[y] != own[x]
                x, y = x[may], y[may]
                if not len(x):
                    continue
                most = most_common(unpacked(counts[x]), unpacked(counts[y])) if m <= 64 else most_common(counts[x], counts[y])
                near = 100 * most >= percent * (n[x] + n[y] - most)
                for a, b in zip(x[near].tolist(), y[near].tolist()):
                    if not any(c < this for c in first[a] & first[b]):
                        out.append((min(node[a], node[b]), max(node[a], node[b])))
            return out

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            def groups(batch: pd.DataFrame, last: bool) -> tuple[list[tuple[int, int]], pd.DataFrame]:
                keys = batch[["list", "i", "j"]].to_numpy()
                starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
                ends = np.r_[starts[1:], len(batch)] if last else starts[1:]
                own, node, n, comp = (batch[c].to_numpy(np.int64) for c in ("own", "node", "n", "component"))
                counts, first, out = batch["counts"].to_numpy(), batch["first"].to_numpy(), []
                for s, e in zip(starts.tolist(), ends.tolist()):
                    if e - s > 1:
                        held = counts[s:e] if e - s <= 64 else unpacked(counts[s:e])
                        meet = [frozenset(f.tolist()) for f in first[s:e]]
                        out += pairs_of(int(keys[s, 0]), keys[s, 1] != keys[s, 2], own[s:e], node[s:e], n[s:e], comp[s:e], held, meet)
                return out, batch.iloc[starts[-1] :]

            rest = None
            for batch in batches:
                if rest is not None:
                    batch = pd.concat([rest, batch], ignore_index=True)
                if len(batch):
                    out, rest = groups(batch, last=False)
                    yield pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)
            if rest is not None and len(rest):
                yield pd.DataFrame(groups(rest, last=True)[0], columns=["a", "b"], dtype=np.int64)

        dealt = rows.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j")
        return dealt.mapInPandas(run, "a long, b long").distinct()

    def labels(self) -> DataFrame:
        """``node, component`` for all nodes that link."""
        self.docs, frequent = self.survey()
        members = self.members(frequent)
        self.nodes = self.node_table(members.select("node").distinct())
        star = members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        links = self.linked(self.likely(star, "star"), "star")
        first = self.stored(components(links), "first-components")
        rest = self.stored(self.mixed_pairs(members, first), "rest")
        more = self.linked(rest, "rest")  # none of them is linked already: their components differ
        both = first.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(more)
        return self.stored(components(both), "components")

    def run(self) -> DataFrame:
        labels = self.labels()
        nodes = self.docs.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
        nodes = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        lows = nodes.groupBy("component").agg(F.min("low").alias("component_id"))
        named = nodes.join(lows, "component").select("node", "component_id", "component")
        out = self.docs.join(named, "node", "left")
        size, name = F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
        return out.select("doc_id", size, name, "node", "key", "component")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, node`` per document: size of its set, smallest id reachable by links, and its set's hash."""
    return Join(docs, id_col, text_col, words, percent).run().drop("key", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, small: int = 1_000_000) -> DataFrame:
    """The documents, whole, that stay when of each component only the one with the smallest id does.

    A document is its id and its text: where an id comes with several texts, each is judged by itself. Null ids come last; of a component
    without ids the text with the smallest hash stays. Rows that repeat id and text stay once, also where the text is null or empty. What to drop is broadcast while it has at
    most ``small`` rows, else joined.
    """
    found = Join(docs, id_col, text_col, words, percent).run().select("doc_id", "key", "component")
    spark, folder = docs.sparkSession, scratch_dir(docs.sparkSession, "keep-one")
    found.write.parquet(folder)
    found = spark.read.schema(found.schema).parquet(folder)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("key").alias("key"))).alias("first")
    winners = found.filter("component is not null").groupBy(F.col("component").alias("_component")).agg(first)
    judged = found.join(winners, F.col("component") == F.col("_component"), "left")
    wins = F.col("component").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key")))
    names = [F.col("doc_id").alias("_id"), F.col("key").alias("_key")]
    few = lambda rows: F.broadcast(rows) if rows.count() <= small else rows
    same = docs[id_col].eqNullSafe(F.col("_id")) & (F.xxhash64(docs[text_col]) == F.col("_key"))
    kept = docs.join(few(judged.filter(~wins).select(*names).distinct()), same, "left_anti")
    again = judged.filter(wins).groupBy(*names).count().filter("count > 1").select("_id", "_key")
    if not again.limit(1).count():
        return kept
    again = few(again)
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates([id_col, text_col]))
