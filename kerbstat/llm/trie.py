"""The prefix trie of conversations, by range minima over sorted common prefixes.

A conversation is its sequence of turns, each a 128-bit digest of role and text. Conversations are sorted by their sequences
(then by id) over range partitions, and cut into chunks of bounded size. In a chunk, neighbours' longest common prefixes (LCPs)
lie in a sparse table of minima. Every distinct prefix is a candidate; it binary-searches its left and its right extent in the table,
each by itself, and so finds the interval of its members; its parent is the interval that the prefix one turn shorter finds. Counts
over subtrees are differences of running sums, as the nodes stand in preorder; a second sparse table gives smallest ids.

Intervals that touch a chunk's edge may go on in the next chunk. They are prefixes of its first or last conversation,
so there are few; they are merged by the digest of their prefix, and their subtrees' sums go up to all ancestors in as many rounds as the
depth has binary digits. Ids of members that end at such a node come as texts of bounded size and are hashed one after the other,
as SHA-256 needs; no list of members is ever held.

Null roles and texts count as empty, null turns come first, and equal turn numbers are ordered by digest. Rows that repeat are turns each. Rows with a null conversation
belong to none and are left out. An empty table has no nodes. What a task holds of a conversation is 20 bytes a turn, whatever its texts' length.
Columns are taken by name up front, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstat.session import scratch_dir

WIDTH = 16  # bytes of a turn's digest
CHUNK_ROWS, CHUNK_TURNS = 1 << 16, 1 << 20  # of conversations and of turns looked at together
PIECE = 4_096  # ids in a text of members
EMPTY = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"
NODES = "kind string, chunk long, depth long, name string, parent_name string, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, seq long, ids string, ends_sha256 string"


# --- conversations as sequences ------------------------------------------------------------


def turn_arrays(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id, turns``: digest and number of words of each turn, in order."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = turns.filter(turns[conv_col].isNotNull()).select(
        turns[conv_col].cast("long").alias("conv_id"),
        F.struct(turns[turn_col].alias("turn"), F.substring(digest, 1, 2 * WIDTH).alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("words")).alias("row"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))


def rebuilt(
    turns: DataFrame, every: int = 20, most: int = 4, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, turns`` of every conversation c with its first h turns replaced by those of conversation ``c - c % every``,
    where h is the CRC-32 of c in decimals modulo ``most``. Where that one has fewer, all of them come; where there is none, none.
    """
    own = turn_arrays(turns, conv_col, turn_col, role_col, text_col)
    first = turn_arrays(turns.filter(turns[conv_col] % every == 0), conv_col, turn_col, role_col, text_col)
    first = first.select(F.col("conv_id").alias("_from"), F.slice("turns", 1, most - 1).alias("_first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    both = own.join(first, F.col("conv_id") - F.col("conv_id") % every == F.col("_from"), "left").withColumn("_h", h)
    borrowed = F.expr("slice(coalesce(_first, slice(turns, 1, 0)), 1, _h)")
    return both.select("conv_id", F.concat(borrowed, F.expr("slice(turns, _h + 1, size(turns))")).alias("turns"))


# --- one chunk -------------------------------------------------------------------------------


def minima(values: np.ndarray) -> list[np.ndarray]:
    """The sparse table: level k holds the least of every 2^k neighbouring values."""
    table = [values]
    while len(table[-1]) > 1 << (len(table) - 1):
        step = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
    return table


def least(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least value from ``low`` to ``high``, both included."""
    level = np.frexp((high - low + 1).astype(float))[1] - 1
    out = np.empty(len(low), np.int64)
    for k in np.unique(level):
        of = level == k
        out[of] = np.minimum(table[k][low[of]], table[k][high[of] - (1 << int(k)) + 1])
    return out


def leftmost(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first row whose LCPs up to row ``at`` are all ``depth`` or more."""
    low = at.copy()
    for k in range(len(table) - 1, -1, -1):
        to = low - (1 << k)
        ok = to >= 0
        ok[ok] = table[k][to[ok]] >= depth[ok]
        low[ok] = to[ok]
    return low


def rightmost(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last row whose LCPs from row ``at`` on are all ``depth`` or more."""
    high, size = at.copy(), len(table[0])
    for k in range(len(table) - 1, -1, -1):
        ok = high + (1 << k) <= size
        ok[ok] = table[k][high[ok]] >= depth[ok]
        high[ok] += 1 << k
    return high


def within(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of so many elements: the group of each, and its place in it."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def common_prefixes(flat: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The LCP of each row and the next; ``flat`` holds the turns of all rows, two words each."""
    begin = np.cumsum(length) - length
    shorter = np.minimum(length[:-1], length[1:])
    pair, at = within(shorter)
    differ = np.flatnonzero((flat[begin[pair] + at] != flat[begin[pair + 1] + at]).any(axis=1))
    lcp = shorter.copy()
    where, first = np.unique(pair[differ], return_index=True)
    lcp[where] = at[differ[first]]
    return lcp


def chain(key: bytes) -> list[str]:
    """A name for every prefix of a sequence, the empty one first."""
    state, names = hashlib.sha256(), []
    for at in range(0, len(key) + 1, WIDTH):
        names.append(state.copy().hexdigest())
        state.update(key[at : at + WIDTH])
    return names


def chunk_nodes(chunk: int, ids: np.ndarray, keys: list[bytes], words: np.ndarray) -> dict[str, dict]:
    """The nodes of sorted conversations, by kind: ``whole`` intervals, those at an ``edge``, and the ``ends`` of the latter.

    ``words`` are those of all turns, one conversation after the other.
    """
    length = np.array([len(k) // WIDTH for k in keys], np.int64)
    begin = np.cumsum(length) - length
    lcp = common_prefixes(np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2), length)
    table, smallest = minima(lcp), minima(ids)
    before = np.r_[-1, lcp]  # LCP with the row before
    # Candidates in preorder: what a row does not share with the row before it.
    row, step = within(length - before)
    depth = before[row] + 1 + step
    start = np.r_[0, np.cumsum(length - before)]
    low, high = leftmost(table, row, depth), rightmost(table, row, depth)
    up = leftmost(table, row, depth - 1)
    parent = np.where(depth > 0, start[up] + depth - 2 - before[up], -1)
    members, conv = high - low + 1, least(smallest, low, high)
    last = np.zeros(len(row), np.int64)
    last[depth > 0] = words[(begin[low] + depth - 1)[depth > 0]]

    edge = (low == 0) | (high == len(ids) - 1)
    whole = ~edge
    children = np.bincount(parent[whole & (parent >= 0)], minlength=len(row))
    after = start[high + 1]  # the node behind the subtree
    runs = lambda own: np.r_[0, np.cumsum(np.where(whole, own, 0))]
    leaves, saved = runs(children == 0), runs((members - 1) * last)
    below = lambda sums: sums[after] - sums[np.arange(len(row))]

    def under(sums: np.ndarray) -> np.ndarray:
        """Sums over the whole subtrees right below each node."""
        out, top = np.zeros(len(row), np.int64), np.flatnonzero(whole & (parent >= 0))
        np.add.at(out, parent[top], below(sums)[top])
        return out

    # Equal sequences stand together, by id; the first is the candidate.
    fresh = np.flatnonzero(length > before)
    run = np.zeros(len(ids), np.int64)
    run[fresh] = np.diff(np.r_[fresh, len(ids)])
    ends = np.where(depth == length[low], run[low], 0)
    text = lambda a, b: ",".join(map(str, ids[a:b].tolist()))
    first, final = chain(keys[0]), chain(keys[-1])
    name = lambda node: (first if low[node] == 0 else final)[depth[node]]

    at = np.flatnonzero(whole)
    mother = parent[at]
    hidden = edge[mother]
    out = {
        "whole": {
            "chunk": np.full(len(at), chunk),
            "depth": depth[at],
            "parent_name": [name(p) if h else None for p, h in zip(mother.tolist(), hidden.tolist())],
            "conv_id": conv[at],
            "parent_conv_id": [None if h else c for c, h in zip(conv[mother].tolist(), hidden.tolist())],
            "n_convs": members[at],
            "n_children": children[at],
            "n_leaves": below(leaves)[at],
            "saved_tokens": below(saved)[at],
            "ends_sha256": [hashlib.sha256(text(a, a + n).encode()).hexdigest() if n else EMPTY for a, n in zip(low[at].tolist(), ends[at].tolist())],
        }
    }
    at = np.flatnonzero(edge)
    out["edge"] = {
        "chunk": np.full(len(at), chunk),
        "depth": depth[at],
        "name": [name(i) for i in at],
        "parent_name": [(first if low[i] == 0 else final)[depth[i] - 1] if depth[i] else None for i in at],
        "conv_id": conv[at],
        "n_convs": members[at],
        "n_children": children[at],
        "n_leaves": under(leaves)[at],
        "saved_tokens": under(saved)[at],
        "words": last[at],
    }
    at = at[ends[at] > 0]
    pieces = [(name(i), seq, text(a, min(a + PIECE, low[i] + ends[i]))) for i in at for seq, a in enumerate(range(low[i], low[i] + ends[i], PIECE))]
    out["ends"] = {"chunk": np.full(len(pieces), chunk), "name": [p[0] for p in pieces], "seq": [p[1] for p in pieces], "ids": [p[2] for p in pieces]}
    return out


# --- all chunks -------------------------------------------------------------------------------


def in_chunks(chunk_rows: int, chunk_turns: int):
    """The function for Arrow batches of sorted ``conv_id, key, words``: a bounded number of conversations at a time."""
    types = {"long": pa.int64(), "string": pa.string()}
    columns = {n: types[t] for n, t in (c.split() for c in NODES.split(", "))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, keys, words, turns = [], [], [], 0

        def nodes() -> Iterator[pa.RecordBatch]:
            flat = np.concatenate([np.zeros(0, np.int64), *words])
            for kind, rows in chunk_nodes((task << 32) + number, np.array(ids, np.int64), keys, flat).items():
                size = len(rows["chunk"])
                rows["kind"] = [kind] * size
                yield pa.RecordBatch.from_arrays([pa.array(rows[n], t) if n in rows else pa.nulls(size, t) for n, t in columns.items()], names=list(columns))

        for batch in batches:
            for i, key, counts in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "words"))):
                ids.append(i)
                keys.append(key)
                words.append(np.array(counts, np.int64))
                turns += len(counts)
                if len(ids) >= chunk_rows or turns >= chunk_turns:
                    yield from nodes()
                    ids, keys, words, turns, number = [], [], [], 0, number + 1
        if ids:
            yield from nodes()

    return run


def hashed(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``name, ends_sha256`` of sorted ``name, ids``: texts with one name are hashed as one, joined by commas."""
    now, state = None, None
    one = lambda: pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["_name", "ends_sha256"])
    for batch in pieces:
        for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
            if name != now:
                if now is not None:
                    yield one()
                now, state = name, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if now is not None:
        yield one()


class Trie:
    """The steps share the scratch folder; each one's rows are written there."""

    def __init__(self, conversations: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_turns: int = CHUNK_TURNS):
        self.spark, self.folder = conversations.sparkSession, scratch_dir(conversations.sparkSession, "trie")
        key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
        rows = conversations.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))
        found = rows.orderBy("key", "conv_id").mapInArrow(in_chunks(chunk_rows, chunk_turns), NODES)
        self.nodes = self.stored(found, "nodes", "kind")

    def stored(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        df.write.partitionBy(*by).parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def edges(self) -> DataFrame:
        """The nodes at the edges of chunks, merged, with sums over all that is below them."""
        parts = self.nodes.filter("kind = 'edge'")
        total = lambda c: F.sum(c).alias(c)
        merged = parts.groupBy("name").agg(
            F.max("depth").alias("depth"), F.max("parent_name").alias("parent_name"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
            total("n_convs"), total("n_children"), total("n_leaves"), total("saved_tokens"),
        )
        merged = self.stored(merged, "merged")
        more = merged.groupBy(F.col("parent_name").alias("_name")).agg(F.count("*").alias("_more"))
        merged = merged.join(more, F.col("name") == F.col("_name"), "left").withColumn("n_children", F.col("n_children") + F.coalesce("_more", F.lit(0))).drop("_name", "_more")
        own = {
            "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"),
        }
        merged = self.stored(merged.withColumns(own).withColumn("up", F.col("parent_name")), "edges-0")
        deepest, reach, number = merged.agg(F.max("depth")).first()[0] or 0, 1, 0
        # A node knows the sums of what is less than ``reach`` below it, and its ancestor that far up.
        while reach <= deepest:
            sums = merged.groupBy(F.col("up").alias("_name")).agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
            above = merged.select(F.col("name").alias("_up"), F.col("up").alias("_next"))
            joined = merged.join(sums, F.col("name") == F.col("_name"), "left").join(above, F.col("up") == F.col("_up"), "left")
            doubled = {
                "n_leaves": F.col("n_leaves") + F.coalesce("_leaves", F.lit(0)),
                "saved_tokens": F.col("saved_tokens") + F.coalesce("_saved", F.lit(0)),
                "up": F.col("_next"),
            }
            reach, number = 2 * reach, number + 1
            merged = self.stored(joined.withColumns(doubled).drop("_name", "_leaves", "_saved", "_up", "_next"), f"edges-{number}")
        return merged

    def result(self) -> DataFrame:
        edges = self.edges()
        names = edges.select(F.col("name").alias("_up"), F.col("conv_id").alias("_up_conv"))
        columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

        pieces = self.nodes.filter("kind = 'ends'").select("name", "chunk", "seq", "ids")
        dealt = pieces.repartition("name").sortWithinPartitions("name", "chunk", "seq").select("name", "ids")
        ends = dealt.mapInArrow(hashed, "_name string, ends_sha256 string")
        top = edges.join(ends, F.col("name") == F.col("_name"), "left").join(names, F.col("parent_name") == F.col("_up"), "left")
        top = top.withColumns({"parent_conv_id": F.col("_up_conv"), "ends_sha256": F.coalesce("ends_sha256", F.lit(EMPTY))}).select(columns)

        # Names by chunk, so that a node that is the parent of many is met in each chunk apart.
        by_chunk = self.nodes.filter("kind = 'edge'").select("chunk", "name").join(names, F.col("name") == F.col("_up"))
        by_chunk = by_chunk.select(F.col("chunk").alias("_chunk"), F.col("name").alias("_name"), "_up_conv")
        same = (F.col("chunk") == F.col("_chunk")) & (F.col("parent_name") == F.col("_name"))
        whole = self.nodes.filter("kind = 'whole'").join(by_chunk, same, "left")
        whole = whole.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up_conv")).select(columns)
        return whole.unionByName(top)


def prefix_trie(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """A row per distinct prefix of ``conv_id, turns``: ``conv_id`` (its smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens`` (words that members share with the first, over the subtree) and ``ends_sha256`` (of the ids that end there).
    """
    return Trie(conversations, chunk_rows, chunk_turns).result()
