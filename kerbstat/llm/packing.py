"""Token ids packed into rows of fixed length: best fit decreasing over a segment tree of free capacities.

Each task packs what it reads, a window of tokens at a time, so nothing is shuffled and memory is bounded.
A document longer than a row is cut into whole rows and a rest; no token is lost, and ``unpack`` gives the documents
back. A packed row holds a row of the id matrix (little-endian, 16 bits where the vocabulary allows), its cumulative segment lengths
and the positions at which position ids start again from 0, which is where segments start.

Null and empty texts have a segment of length 0. Repeated rows are packed like others; segments carry the id and the
place of their first token in the document. Rows are numbered per task in reading order.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstat.llm.common import column, texts

LENGTH = 2048
WINDOW = 2_000_000  # tokens packed at a time


class Capacities:
    """Open rows by free capacity 0..length; the tree's leaves count rows, inner nodes sum them."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._add(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least capacity of at least ``need``, with that capacity; it is taken out."""
        at = need + self.leaves
        if not self.count[at]:
            while at > 1 and not (at % 2 == 0 and self.count[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        free = at - self.leaves
        self._add(free, -1)
        return free, self.rows[free].pop()

    def _add(self, free: int, by: int) -> None:
        at = free + self.leaves
        while at:
            self.count[at] += by
            at //= 2


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Which pieces go into which row; every size is at most ``length``."""
    open_rows, rows = Capacities(length), []
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = open_rows.take(sizes[piece])
        free, row = found if found else (length, len(rows))
        if not found:
            rows.append([])
        rows[row].append(piece)
        open_rows.put(free - sizes[piece], row)
    return rows


def tokenizer(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def pack(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """``task, pack, n_tokens, doc_ids, doc_offsets, cu_seqlens, resets, ids`` per packed row.

    ``ranks`` is a vocabulary in rank format, of fixed size, and is broadcast.
    """
    source = texts(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    kind = "<u2" if ranks.count(b"\n") <= 1 << 16 else "<u4"

    def rows_of(keys: list, ids: list[np.ndarray], first: int) -> list[tuple]:
        owner, offset, size = [], [], []
        for i, tokens in enumerate(ids):
            for at in range(0, max(1, len(tokens)), length):
                owner.append(i)
                offset.append(at)
                size.append(min(length, len(tokens) - at))
        rows = []
        for number, pieces in enumerate(best_fit_decreasing(size, length)):
            ends = np.cumsum([0, *(size[p] for p in pieces)]).astype(np.int32)
            body = b"".join(ids[owner[p]][offset[p] : offset[p] + size[p]].tobytes() for p in pieces)
            rows.append((first + number, int(ends[-1]), [keys[owner[p]] for p in pieces], [offset[p] for p in pieces], ends, ends[:-1], body))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(*shared.value).encode_ordinary
        keys, ids, held, first = [], [], 0, 0
        task = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            out = list(zip(*((task, *row) for row in rows_of(keys, ids, first))))
            whole = pa.list_(pa.int32())
            types = [pa.int32(), pa.int64(), pa.int32(), pa.list_(key_type), whole, whole, whole, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(out, types)], names=schema.names)

        for batch in batches:
            key_type = column(batch, "doc_id").type
            for key, text in zip(column(batch, "doc_id").to_pylist(), column(batch, "text").to_pylist()):
                tokens = np.array(encode(text) if text else [], kind)
                keys.append(key)
                ids.append(tokens)
                held += len(tokens) + 8
                if held >= window:
                    out = flush()
                    first += out.num_rows
                    keys, ids, held = [], [], 0
                    yield out
        if keys:
            yield flush()

    whole = T.ArrayType(T.IntegerType())
    schema = T.StructType().add("task", "integer").add("pack", "long").add("n_tokens", "integer")
    schema = schema.add("doc_ids", T.ArrayType(source.schema["doc_id"].dataType)).add("doc_offsets", whole)
    schema = schema.add("cu_seqlens", whole).add("resets", whole).add("ids", "binary")
    return source.mapInArrow(run, schema)


def unpack(packed: DataFrame, wide: bool = False) -> DataFrame:
    """``doc_id, doc_offset, ids`` per segment, ids as array; the segments of a document in order of offset are its tokens."""
    kind = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, offsets, ids = [], [], []
            for r in batch.to_pylist():
                tokens = np.frombuffer(r["ids"], kind).astype(np.int32)
                keys += r["doc_ids"]
                offsets += r["doc_offsets"]
                ids += [tokens[a:b] for a, b in zip(r["cu_seqlens"][:-1], r["cu_seqlens"][1:])]
            types = [column(batch, "doc_ids").type.value_type, pa.int32(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((keys, offsets, ids), types)], names=["doc_id", "doc_offset", "ids"])

    schema = T.StructType().add("doc_id", packed.schema["doc_ids"].dataType.elementType).add("doc_offset", "integer")
    return packed.select("doc_ids", "doc_offsets", "cu_seqlens", "ids").mapInArrow(run, schema.add("ids", T.ArrayType(T.IntegerType())))


def position_ids(packed: DataFrame) -> DataFrame:
    """The position id of every token of every packed row: 0, 1, ... from each reset on."""
    runs = F.zip_with(
        F.slice("cu_seqlens", 1, F.size("cu_seqlens") - 1), F.slice("cu_seqlens", 2, F.size("cu_seqlens") - 1), lambda a, b: b - a
    )
    counted = F.transform(F.filter(runs, lambda n: n > 0), lambda n: F.sequence(F.lit(0), n - 1))
    return packed.select("task", "pack", F.flatten(counted).alias("position_ids"))
