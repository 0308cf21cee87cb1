"""Benchmark leaks by q-gram counting in diagonal bands and banded alignment.

Text is compared in a normal form: lower case, runs of anything but letters and digits as one blank, UTF-8. Items are cut
into overlapping windows of ``WINDOW`` bytes and of ``SHORT`` bytes every ``STEP`` (a shorter item is one window), so every
passage of ``SHORT + STEP - 1`` bytes (69, some 11 words) holds a whole window, wherever it is cut. A window of m bytes is found
if it occurs with at most e edits, 5 % of m, or with one run of up to ``RUN`` bytes (a quarter of m, if that is less) replaced by
another, such as a word. On both sides of a replaced run at least ``Q`` bytes agree, unless the window's edge there is the item's own.

What many items say is no evidence: q-grams that occur at more than ``COMMON`` places of the benchmark's distinct texts count for nothing. A window
with d others needs ``LEAST`` of them (or all that it could have); it then shares at least ``d - Q * e`` or ``d + 1 - Q - run`` of them with the text, on
diagonals less than ``WIDE`` apart, and its budget shrinks until that is ``LEAST`` or more. So a place of a text meets at most ``COMMON`` places
of the benchmark. An item in which no window has that evidence, since many items say all of it, is found where the whole of it stands, as it is:
by a hash of every piece of its length that begins with its first q-gram, then its bytes. Shared q-grams are counted per item, then per window, and overlapping band of diagonals;
bands that reach that number are kept, and their regions are aligned with the windows, many at a time.

The benchmark reaches the tasks in blocks of ``BLOCK_BYTES``, some 40 bytes of index a byte (80 MB), each held against all texts. Null and empty texts and items match
nothing; items shorter than ``Q`` bytes in normal form are too short to tell and match nothing. Long texts are looked at in overlapping parts. Repeated rows are reported each, and so are items
of equal text; items of equal id count as one. Columns are taken by name up front, so others may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstat.llm.common import column, in_parts, small_batches, texts
from kerbstat.session import scratch_dir

Q = 12
WINDOW, STRIDE = 100, 50
SHORT, STEP = 60, 10
EDITS = 0.05
RUN, RUN_LEAST = 15, 40  # bytes of a replaced run; of a window in which one may be replaced
WIDE = RUN + 1
COMMON = 16  # places of a q-gram that is still evidence
LEAST = 8  # q-grams of evidence
BLOCK_BYTES = 2_000_000  # of benchmark text in a block
PART = 250_000  # characters of documents looked at together
ENTRIES, ALIGNED = 200_000, 400  # shared q-grams, and windows, looked at together
MIX = np.uint64(0x9E3779B97F4A7C15)
ODD = 0x100000001B3 ** 3 % (1 << 64)
NEVER = np.iinfo(np.int64).max  # q-grams that no band has
OTHER = re.compile(r"[\W_]+")


def normal(text: str | None) -> bytes:
    return OTHER.sub(" ", (text or "").lower()).strip().encode("utf-8", "surrogatepass")


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the Q bytes from each position on: doubled from 1 to 8, then 8 and 4 joined."""
    base = np.uint64(0x100000001B3)
    if len(raw) < Q:
        return np.zeros(0, np.uint64)
    h = raw.astype(np.uint64) + np.uint64(1)
    power, width, four = base, 1, None
    while width < 8:
        h = h[:-width] * power + h[width:]
        power, width = np.uint64(int(power) ** 2 % (1 << 64)), 2 * width
        if width == 4:
            four, four_power = h, power
    h = h[: len(raw) - Q + 1] * four_power + four[8 : 8 + len(raw) - Q + 1]
    return (h ^ (h >> np.uint64(31))) * MIX


def piece_hashes(raw: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on, the same wherever they stand."""
    power, back = (np.cumprod(np.r_[np.uint64(1), np.full(len(raw), x, np.uint64)]) for x in (ODD, pow(ODD, -1, 1 << 64)))
    sums = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:-1])]
    return (sums[at + size] - sums[at]) * back[at]


def band_edits(windows: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Least edits that turn each row's window into a piece of its region, whose extra length is the band."""
    width = regions.shape[1] - windows.shape[1] + 1
    steps = np.arange(width, dtype=np.int16)
    row = np.zeros((len(windows), width), np.int16)
    for i in range(windows.shape[1]):
        new = row + (regions[:, i : i + width] != windows[:, i : i + 1])
        np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    return row.min(axis=1)


def run_replaced(windows: np.ndarray, regions: np.ndarray, runs: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether each region holds its window with one run of up to ``runs`` bytes replaced; lengths differ by that at most.

    ``left`` and ``right`` are the bytes that must agree before and behind the run.
    """
    size = windows.shape[1]
    same = np.lib.stride_tricks.sliding_window_view(regions, size, axis=1) == windows[:, None, :]
    head = np.minimum.accumulate(same, axis=2).sum(axis=2, dtype=np.int16)  # bytes that agree from the start, by diagonal
    tail = np.minimum.accumulate(same[:, :, ::-1], axis=2).sum(axis=2, dtype=np.int16)
    head = np.where(head >= left[:, None], head, -size)
    tail = np.where(tail >= right[:, None], tail, -size)
    shift = np.arange(same.shape[1], dtype=np.int16) - np.arange(same.shape[1], dtype=np.int16)[:, None]
    lost = np.maximum(size - head[:, :, None] - tail[:, None, :], np.maximum(-shift, 0))
    return ((lost <= runs[:, None, None]) & (abs(shift) <= runs[:, None, None])).any(axis=(1, 2)) & (runs > 0)


@dataclass
class Index:
    items: np.ndarray  # name of each item
    text: np.ndarray  # bytes of all items, one after the other
    owner: np.ndarray  # item of each window
    begin: np.ndarray  # of each window in the text
    start: np.ndarray  # of each window in its item
    size: np.ndarray
    edits: np.ndarray
    runs: np.ndarray
    needed: np.ndarray
    edges: np.ndarray  # whether each window's left and right edge are its item's
    order: np.ndarray  # number of each window's item and its start, as one sorted number
    least: np.ndarray  # of each item's windows, the smallest number needed
    keys: np.ndarray  # sorted hashes of the items' q-grams
    of: np.ndarray  # item of each key
    at: np.ndarray  # place of each key in its item
    seen: np.ndarray  # flags by the hash's low bits
    whole: dict[int, list[np.ndarray]]  # by size, whole items as windows: sorted hashes, their windows, and all first q-grams


def cuts(n: int) -> list[tuple[int, int]]:
    """Start and size of the windows of an item of n bytes."""
    found = set()
    for size, stride in ((WINDOW, STRIDE), (SHORT, STEP)):
        last = max(0, n - size)
        found |= {(s, min(size, n)) for s in (*range(0, last + 1, stride), last)}
    return sorted(found)


def common_grams(raws: set[bytes]) -> np.ndarray:
    """The sorted hashes of q-grams that occur at more than ``COMMON`` places."""
    hashes = [gram_hashes(np.frombuffer(raw, np.uint8)) for raw in raws]
    found, many = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]), return_counts=True)
    return found[many > COMMON]


def build(items: list[tuple[object, str | None]], common: np.ndarray | None = None) -> Index:
    """Index the q-grams and windows of ``(item_id, text)``; ``common`` are the q-grams that are no evidence, by default the items' own."""
    kept = [(name, raw) for name, text in items if len(raw := normal(text)) >= Q]
    if common is None:
        common = common_grams({raw for _, raw in kept})
    names, hashes, windows, offset = [], [], [], 0
    for k, (name, raw) in enumerate(kept):
        names.append(name)
        found = gram_hashes(np.frombuffer(raw, np.uint8))
        telling = ~np.isin(found, common)
        sums = np.r_[0, np.cumsum(telling)]
        for s, size in cuts(len(raw)):
            windows.append((k, offset + s, s, size, int(sums[s + size - Q + 1] - sums[s]), s == 0, s + size == len(raw)))
        hashes.append((found[telling], np.flatnonzero(telling)))
        offset += len(raw)
    owner, begin, start, size, telling, first, last = np.array(windows, np.int64).reshape(-1, 7).T
    least = np.minimum(LEAST, size - Q + 1)
    edits = np.minimum((size * EDITS).astype(np.int64), (telling - least) // Q)
    runs = np.where(size < RUN_LEAST, 0, np.minimum(RUN, size // 4))
    runs = np.where(telling - (runs + Q - 1) < least, 0, runs)
    needed = telling - Q * np.maximum(edits, 0)
    needed = np.where(runs > 0, np.minimum(needed, telling - (runs + Q - 1)), needed)
    fit = telling >= least
    edges = np.stack([first, last], axis=1)[fit].astype(bool)
    # Items without any such window become one window each, which bands never reach.
    lone = np.setdiff1d(np.arange(len(kept)), owner[fit])
    long = np.array([len(raw) for _, raw in kept], np.int64)
    zero = np.zeros(len(lone), np.int64)
    more = (lone, (np.cumsum(long) - long)[lone], zero, long[lone], zero, zero, np.full(len(lone), NEVER))
    columns = [np.r_[x[fit], y] for x, y in zip((owner, begin, start, size, edits, runs, needed), more)]
    sort = np.lexsort((columns[2], columns[0]))
    owner, begin, start, size, edits, runs, needed = (x[sort] for x in columns)
    edges = np.r_[edges, np.ones((len(lone), 2), bool)][sort]
    by_item = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(by_item, owner, needed)
    keys = np.concatenate([*(h for h, _ in hashes), np.zeros(0, np.uint64)])
    of = np.repeat(np.arange(len(hashes), dtype=np.int32), [len(h) for h, _ in hashes])
    at = np.concatenate([*(a for _, a in hashes), np.zeros(0, np.int64)]).astype(np.int32)
    order = np.argsort(keys, kind="stable")
    seen = np.zeros(1 << max(16, int(np.ceil(np.log2(16 * max(1, len(keys)))))), bool)
    seen[(keys & np.uint64(len(seen) - 1)).astype(np.int64)] = True
    text = np.frombuffer(b"".join(raw for _, raw in kept), np.uint8)
    whole = {}
    for m in set(long[lone].tolist()):
        windows = np.flatnonzero((needed == NEVER) & (size == m))
        bytes_of = [text[b : b + m] for b in begin[windows]]
        found = np.concatenate([piece_hashes(x, np.zeros(1, np.int64), m) for x in bytes_of])
        whole[m] = [np.sort(found), windows[np.argsort(found, kind="stable")], np.unique(np.concatenate([gram_hashes(x[:Q]) for x in bytes_of]))]
    return Index(np.array(names, object), text, owner, begin, start, size, edits, runs, needed, edges, (owner << 32) + start, by_item, keys[order], of[order], at[order], seen, whole)


def spread(low: np.ndarray, many: np.ndarray) -> np.ndarray:
    """``low, low + 1, ...``, as many of each."""
    return np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]).astype(np.int64), many) + np.arange(many.sum())


def bands(index: Index, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows and bands in which they share as many q-grams with the text as they need."""
    hashes = gram_hashes(raw)
    place = np.flatnonzero(index.seen[(hashes & np.uint64(len(index.seen) - 1)).astype(np.int64)])
    low = np.searchsorted(index.keys, hashes[place], "left")
    many = np.searchsorted(index.keys, hashes[place], "right") - low
    place, low, many = place[many > 0], low[many > 0], many[many > 0]
    if not len(place):
        return
    key = spread(low, many)
    middle = np.int64(1 << 31)  # a diagonal may begin before the text
    code = (index.of[key].astype(np.int64) << 32) + (np.repeat(place, many) - index.at[key]) // WIDE + middle
    order = np.argsort(code, kind="stable")
    code, at = code[order], index.at[key[order]].astype(np.int64)
    # Bands are 2 * WIDE wide and WIDE apart, so that each is two neighbouring cells; its q-grams stand together.
    cell, first = np.unique(code, return_index=True)
    ends = np.r_[first[1:], len(code)]
    start, stop = np.r_[cell, cell - 1], np.r_[first, first]
    start, pick = np.unique(start, return_index=True)
    low = stop[pick]
    high = ends[np.searchsorted(cell, start + 1, "right") - 1]
    enough = np.flatnonzero(high - low >= index.least[start >> 32])
    for chunk in np.split(enough, np.flatnonzero(np.diff(np.cumsum((high - low)[enough]) // ENTRIES)) + 1):
        if not len(chunk):
            continue
        many = (high - low)[chunk]
        place = at[spread(low[chunk], many)]
        item, band = np.repeat(start[chunk] >> 32, many), np.repeat((start[chunk] & ((1 << 32) - 1)) - middle, many)
        first = np.searchsorted(index.order, (item << 32) + np.maximum(0, place + Q - WINDOW), "left")
        covers = np.searchsorted(index.order, (item << 32) + place, "right") - first
        window, place, band = spread(first, covers), np.repeat(place, covers), np.repeat(band, covers)
        inside = place + Q <= index.start[window] + index.size[window]
        found, count = np.unique((window[inside] << 32) + band[inside] + middle, return_counts=True)
        window, band = found >> 32, (found & ((1 << 32) - 1)) - middle
        reached = count >= index.needed[window]
        yield window[reached], band[reached]


def whole_items(index: Index, raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Windows that are whole items, and the places where they may stand."""
    if not index.whole:
        return
    hashes = gram_hashes(raw)
    for m, (keys, windows, first) in index.whole.items():
        place = np.flatnonzero(np.isin(hashes[: max(0, len(raw) - m + 1)], first))
        if not len(place):
            continue
        found = piece_hashes(raw, place, m)
        low = np.searchsorted(keys, found, "left")
        many = np.searchsorted(keys, found, "right") - low
        yield from zip(windows[spread(low[many > 0], many[many > 0])].tolist(), np.repeat(place, many).tolist())


def leaks(index: Index, lines: list[bytes]) -> list[tuple[int, int, int, int]]:
    """``(line, window, edits, start)`` of the verified regions of normalised texts; start is a lower bound."""
    pad = bytes(2 * WINDOW)
    starts = np.cumsum([len(pad), *(len(x) + len(pad) for x in lines)])
    body = pad + b"".join(x + pad for x in lines)
    raw, out, done = np.frombuffer(body, np.uint8), [], set()
    for w, at in whole_items(index, raw):
        n = int(np.searchsorted(starts, at, "right")) - 1
        if (n, w) not in done and body.startswith(index.text[index.begin[w] : index.begin[w] + index.size[w]].tobytes(), at):
            done.add((n, w))
            out.append((n, w, 0, at - int(starts[n])))
    for window, band in bands(index, raw):
        first = np.maximum(0, band * WIDE - RUN + index.start[window])
        line = np.searchsorted(starts, first + WINDOW, "right") - 1
        fits = (line >= 0) & (line < len(lines)) & (first + index.size[window] + 4 * WIDE <= len(raw))
        window, first, line = window[fits], first[fits], line[fits]
        # Each window is aligned once with each text that stands there, however often it does.
        rest: dict[tuple[int, bytes], list[int]] = {}
        for i, (w, f, n) in enumerate(zip(window.tolist(), first.tolist(), line.tolist())):
            if (n, w) in done:
                continue
            region, text = body[f : f + int(index.size[w]) + 4 * WIDE], index.text[index.begin[w] : index.begin[w] + index.size[w]].tobytes()
            if text in region:
                done.add((n, w))
                out.append((n, w, 0, max(0, f - int(starts[n]))))
            elif index.edits[w] > 0 or index.runs[w]:
                rest.setdefault((w, region), []).append(i)
        todo = sorted(rest, key=lambda x: int(index.size[x[0]]))
        sizes = [int(index.size[w]) for w, _ in todo]
        low = 0
        while low < len(todo):
            high = low + 1
            while high < len(todo) and sizes[high] == sizes[low] and high - low < ALIGNED:
                high += 1
            these, m = todo[low:high], sizes[low]
            w = np.array([t[0] for t in these])
            windows = index.text[index.begin[w][:, None] + np.arange(m)]
            regions = np.frombuffer(b"".join(t[1] for t in these), np.uint8).reshape(len(these), -1)
            edits = band_edits(windows, regions)
            open_ = np.flatnonzero(edits > index.edits[w])
            near = edits <= index.edits[w]
            if len(open_):
                side = np.where(index.edges[w[open_]], 0, Q)
                near[open_] = run_replaced(windows[open_], regions[open_], index.runs[w[open_]], side[:, 0], side[:, 1])
            for k in np.flatnonzero(near).tolist():
                for i in rest[these[k]]:
                    pair = (int(line[i]), int(window[i]))
                    if pair not in done:
                        done.add(pair)
                        out.append((*pair, int(edits[k]), max(0, int(first[i]) - int(starts[line[i]]))))
            low = high
    return out


def pieces(lines: list[bytes], overlap: int = 4 * WINDOW) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    """Texts in parts of bounded size; a longer text is cut with an overlap that holds any region and any item looked for as a whole."""
    owner, part, offset, held = [], [], [], 0
    for i, line in enumerate(lines):
        for at in range(0, max(1, len(line)), PART):
            owner.append(i)
            part.append(line[at : at + PART + overlap])
            offset.append(at)
            held += len(part[-1])
            if held >= PART:
                yield owner, part, offset
                owner, part, offset, held = [], [], [], 0
    if part:
        yield owner, part, offset


def grams_of(rows: DataFrame) -> DataFrame:
    """``gram, n``: the q-grams of texts with the number of their places, counted by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [gram_hashes(np.frombuffer(normal(t), np.uint8)) for t in column(batch, "text").to_pylist()]
            found, many = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(many.astype(np.int64))], names=["gram", "n"])

    return rows.select("text").mapInArrow(run, "gram long, n long")


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[Index]:
    """The benchmark's indexes, a bounded block of items at a time. An item longer than a block is a block.

    Where there are several blocks, q-grams are counted over all of them on Spark, and a block gets the common ones that it has.
    """
    rows = benchmark.select(benchmark[id_col].alias("item_id"), benchmark[text_col].alias("text")).dropna(subset=["text"])
    small_batches(benchmark.sparkSession)
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-size // block_bytes))
    of = lambda part: [(r["item_id"], r["text"]) for r in part.toLocalIterator()]
    if n == 1:
        yield build(of(rows))
        return
    # Texts of equal normal form count once.
    form = F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " "))
    spark, folder = benchmark.sparkSession, scratch_dir(benchmark.sparkSession, "benchmark")
    counted = grams_of(rows.groupBy(form).agg(F.min("text").alias("text"))).groupBy("gram").agg(F.sum("n").alias("n"))
    counted.filter(F.col("n") > COMMON).select("gram").write.parquet(folder)
    common = spark.read.schema("gram long").parquet(folder)
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        own = grams_of(part).select("gram").distinct()
        here = own.join(common, "gram", "left_semi").toArrow()["gram"].to_numpy().astype(np.uint64)
        yield build(of(part), np.sort(here))


def rows_found(index: Index, lines: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
    """``(row, window, edits, start)`` over whole texts."""
    for owner, part, offset in pieces([normal(t) for t in lines], max([4 * WINDOW, *index.whole])):
        for i, w, e, s in leaks(index, part):
            yield owner[i], w, e, s + offset[i]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, item_id, windows, edits, start`` per document and leaked item: verified windows, fewest edits,
    and about where the first begins, in bytes of the normal form.
    """
    source = texts(docs, id_col, text_col)
    schema = T.StructType().add("doc_id", source.schema["doc_id"].dataType).add("item_id", benchmark.schema[item_col].dataType)
    schema = schema.add("windows", "integer").add("edits", "integer").add("start", "long")
    item_type = benchmark.select(item_col).limit(0).toArrow().schema.field(0).type

    def search(index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for part, lines in (p for batch in batches for p in in_parts(batch)):
                found: dict[tuple[int, int], list] = {}
                for row, w, e, s in rows_found(index, lines):
                    now = found.setdefault((row, index.items[index.owner[w]]), [set(), e, s])
                    now[0].add(w)
                    now[1:] = [min(now[1], e), min(now[2], s)]
                if found:
                    ids = column(part, "doc_id").take(pa.array([row for row, _ in found], pa.int64()))
                    items = pa.array([item for _, item in found], item_type)
                    many = pa.array([len(x[0]) for x in found.values()], pa.int32())
                    edits, start = pa.array([x[1] for x in found.values()], pa.int32()), pa.array([x[2] for x in found.values()], pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, items, many, edits, start], names=schema.names)

        return source.mapInArrow(run, schema)

    out = None
    for index in blocks(benchmark, item_col, item_text_col, block_bytes):
        found = search(index)
        out = found if out is None else out.unionByName(found)
    return out


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows, whole, in which no window of any item is found.

    One block is held against the rows as they pass. More blocks, one after the other, give the digests of the texts that hold a leak, which then go.
    """
    small_batches(docs.sparkSession)
    bad = None
    for number, index in enumerate(blocks(benchmark, item_col, item_text_col, block_bytes)):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def leaking(batches: Iterator[pa.RecordBatch], name: str, keep: bool, shared=shared) -> Iterator[pa.RecordBatch]:
            for part, lines in (p for batch in batches for p in in_parts(batch, name)):
                mask = np.full(len(lines), not keep)
                for row, *_ in rows_found(shared.value, lines):
                    mask[row] = keep
                yield part.filter(pa.array(mask))

        if number == 0:
            clean = docs.mapInArrow(lambda batches, run=leaking: run(batches, text_col, False), docs.schema)
        own = docs.select(docs[text_col].alias("text")).mapInArrow(lambda batches, run=leaking: run(batches, "text", True), "text string")
        own = own.select(F.sha2("text", 256).alias("_digest"))
        bad = own if bad is None else bad.unionByName(own)
    if number == 0:
        return clean
    return docs.join(bad.distinct(), F.sha2(docs[text_col], 256) == F.col("_digest"), "left_anti")
