"""A random forest of deep trees: large nodes are split by sums over all rows, and what hangs from a smaller node is grown by one task.

Features are binned once into byte codes, in the blocks that the booster uses. A job a tree level counts, for all trees together, the
classes by node, feature and bin; tasks choose the splits of a tree each, and the driver gets only these. A node of at most
``NODE_ROWS`` drawn rows is not split this way: its rows go to one task, which grows it to the end. So the number of passes over the
table follows from its rows, not from the depth of the trees, and no task holds more than a node's bounded rows.

Rules are those of the library's forest: Poisson draws, a new choice of features a node, Gini impurity, no split without gain, and
two leaves of one class become one. Counts are whole numbers and classes weigh only when splits are judged, so a repeated task gives
the same trees. The finished forest is stored in the library's layout and scores in the JVM.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstat.operators import boosting
from kerbstat.session import scratch_dir

BINS = 32
NODE_ROWS = 250_000  # drawn rows of a node, up to which one task grows it
STEPS = 1_024  # quantiles of a class
CHUNK = 2_048  # nodes that a task judges at once
LEAST_GAIN = 1e-12  # what rounding may leave of none

# How often a row is drawn, by a number below 2^16.
DRAWS = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)]) * 65536, np.arange(65536), side="right").astype(np.uint8)


def drawn(seed: int, tree: int, number: int, rows: int) -> np.ndarray:
    """How often a tree draws each row of a block."""
    return DRAWS[np.random.default_rng([seed, tree, number & 0xFFFFFFFF, number >> 32]).integers(0, 65536, rows, np.uint16)]


def choices(key: Sequence[int], nodes: int, features: int, kept: int) -> np.ndarray:
    """The features that each node may be split by."""
    return np.random.default_rng(key).random((nodes, features)).argsort(axis=1)[:, :kept].astype(np.int64)


# --- splits ----------------------------------------------------------------------------------


def counts(codes: np.ndarray, labels: np.ndarray, times: np.ndarray, rows: np.ndarray, at: np.ndarray, chosen: np.ndarray, bins: int, classes: int) -> np.ndarray:
    """Drawn rows by node, chosen feature, bin and class; ``at`` is the node of each of ``rows``."""
    nodes, kept = chosen.shape
    out = np.empty((nodes, kept, bins, classes), np.int64)
    label, weight = labels[rows], times[rows]
    for k in range(kept):
        key = (at * bins + codes[chosen[at, k], rows]) * classes + label
        out[:, k] = np.bincount(key, weight, nodes * bins * classes).reshape(nodes, bins, classes)
    return out


def judged(sums: np.ndarray, chosen: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per node the feature, bin and gain of its best split, and the classes that go left. Without gain there is no split."""
    nodes = np.arange(len(sums))
    left = sums.cumsum(axis=2)[:, :, :-1]
    right = sums.sum(axis=2, keepdims=True) - left
    pure = lambda n: ((n * weights) ** 2).sum(axis=-1) / np.maximum((n * weights).sum(axis=-1), 1e-300)
    whole = sums[:, 0].sum(axis=1)
    weight = np.maximum((whole * weights).sum(axis=-1), 1e-300)
    gain = (pure(left) + pure(right) - pure(whole)[:, None, None]) / weight[:, None, None]
    gain = np.where((left.sum(axis=-1) > 0) & (right.sum(axis=-1) > 0), gain, -1.0).reshape(len(sums), -1)
    best = gain.argmax(axis=1)
    k, b = np.divmod(best, left.shape[2])
    return chosen[nodes, k], b, gain[nodes, best], left[nodes, k, b]


def impure(stats: np.ndarray) -> np.ndarray:
    return (stats > 0).sum(axis=-1) > 1


# --- what one task grows ---------------------------------------------------------------------


@dataclass
class Grown:
    """Nodes in order of their making, so that children come after their parent; the right child follows the left one."""

    root: np.ndarray
    feature: np.ndarray  # -1: a leaf
    bin: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    stats: np.ndarray  # drawn rows by class


def grown(codes: np.ndarray, labels: np.ndarray, times: np.ndarray, at: np.ndarray, levels: np.ndarray, key: Sequence[int], kept: int, bins: int, weights: np.ndarray) -> Grown:
    """All that hangs from some nodes of a tree: ``at`` is the node of each row and ``levels`` how often each may still be split along a path."""
    many, classes = len(codes), len(weights)
    stats = np.bincount(at * classes + labels, times, len(levels) * classes).reshape(-1, classes).astype(np.int64)
    no = np.full(len(levels), -1)
    made = [Grown(np.arange(len(levels)), no.copy(), no.copy(), no.copy(), no.astype(float), stats)]
    first, level = 0, 0
    own = np.flatnonzero(impure(stats) & (levels > 0))  # open nodes, by place in the last level
    slot = np.full(len(levels), -1)
    slot[own] = np.arange(len(own))
    at = slot[at]
    rows = np.flatnonzero(at >= 0)
    at = at[rows]
    while len(own):
        last = made[-1]
        chosen = choices([*key, level], len(own), many, kept)
        order = np.argsort(at, kind="stable")
        rows, at = rows[order], at[order]
        parts = []
        for low in range(0, len(own), CHUNK):
            high = min(low + CHUNK, len(own))
            a, b = np.searchsorted(at, [low, high])
            sums = counts(codes, labels, times, rows[a:b], at[a:b] - low, chosen[low:high], bins, classes)
            parts.append(judged(sums, chosen[low:high], weights))
        feature, bin, gain, to_left = (np.concatenate(p) for p in zip(*parts))
        split = gain > LEAST_GAIN
        nodes = own[split]
        following = first + len(last.root)
        last.feature[nodes], last.bin[nodes], last.gain[nodes] = feature[split], bin[split], gain[split]
        last.left[nodes] = following + 2 * np.arange(len(nodes))
        stats = np.stack([to_left[split], last.stats[nodes] - to_left[split]], axis=1).reshape(-1, classes)
        root = np.repeat(last.root[nodes], 2)
        no = np.full(len(root), -1)
        made.append(Grown(root, no.copy(), no.copy(), no.copy(), no.astype(float), stats))
        first, level = following, level + 1
        own = np.flatnonzero(impure(stats) & (levels[root] > level))
        child = np.full(len(root) + 2, -1)
        child[own] = np.arange(len(own))
        pair = np.full(len(split), len(root))
        pair[split] = 2 * np.arange(len(nodes))
        at = child[pair[at] + (codes[feature[at], rows] > bin[at])]
        rows, at = rows[at >= 0], at[at >= 0]
    return pruned(made, weights)


def pruned(made: list[Grown], weights: np.ndarray) -> Grown:
    """The levels as one; a node of two leaves of the same class is a leaf."""
    whole = Grown(*[np.concatenate([getattr(g, name) for g in made]) for name in ("root", "feature", "bin", "left", "gain", "stats")])
    says, alive = (whole.stats * weights).argmax(axis=1), np.ones(len(whole.root), bool)
    high = len(whole.root)
    for level in reversed(made):
        low = high - len(level.root)
        nodes = low + np.flatnonzero(whole.feature[low:high] >= 0)
        left = whole.left[nodes]
        same = (whole.feature[left] < 0) & (whole.feature[left + 1] < 0) & (says[left] == says[left + 1])
        whole.feature[nodes[same]] = -1
        alive[left[same]] = alive[left[same] + 1] = False
        high = low
    number = np.cumsum(alive) - 1
    left = np.where(whole.feature >= 0, number[whole.left], -1)
    return Grown(*[x[alive] for x in (whole.root, whole.feature, whole.bin, left, whole.gain, whole.stats)])


# --- the upper levels, split by sums over all rows -------------------------------------------


@dataclass
class Top:
    """The nodes of a tree that the driver knows."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [-1])
    left: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    stats: list[np.ndarray] = field(default_factory=list)
    level: list[int] = field(default_factory=lambda: [0])
    given: list[int] = field(default_factory=lambda: [-1])  # number of the node among those that tasks grow
    open: list[int] = field(default_factory=list)

    def place(self, codes: np.ndarray) -> np.ndarray:
        """The node of each row."""
        feature, bin, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        node, rows = np.zeros(codes.shape[1], np.int64), np.arange(codes.shape[1])
        while len(rows := rows[feature[node[rows]] >= 0]):
            of = node[rows]
            node[rows] = left[of] + (codes[feature[of], rows] > bin[of])
        return node


def settle(top: Top, node: int, depth: int, given: list[tuple[int, int]], tree: int) -> None:
    """A new node is a leaf, or open, or for a task to grow."""
    if top.level[node] < depth and impure(top.stats[node]):
        if top.stats[node].sum() > NODE_ROWS:
            top.open.append(node)
        else:
            top.given[node] = len(given)
            given.append((tree, node))


def upper(state, trees: int, features: int, depth: int, kept: int, bins: int, weights: np.ndarray, seed: int, parts: int) -> tuple[list[Top], list[tuple[int, int]]]:
    """The trees down to nodes that a task can hold; ``state`` has numbers, codes, labels and the rows' open nodes of all trees."""
    classes = len(weights)

    def roots(block):
        number, _, labels, _ = block
        return [(t, np.bincount(labels, drawn(seed, t, number, len(labels)), classes).astype(np.int64)) for t in range(trees)]

    found = dict(state.flatMap(roots).reduceByKey(np.add, parts).collect())
    if not found:
        raise ValueError("a forest needs rows to learn from")
    given: list[tuple[int, int]] = []
    tops = []
    for t in range(trees):
        tops.append(Top(stats=[found[t]]))
        settle(tops[t], 0, depth, given, t)
    level, before = 0, None
    while any(top.open for top in tops):
        chosen = {t: choices([seed, t, level, 1], len(top.open), features, kept) for t, top in enumerate(tops) if top.open}

        def sums(block, chosen=chosen):
            number, codes, labels, places = block
            for t, some in chosen.items():
                times = drawn(seed, t, number, len(labels))
                rows = np.flatnonzero((places[t] >= 0) & (times > 0))
                yield t, counts(codes, labels, times, rows, places[t, rows].astype(np.int64), some, bins, classes)

        split = lambda item, chosen=chosen: (item[0], judged(item[1], chosen[item[0]], weights))
        best = dict(state.flatMap(sums).reduceByKey(np.add, parts).map(split).collect())
        if before is not None:
            before.unpersist()
        moves = {}
        for t, (feature, bin, gain, to_left) in best.items():
            top = tops[t]
            nodes, top.open = top.open, []
            following = np.full((len(nodes), 2), -1, np.int16)
            for i, node in enumerate(nodes):
                if gain[i] <= LEAST_GAIN:
                    continue
                left = len(top.feature)
                top.feature[node], top.bin[node], top.left[node], top.gain[node] = int(feature[i]), int(bin[i]), left, float(gain[i])
                for side, stats in enumerate((to_left[i], top.stats[node] - to_left[i])):
                    for column, value in zip((top.feature, top.bin, top.left, top.gain, top.stats, top.level, top.given), (-1, -1, -1, -1.0, stats, level + 1, -1)):
                        column.append(value)
                    settle(top, left + side, depth, given, t)
                    if top.open and top.open[-1] == left + side:
                        following[i, side] = len(top.open) - 1
            moves[t] = feature, bin, following

        def moved(block, moves=moves):
            number, codes, labels, places = block
            places = places.copy()
            for t, (feature, bin, following) in moves.items():
                rows = np.flatnonzero(places[t] >= 0)
                at = places[t, rows]
                places[t, rows] = following[at, (codes[feature[at], rows] > bin[at]).astype(np.int64)]
            return number, codes, labels, places

        before, level = state, level + 1
        state = before.map(moved).persist(StorageLevel.MEMORY_AND_DISK)
    for held in (before, state):
        if held is not None:
            held.unpersist()
    return tops, given


# --- the lower levels ------------------------------------------------------------------------


GROWN = "tree int, given int, id int, prediction double, impurity double, stats array<double>, raw long, gain double, left int, right int, feature int, threshold double"


def lower(packed: DataFrame, tops: list[Top], given: list[tuple[int, int]], depth: int, kept: int, bins: int, weights: np.ndarray, seed: int, edges: list[np.ndarray]) -> DataFrame:
    """All nodes from the given ones down, numbered within each of these from 0. A task gets nodes of one tree with up to ``NODE_ROWS`` rows in all."""
    spark, many, classes = packed.sparkSession, len(edges), len(weights)
    packs: list[list[int]] = []
    size, of_tree = 0, -1
    for i in sorted(range(len(given)), key=lambda i: given[i][0]):
        tree, node = given[i]
        rows = int(tops[tree].stats[node].sum())
        if tree != of_tree or size + rows > NODE_ROWS:
            packs.append([])
            size, of_tree = 0, tree
        packs[-1].append(i)
        size += rows
    pack_of, slot_of = np.zeros(len(given), np.int64), np.zeros(len(given), np.int64)
    for p, some in enumerate(packs):
        pack_of[some], slot_of[some] = p, np.arange(len(some))
    levels = [np.array([depth - tops[given[i][0]].level[given[i][1]] for i in some]) for some in packs]
    trees = [given[some[0]][0] for some in packs]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                labels = np.frombuffer(row["labels"], np.uint8)
                codes = np.frombuffer(row["codes"], np.uint8).reshape(many, -1)
                for t, top in enumerate(tops):
                    times = drawn(seed, t, row["number"], len(labels))
                    at = np.array(top.given)[top.place(codes)]
                    own = np.flatnonzero((at >= 0) & (times > 0))
                    if not len(own):
                        continue
                    pack, slot = pack_of[at[own]], slot_of[at[own]].astype("<i4")
                    order = np.argsort(pack, kind="stable")
                    own, pack, slot = own[order], pack[order], slot[order]
                    numbers, starts = np.unique(pack, return_index=True)
                    found = []
                    for a, b in zip(starts, [*starts[1:], len(own)]):
                        found.append(np.concatenate([codes[:, own[a:b]].reshape(-1), labels[own[a:b]], times[own[a:b]], slot[a:b].view(np.uint8)]).tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array([row["number"]] * len(found), pa.int64()), pa.array(found, pa.binary())], names=["pack", "number", "rows"])

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        p = key[0].as_py()
        parts = [np.frombuffer(b, np.uint8) for _, b in sorted(zip(table["number"].to_pylist(), table["rows"].to_pylist()))]
        sizes = [len(b) // (many + 6) for b in parts]
        codes = np.concatenate([b[: many * n].reshape(many, n) for b, n in zip(parts, sizes)], axis=1)
        labels, times = (np.concatenate([b[(many + k) * n : (many + k + 1) * n] for b, n in zip(parts, sizes)]) for k in (0, 1))
        slot = np.concatenate([b[(many + 2) * n :].copy().view("<i4") for b, n in zip(parts, sizes)]).astype(np.int64)
        found = grown(codes, labels, times, slot, levels[p], [seed, trees[p], p, 2], kept, bins, weights)
        order = np.argsort(found.root, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order)) - np.searchsorted(found.root[order], found.root[order])
        stats = found.stats * weights
        inner = found.feature >= 0
        threshold = np.zeros(len(order))
        for f in range(many):
            own = found.feature == f
            threshold[own] = edges[f][found.bin[own]]
        left = np.where(inner, place[found.left], -1)
        share = stats / stats.sum(axis=1, keepdims=True)
        columns = [
            np.full(len(order), trees[p]), np.array(packs[p])[found.root], place, stats.argmax(axis=1).astype(float), 1 - (share**2).sum(axis=1),
            pa.array(list(stats), pa.list_(pa.float64())), found.stats.sum(axis=1), np.where(inner, found.gain, -1.0), left, np.where(inner, left + 1, -1), found.feature, threshold,
        ]
        return pa.table([pa.array(c).cast(kind) for c, kind in zip(columns, KINDS)], names=NAMES)

    folder = scratch_dir(spark, "forest-nodes")
    everything = sum(int(tops[t].stats[n].sum()) for t, n in given)
    parts = max(1, min(len(packs), 4 * spark.sparkContext.defaultParallelism + everything // (8 * NODE_ROWS)))
    shared = packed.mapInArrow(rows, "pack int, number long, rows binary").repartition(parts, "pack")
    shared.groupBy("pack").applyInArrow(grow, GROWN).write.parquet(folder)
    return spark.read.schema(GROWN).parquet(folder)


NAMES = [c.split()[0] for c in GROWN.split(", ")]
KINDS = [{"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}[c.split()[1]] for c in GROWN.split(", ")]


# --- the whole -------------------------------------------------------------------------------


def bin_edges(rows: DataFrame, features: Sequence[str], label: str, weights: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Per feature the values up to which its codes reach: between all its values if these are few, else quantiles in which
    every row counts with the weight of its class, merged from quantiles of each class."""
    about = rows.agg(*[F.approx_count_distinct(f).alias(f) for f in features]).first()
    few = [f for f in features if about[f] <= bins]
    values = rows.agg(*[F.collect_set(f).alias(f) for f in few]).first() if few else {}
    many = [f for f in features if f not in few or len(values[f]) > bins]
    steps = F.array(*[F.lit((k + 1) / STEPS) for k in range(STEPS)])
    by_class = rows.groupBy(label).agg(F.count("*").alias("n"), *[F.percentile_approx(f, steps, 4 * STEPS).alias(f) for f in many]).collect() if many else []
    weight = np.repeat([r["n"] * weights[int(r[label])] / STEPS for r in by_class], STEPS)
    out = []
    for f in features:
        if f not in many:
            known = np.array(sorted(values[f]), float)
            out.append((known[1:] + known[:-1]) / 2)
            continue
        value = np.array([v for r in by_class for v in r[f]], float)
        order = np.argsort(value, kind="stable")
        reached = weight[order].cumsum()
        cuts = np.searchsorted(reached, reached[-1] * (np.arange(1, bins) / bins - 1e-9))
        edges = np.unique(value[order][cuts])
        out.append(edges[edges < value.max()])
    return out


def fit(
    rows: DataFrame,
    spread: DataFrame,
    features: Sequence[str],
    weights: Sequence[float],
    label: str = "label",
    *,
    trees: int,
    depth: int,
    bins: int = BINS,
    seed: int = 42,
) -> RandomForestClassificationModel:
    """The forest of rows whose classes weigh ``weights``. Labels count from 0; features must not be null.

    ``spread`` has the same rows, in the parts that make the blocks. The square root of the features, rounded up, is tried a node.
    """
    spark = rows.sparkSession
    weights = np.array(weights, float)
    edges = bin_edges(rows, features, label, weights, bins)
    kept = math.ceil(math.sqrt(len(features)))
    packed = boosting.packed(spread, features, label, edges)
    base = boosting.unpacked(packed, len(features)).persist(StorageLevel.MEMORY_AND_DISK)
    state = base.map(lambda b: (*b, np.zeros((trees, len(b[2])), np.int16)))
    parts = min(trees, 2 * spark.sparkContext.defaultParallelism)
    tops, given = upper(state, trees, len(features), depth, kept, bins, weights, seed, parts)
    base.unpersist()
    nodes = lower(packed, tops, given, depth, kept, bins, weights, seed, edges)
    return stored(spark, tops, given, nodes, weights, edges, {"numTrees": trees, "maxDepth": depth, "maxBins": bins, "seed": seed})


def stored(spark: SparkSession, tops: list[Top], given: list[tuple[int, int]], nodes: DataFrame, weights: np.ndarray, edges: list[np.ndarray], params: dict[str, int]) -> RandomForestClassificationModel:
    """The forest of the library: written in its layout and loaded. Only the upper nodes are numbered here, and how many hang from each given one."""
    about = {r["given"]: r for r in nodes.groupBy("given").agg(F.count("*").alias("n"), F.max(F.when(F.col("id") == 0, F.col("prediction"))).alias("says")).collect()}
    head, places = [], []
    for t, top in enumerate(tops):
        says = [int((s * weights).argmax()) for s in top.stats]
        leaf = [about[g]["n"] == 1 if g >= 0 else f < 0 for f, g in zip(top.feature, top.given)]
        alive = [True] * len(leaf)
        for i in reversed(range(len(leaf))):
            a, b = top.left[i], top.left[i] + 1
            if top.feature[i] >= 0 and leaf[a] and leaf[b] and says[a] == says[b]:
                leaf[i], alive[a], alive[b] = True, False, False
        number, following = {}, 0
        for i in range(len(leaf)):
            if alive[i] and top.given[i] < 0:
                number[i], following = following, following + 1
        for i in range(len(leaf)):
            if alive[i] and top.given[i] >= 0:
                number[i] = following
                places.append((top.given[i], following))
                following += about[top.given[i]]["n"]
        for i in number:
            if top.given[i] < 0:
                stats = top.stats[i] * weights
                share = stats / stats.sum()
                inner = not leaf[i]
                split = (top.feature[i], [float(edges[top.feature[i]][top.bin[i]])], -1) if inner else (-1, [], -1)
                sides = [number[top.left[i] + k] if inner else -1 for k in (0, 1)]
                head.append((t, (number[i], float(says[i]), float(1 - (share**2).sum()), stats.tolist(), int(top.stats[i].sum()), top.gain[i] if inner else -1.0, *sides, split)))
    at = spark.createDataFrame(places, "given int, at int")
    inner = F.col("feature") >= 0
    shifted = lambda c: F.when(inner, F.col(c) + F.col("at")).otherwise(-1).alias(f"{c}Child")
    split = F.struct(
        F.col("feature").alias("featureIndex"),
        F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    node = F.struct(
        (F.col("id") + F.col("at")).alias("id"), "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("raw").alias("rawCount"),
        "gain", shifted("left"), shifted("right"), split.alias("split"),
    )
    tail = nodes.join(at, "given").select(F.col("tree").alias("treeID"), node.alias("nodeData"))
    whole = spark.createDataFrame(head, boosting.NODE, verifySchema=False).unionByName(tail)

    folder = scratch_dir(spark, "forest")
    describe = lambda kind, uid, **more: json.dumps(
        {
            "class": f"org.apache.spark.ml.classification.{kind}",
            "timestamp": int(time.time() * 1000),
            "sparkVersion": spark.version,
            "uid": uid,
            "paramMap": {},
            "defaultParamMap": {
                "featuresCol": "features", "impurity": "gini", "labelCol": "label", "predictionCol": "prediction",
                "probabilityCol": "probability", "rawPredictionCol": "rawPrediction",
            },
            "numFeatures": len(edges),
            "numClasses": len(weights),
            **more,
        }
    )
    forest = describe("RandomForestClassificationModel", "weighted_forest", numTrees=len(tops), paramMap=params)
    spark.createDataFrame([(forest,)], "value string").coalesce(1).write.text(f"{folder}/metadata")
    each = [(i, describe("DecisionTreeClassificationModel", f"weighted_tree_{i}"), 1.0) for i in range(len(tops))]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{folder}/treesMetadata")
    whole.write.parquet(f"{folder}/data")
    return RandomForestClassificationModel.load(folder)
