"""Approximate nearest neighbours: a hierarchical k-means tree with best-bin-first search.

The tree is fitted on at most ``SAMPLE_ROWS`` unit vectors; every row is then assigned to a leaf.
A query takes nodes from a priority queue, nearest centre first, and so visits leaves in order. How many it
visits is calibrated: brute force finds the neighbours of at most ``CALIBRATION`` queries among all rows, and visits are widened
until their leaves hold ``TARGET`` of those neighbours. Visited leaves and rows meet in groups of (leaf, part, query block) of bounded size.

Equal vectors are searched once: of those that share a vector only the ``k + 1`` smallest ids can be
among the results of any query. Nearness is the cosine in double precision; ties go to the smaller id. Vectors that are null, zero, hold
null or non-finite components or have another length than most take no part, nor do null ids; rows repeated with id and
vector count once. With fewer candidates than k all are given; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
CALIBRATION = 200
TARGET = 0.96
BRANCHES = 8
LEAF_ROWS = 4  # times the square root of the rows is the most that a leaf is to hold, as far as the sample allows
LEAF_SAMPLE = 16  # least rows of the sample in a leaf
PART_ROWS, BLOCK_QUERIES = 4096, 2048
STEPS = 15  # of k-means


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, which changes no digit, so that lengths neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0.0))[1])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def stacked(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


@dataclass
class Tree:
    centres: np.ndarray  # of each node
    children: list[list[int]]
    leaf: np.ndarray  # number of each leaf node, else -1

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: the nearest child, from the root down."""
        node = np.zeros(len(x), np.int64)
        todo = [0]
        while todo:
            at = todo.pop()
            if not self.children[at]:
                continue
            rows = np.flatnonzero(node == at)
            if len(rows):
                near = (x[rows] @ self.centres[self.children[at]].T).argmax(axis=1)
                node[rows] = np.array(self.children[at])[near]
                todo += self.children[at]
        return self.leaf[node]

    def visit(self, query: np.ndarray, most: int, sizes: dict[int, int] | None = None, least: int = 0) -> list[int]:
        """``most`` leaves in best-bin-first order, and more until those visited hold ``least`` vectors."""
        held = 0
        near = -(self.centres @ query)
        queue, out = [(near[0], 0)], []
        while queue and (len(out) < most or held < least):
            _, at = heapq.heappop(queue)
            if self.children[at]:
                for child in self.children[at]:
                    heapq.heappush(queue, (near[child], child))
            else:
                out.append(int(self.leaf[at]))
                held += sizes.get(out[-1], 0) if sizes else 0
        return out


def grow(x: np.ndarray, leaf_sample: int, seed: int = 7) -> Tree:
    """Split the unit vectors by k-means until a node holds at most ``leaf_sample``."""
    rng = np.random.default_rng(seed)
    centres, children, todo = [x.mean(axis=0)], [[]], [(0, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        if len(rows) <= leaf_sample:
            continue
        points = x[rows]
        mid = points[rng.choice(len(rows), min(BRANCHES, len(rows)), replace=False)]
        for _ in range(STEPS):
            near = (points @ mid.T).argmax(axis=1)
            sums = np.stack([points[near == k].sum(axis=0) if (near == k).any() else mid[k] for k in range(len(mid))])
            mid = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        near = (points @ mid.T).argmax(axis=1)
        used = [k for k in range(len(mid)) if (near == k).any()]
        if len(used) < 2:
            continue  # equal vectors
        for k in used:
            children[at].append(len(centres))
            todo.append((len(centres), rows[near == k]))
            centres.append(mid[k])
            children.append([])
    leaf, n = np.full(len(centres), -1), 0
    for node, below in enumerate(children):
        if not below:
            leaf[node], n = n, n + 1
    return Tree(np.stack(centres), children, leaf)


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part."""
    v = F.col("vector")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False)))
    usual = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size(v) == (usual["n"] if usual else 0))


def rank_found(found: DataFrame, key: str, most: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def scored(queries: np.ndarray, keys: np.ndarray, x: np.ndarray, ids: list, most: int) -> pd.DataFrame:
    """The ``most`` best (query, id, score) rows of one block; every vector brings its few smallest ids."""
    queries, x = scaled(queries), scaled(x)
    cos = (queries @ x.T) / np.linalg.norm(queries, axis=1)[:, None] / np.linalg.norm(x, axis=1)[None, :]
    few = min(most, cos.shape[1])
    cut = np.partition(cos, cos.shape[1] - few, axis=1)[:, cos.shape[1] - few]
    q, c = np.nonzero(cos >= cut[:, None])
    out = pd.DataFrame({"key": keys[q], "at": c, "score": cos[q, c]})
    out["vec_id"] = [ids[i] for i in out["at"]]
    out = out.explode("vec_id").astype({"vec_id": "int64"}).sort_values(["key", "score", "vec_id"], ascending=[True, False, True])
    return out.groupby("key").head(most)


FOUND = "key long, vec_id long, score double"


def search(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    sample_rows: int = SAMPLE_ROWS,
    target: float = TARGET,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``is_query`` (a condition on ``vec_id``) its k nearest other rows."""
    spark = vectors.sparkSession
    rows = clean(vectors, id_col, vector_col)
    asked = rows.filter(is_query).distinct()
    keyed = asked.groupBy("vector").agg(F.min("vec_id").alias("key"))
    place = F.dense_rank().over(Window.partitionBy("vector").orderBy("vec_id"))
    first = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    distinct = first.groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))

    n = distinct.count()
    sample = distinct.orderBy(F.xxhash64("vector"), "vector").limit(sample_rows).select("vector").toPandas()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = unit(stacked(sample["vector"]))
    tree = spark.sparkContext.broadcast(grow(x, max(LEAF_SAMPLE, int(LEAF_ROWS * len(x) / n**0.5))))

    def to_leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.value.assign(unit(stacked(batch["vector"]))))

    placed = distinct.select("vector", "ids").mapInPandas(to_leaves, "vector array<double>, ids array<long>, leaf int")
    visits = calibrate(placed, keyed, tree, k, target)

    sizes = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    parts = {leaf: -(-m // PART_ROWS) for leaf, m in sizes.items()}
    blocks = max(1, -(-(keyed.count() * visits) // max(1, tree.value.leaves) // BLOCK_QUERIES))

    def to_visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, vector in zip(batch["key"], batch["vector"]):
                q = np.asarray(vector, np.float64)
                for leaf in tree.value.visit(unit(q[None])[0], visits, sizes, k + 1):
                    out += [(key, vector, leaf, p) for p in range(parts.get(leaf, 0))]
            yield pd.DataFrame(out, columns=["key", "vector", "leaf", "part"])

    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block")
    spread = keyed.repartition(max(1, spark.sparkContext.defaultParallelism), "key")
    left = spread.mapInPandas(to_visits, "key long, vector array<double>, leaf int, part int").select("*", block)
    count = F.element_at(F.create_map(*[F.lit(v) for pair in parts.items() for v in pair]), F.col("leaf"))
    right = placed.withColumn("part", F.pmod(F.xxhash64("vector"), count).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(held):
            return pd.DataFrame({"key": [], "vec_id": [], "score": []})
        out = scored(stacked(queries["vector"]), queries["key"].to_numpy(), stacked(held["vector"]), held["ids"].tolist(), k + 1)
        return out[["key", "vec_id", "score"]]

    group = ["leaf", "part", "block"]
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(meet, FOUND)
    best = rank_found(found, "key", k + 1).drop("rank")
    names = asked.join(keyed, "vector").select(F.col("vec_id").alias("query_id"), "key")
    mine = best.join(names, "key").filter(F.col("vec_id") != F.col("query_id"))
    return rank_found(mine, "query_id", k).select("query_id", "rank", "vec_id", "score")


def calibrate(placed: DataFrame, keyed: DataFrame, tree, k: int, target: float) -> int:
    """How many leaves to visit: the fewest that hold ``target`` of the true neighbours of a bounded set of queries."""
    chosen = keyed.orderBy(F.xxhash64("key"), "key").limit(CALIBRATION).toPandas()
    if not len(chosen):
        return 1
    queries, keys = stacked(chosen["vector"]), chosen["key"].to_numpy()

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                out = scored(queries, keys, stacked(batch["vector"]), batch["ids"].tolist(), k + 1)
                yield out.assign(leaf=batch["leaf"].to_numpy()[out["at"]])[["key", "vec_id", "score", "leaf"]]

    truth = rank_found(placed.mapInPandas(brute, FOUND + ", leaf int"), "key", k + 1).toPandas()
    order = {key: tree.value.visit(unit(q[None])[0], tree.value.leaves) for key, q in zip(keys, queries)}
    truth = truth[truth["vec_id"] != truth["key"]].sort_values(["key", "rank"]).groupby("key").head(k)
    depth = np.array([order[key].index(leaf) + 1 for key, leaf in zip(truth["key"], truth["leaf"])])
    visits, most = 1, tree.value.leaves
    while visits < most and len(depth) and (depth <= visits).mean() < target:
        visits += 1  # wider, until the recall is reached
    return visits
