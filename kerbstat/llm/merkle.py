"""Merkle manifest of a table: trees of digests by sibling-shift self-joins.

A leaf is the SHA-256 of a row's fields. The leaves of a tree (here a language) stand in the order of a key; every
``arity`` consecutive nodes become the digest of their digests, level by level, until one node, the subroot, is left. The subroots,
in the order of their trees, are the leaves of one more tree, whose last node is the root.

No group is collected. Places come from one sort by range: each part counts its rows by tree, and the counts of the
parts before give the rest. On every level, nodes are equijoined with the computed indices of their siblings: the
index XOR 1 in a binary tree, else the run's first index plus each slot offset. All these joins have the run as their
key, so a level is shuffled once; the rows of slot zero then emit the parents. Proofs go the other way:
each level joins its siblings to the path of its parents. Each level is written to the shared scratch folder, so that lost executors
cost no more than a level.

Null fields count as ``-``, so each row has a leaf; null keys come first, as do null trees. Rows with equal keys are ordered by
leaf, repeated rows are a leaf each (the order among them changes no digest). An empty table has no root and no proofs. Texts of any
length are hashed where they are read and never shuffled. Columns are taken by name up front, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbstat.session import scratch_dir

ARITY = 8
NODE = ("tree", "n", "idx", "digest")


def digest_of(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts, one after the other."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def field(value: Column) -> Column:
    """A leaf's part for a value: ``-`` for null, else byte count, colon and text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def placed(rows: DataFrame, order: Sequence[str], folder: str) -> DataFrame:
    """The rows with ``idx``, their place in their ``tree`` by ``order``, and ``n``, the size of the tree.

    The sort's last key is the input partition, so that rows repeated without end still spread over tasks.
    """
    last = F.spark_partition_id()
    keys = [F.col("tree").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("_last")]
    ordered = rows.withColumn("_last", last).orderBy(*keys).withColumn("_at", F.monotonically_increasing_id()).drop("_last")
    ordered = stored(ordered.withColumn("_part", F.expr("shiftright(_at, 33)")), folder)
    parts = ordered.groupBy("tree", "_part").agg(F.count("*").alias("rows"), F.min("_at").alias("first"))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select(
        F.col("tree").alias("_tree"), F.col("_part").alias("_p"), (before - F.col("first")).alias("_shift"), F.sum("rows").over(whole).alias("n")
    )
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_part") == F.col("_p"))
    return ordered.join(starts, same).withColumn("idx", F.col("_at") + F.col("_shift")).drop("_tree", "_p", "_shift", "_at", "_part")


def with_siblings(nodes: DataFrame, level: DataFrame, arity: int) -> DataFrame:
    """Nodes with ``run``, ``slot``, and ``before`` and ``after``: the digests of the run's other nodes, joined, left and right of them."""
    run = F.floor(F.col("idx") / arity) if arity & (arity - 1) else F.expr(f"shiftright(idx, {arity.bit_length() - 1})")
    asking = nodes.withColumn("run", run).withColumn("slot", F.col("idx") - F.col("run") * arity)
    if arity == 2:
        other = level.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("digest").alias("_0"))
        found = asking.join(other, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("idx").bitwiseXOR(F.lit(1)) == F.col("_idx")), "left")
        other = F.coalesce("_0", F.lit(""))
        sides = {"before": F.when(F.col("slot") == 1, other).otherwise(""), "after": F.when(F.col("slot") == 0, other).otherwise("")}
        return found.withColumns(sides).drop("_tree", "_idx", "_0")
    found = asking
    for offset in range(arity):
        at_offset = F.col("idx") - run * arity == offset
        other = level.filter(at_offset).select(F.col("tree").alias("_tree"), run.alias("_run"), F.col("digest").alias(f"_{offset}"))
        found = found.join(other, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("run") == F.col("_run")), "left").drop("_tree", "_run")
    part = lambda o, there: F.when(there, F.coalesce(f"_{o}", F.lit(""))).otherwise("")
    sides = {
        "before": F.concat(*[part(o, F.col("slot") > o) for o in range(arity - 1)]),
        "after": F.concat(*[part(o, F.col("slot") < o) for o in range(1, arity)]),
    }
    return found.withColumns(sides).drop(*[f"_{o}" for o in range(arity)])


def climb(leaves: DataFrame, arity: int, folder: str) -> list[DataFrame]:
    """All levels as ``tree, n, idx, digest``; ``n`` is the number of the tree's nodes on the level. Trees end where ``n`` is 1."""
    levels = [leaves.select(*NODE)]
    most = leaves.agg(F.max("n").alias("n")).first()["n"] or 0
    while most > 1:
        open_nodes = levels[-1].filter("n > 1")
        first = with_siblings(open_nodes.filter(f"idx % {arity} = 0"), open_nodes, arity)
        parents = first.select("tree", F.expr(f"(n + {arity - 1}) div {arity}").alias("n"), F.col("run").alias("idx"), digest_of(F.col("digest"), F.col("after")).alias("digest"))
        levels.append(stored(parents, f"{folder}/level-{len(levels)}"))
        most = -(-most // arity)
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """``tree, digest`` of the last node of each tree."""
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.filter("n = 1").select("tree", "digest")


def descend(leaves: DataFrame, levels: list[DataFrame], ends: DataFrame, arity: int, folder: str) -> DataFrame:
    """The leaves with ``path``: before and after of each level up, the lowest first, and what ``ends`` says of their tree.

    ``ends`` has ``tree, path`` for the last node of each tree, and any further columns.
    """
    more = [c for c in ends.columns if c not in ("tree", "path")]
    ends = ends.select(F.col("tree").alias("_tree"), F.col("path").alias("_path"), *more)
    above = None
    for k in range(len(levels) - 1, -1, -1):
        rows = leaves if k == 0 else levels[k]
        own = F.array(F.struct("before", "after"))
        out = rows.filter("n = 1").join(ends, F.col("tree").eqNullSafe(F.col("_tree"))).withColumn("path", F.col("_path")).drop("_tree", "_path")
        if above is not None:
            parents = above.select(F.col("tree").alias("_tree"), F.col("idx").alias("_run"), F.col("path").alias("_path"), *more)
            sides = with_siblings(rows.filter("n > 1"), levels[k].filter("n > 1"), arity)
            sides = sides.join(parents, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("run") == F.col("_run")))
            sides = sides.withColumn("path", F.concat(own, "_path")).select(out.columns)
            out = out.unionByName(sides)
        above = stored(out, f"{folder}/paths-{k}") if k else out
    return above


@dataclass
class Manifest:
    leaves: DataFrame  # tree, n, idx, digest and the columns kept of the rows
    levels: list[DataFrame]
    roots: list[DataFrame]  # levels of the tree over the subroots
    ranks: DataFrame  # the subroots as leaves of that tree, with their own tree as name
    arity: int
    folder: str

    def proofs(self) -> DataFrame:
        """The leaves with ``subroot``, ``root`` and ``path`` from the leaf to the root."""
        root = tops(self.roots).select(F.lit(0).alias("tree"), F.col("digest").alias("root"), F.expr("cast(array() as array<struct<before string, after string>>)").alias("path"))
        ranks = descend(self.ranks, self.roots, root, self.arity, f"{self.folder}/roots")
        ends = ranks.select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
        ends = stored(ends, f"{self.folder}/ends")
        return descend(self.leaves, self.levels, ends, self.arity, self.folder)


def build(rows: DataFrame, leaf: Column, tree: Column, order: Sequence[Column], keep: dict[str, Column] | None = None, arity: int = ARITY) -> Manifest:
    """The manifest of a table's rows: their digest, the tree that they belong to and the order there; ``keep`` stays beside the leaves."""
    folder = scratch_dir(rows.sparkSession, "merkle")
    kept = {f"_k{i}": c for i, c in enumerate((keep or {}).values())}
    sort = {f"_o{i}": c for i, c in enumerate(order)}
    named = rows.select(tree.alias("tree"), leaf.alias("digest"), *[c.alias(n) for n, c in {**kept, **sort}.items()])
    leaves = placed(named, [*sort, "digest"], f"{folder}/rows").drop(*sort)
    leaves = stored(leaves.select(*NODE, *[F.col(n).alias(own) for n, own in zip(kept, keep or {})]), f"{folder}/leaves")
    levels = climb(leaves, arity, folder)
    subroots = tops(levels).select(F.lit(0).alias("tree"), F.col("tree").alias("name"), "digest")
    ranks = stored(placed(subroots, ["name"], f"{folder}/subroots"), f"{folder}/ranks")
    return Manifest(leaves, levels, climb(ranks, arity, f"{folder}/roots"), ranks, arity, folder)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings' digests, from the leaf up."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), "").cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to: each level's siblings around the digest so far, hashed."""
    return F.aggregate(path, leaf, lambda digest, p: digest_of(p["before"], digest, p["after"]))


def verify_documents(docs: DataFrame, tampered: Column, id_col: str = "doc_id", fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), tree_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row: its place in the manifest, and whether its row
    still leads to the root once the texts of the ``tampered`` rows have their A-Z lower-cased.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(docs[text_col], upper, upper.lower())
    of = lambda text: digest_of(*[field(text if c == text_col else docs[c]) for c in fields])
    changed = of(F.when(F.coalesce(tampered, F.lit(False)), lowered).otherwise(docs[text_col]))
    found = build(docs, of(docs[text_col]), docs[tree_col], [docs[id_col]], {"doc_id": docs[id_col], "changed": changed}).proofs()
    out = found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), fold(F.col("changed"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
