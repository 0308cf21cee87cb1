"""Manifests against a tree built node by node."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from kerbstat.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves, arity):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def path(levels, place, arity):
    out = []
    for level in levels[:-1]:
        first = place // arity * arity
        run = level[first : first + arity]
        out.append(("".join(run[: place - first]), "".join(run[place - first + 1 :])))
        place //= arity
    return out


def expected(rows, arity):
    """``(tree, key, leaf, subroot, root, path)`` of ``(tree, key, leaf)``."""
    trees = {}
    for name, key, leaf in sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])):
        trees.setdefault(name, []).append((key, leaf))
    levels = {name: tree([leaf for _, leaf in nodes], arity) for name, nodes in trees.items()}
    top = tree([levels[name][-1][0] for name in trees], arity)
    return [
        (name, key, leaf, levels[name][-1][0], top[-1][0], path(levels[name], i, arity) + path(top, k, arity))
        for k, name in enumerate(trees)
        for i, (key, leaf) in enumerate(trees[name])
    ]


@pytest.mark.parametrize(("arity", "size"), [(2, 37), (3, 37), (8, 74), (8, 1)])
def test_every_arity_equals_a_tree_built_by_hand(spark, arity, size):
    rows = [(None if i % 11 == 0 else "abcé"[i % 4], None if i % 13 == 0 else i // 2, digest(str(i % 30))) for i in range(size)]
    table = spark.createDataFrame(rows, "tree string, key long, leaf string").repartition(5)
    found = merkle.build(table, table["leaf"], table["tree"], [table["key"]], {"key": table["key"]}, arity).proofs()
    got = [(r.tree, r.key, r.digest, r.subroot, r.root, [tuple(p) for p in r.path]) for r in found.collect()]
    assert sorted(got, key=str) == sorted(expected(rows, arity), key=str)


def test_proofs_lead_to_the_root_and_changed_leaves_do_not(spark):
    rows = [("xy"[i % 2], i, digest(str(i))) for i in range(50)]
    table = spark.createDataFrame(rows, "tree string, key long, leaf string")
    found = merkle.build(table, table["leaf"], table["tree"], [table["key"]]).proofs()
    kept, other = merkle.fold(F.col("digest"), F.col("path")), merkle.fold(F.sha2("digest", 256), F.col("path"))
    assert found.filter((kept != F.col("root")) | (other == F.col("root"))).count() == 0


def test_odd_documents(odd_docs):
    docs = odd_docs.withColumn("n_chars", F.length("text")).withColumn("idx", F.lit("x")).withColumn("tree", F.lit(1)).withColumn("root", F.lit(None).cast("int"))
    found = merkle.verify_documents(docs, docs["doc_id"] % 2 == 0)
    rows = found.collect()
    assert len(rows) == docs.count() and len({r.root for r in rows}) == 1
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaves = sorted(digest(*map(part, (r.doc_id, r.source, r.lang, r.n_chars, r.text))) for r in docs.collect())
    assert sorted(r.leaf for r in rows) == leaves
    # Lower-casing changes a text with letters from A to Z only.
    assert {r.doc_id for r in rows if not r.verified} == {r.doc_id for r in docs.collect() if r.doc_id and r.doc_id % 2 == 0 and any("A" <= c <= "Z" for c in r.text or "")}
    assert merkle.verify_documents(docs.limit(0), F.lit(True)).count() == 0
