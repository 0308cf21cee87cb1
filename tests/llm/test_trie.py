"""The trie against prefixes held in a dictionary."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbstat.llm import trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs.setdefault(conv_id, []).append((turn is not None, turn or 0, name, role, text))
    for own in convs.values():
        own.sort()
    new, members, kids, sums = {}, {}, {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        new[c] = [t[3:] for t in convs.get(c - c % 20, [])[:h] + own[h:]]
        for d in range(len(new[c]) + 1):
            members.setdefault(tuple(new[c][:d]), []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(p, [])]
        words = len(WORD.findall(p[-1][1])) if p else 0
        sums[p] = (sum(b[0] for b in below) + (not below), sum(b[1] for b in below) + (len(members[p]) - 1) * words)
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(new[c]) == len(p))))
        up = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), up, len(m), len(kids.get(p, [])), *sums[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(table, **limits):
    return sorted(map(tuple, trie.prefix_trie(trie.rebuilt(table), **limits).collect()), key=str)


@pytest.mark.parametrize("rows", [1, 2, 5, 1 << 16])
def test_chunks_of_any_size_give_the_same_nodes(spark, rows):
    draw = random.Random(3)
    turns = [(c, t, draw.choice(["user", "bot", None]), draw.choice(["hello  there", "a", "", None])) for c in range(1, 160, 2) for t in range(draw.choice([1, 2, 3, 4, 9]))]
    turns += [(c, t, "user", "the same talk") for c in range(200, 260) for t in range(5)]  # a third is one conversation
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    assert found(table, chunk_rows=rows) == expected(turns)


def test_odd_conversations(spark):
    big = (1 << 53) + 1
    turns = [(0, 1, "user", "a b"), (0, 1, "user", "a b"), (0, None, None, None), (1, 2, "user", "x " * 100_000), (2, 1, "", ""), (20, 0, None, "hi")]
    turns += [(None, 1, "user", "nobody's"), (big, 1, "user", "a b"), (big, 1, "bot", "a b"), (21, 0, "user", "cut"), (47, 1, "user", "no base")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    table = table.withColumn("name", F.lit("clash")).withColumn("depth", F.lit("clash")).withColumn("key", F.lit(0))
    assert found(table) == expected(turns) and found(table, chunk_rows=2) == expected(turns)
    assert found(table.limit(0)) == []


def test_range_minima_equal_a_plain_search():
    draw = np.random.default_rng(1)
    for size in (1, 2, 7, 64, 100):
        gaps = draw.integers(0, 4, size - 1)
        table = trie.minima(gaps)
        at, depth = draw.integers(0, size, 200), draw.integers(0, 5, 200)
        for i, d, low, high in zip(at, depth, trie.leftmost(table, at, depth), trie.rightmost(table, at, depth)):
            left, right = i, i
            while left and gaps[left - 1] >= d:
                left -= 1
            while right < size - 1 and gaps[right] >= d:
                right += 1
            assert (low, high) == (left, right)
