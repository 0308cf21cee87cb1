"""Scores against counts held in dictionaries."""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbstat.llm import interpolation, registry
from kerbstat.llm.common import held_out

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


class Plain:
    """The same mixture over whole counters; events are not rounded."""

    def __init__(self, texts, train):
        self.tokens = [WORD.findall(lower(t)) + [" end"] for t in texts]
        self.one, self.two, events = collections.Counter(), collections.Counter(), collections.Counter()
        chosen = [t for t, use in zip(self.tokens, train) if use]
        for t in chosen:
            self.one.update(t)
            self.two.update(self.pairs(t))
        self.total, self.types, self.ends = sum(self.one.values()), len(self.one), self.one[" end"]
        for t in chosen:
            one, two = collections.Counter([" start", *t]), collections.Counter(self.pairs(t))
            for u, w in self.pairs(t):
                context = self.context(u) - one[u]
                events[context.bit_length(), (self.two[u, w] - two[u, w]) / max(1, context), (self.one[w] - one[w]) / self.total] += 1
        of = np.array([e[0] for e in events])
        p, n = np.array([[e[1], e[2], 1 / (self.types + 1)] for e in events]), np.array(list(events.values()))
        self.weights = np.ones((65, 3)) / 3
        for _ in range(200):
            share = self.weights[of] * p
            share *= (n / share.sum(axis=1))[:, None]
            new = np.full((65, 3), 0.5)
            new[0, 0] = 0
            np.add.at(new, of, share)
            self.weights = new / new.sum(axis=1, keepdims=True)
        self.seen = set(of.tolist())

    def pairs(self, t):
        return list(zip([" start", *t], t))

    def context(self, u):
        return self.ends if u == " start" else self.one[u]

    def score(self, t):
        out = base = 0.0
        for u, w in self.pairs(t):
            b = self.context(u).bit_length()
            while b > 1 and b not in self.seen:
                b -= 1
            a = self.weights[b]
            out += math.log10(a[0] * self.two[u, w] / max(1, self.context(u)) + a[1] * self.one[w] / self.total + a[2] / (self.types + 1))
            base += math.log10((self.one[w] + 1) / (self.total + self.types + 1))
        return out, base


def test_the_query_equals_plain_counting(spark, folder, load):
    rows = sorted(registry.op11_interpolation(spark, folder).collect())
    docs = sorted((r.doc_id, r.text) for r in load("documents").select("doc_id", "text").collect())
    out = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    plain = Plain([t for _, t in docs], [not h for h in out])
    ours = theirs = 0.0
    for row, (doc_id, _), held, tokens in zip(rows, docs, out, plain.tokens):
        score, base = plain.score(tokens)
        assert (row.doc_id, row.held_out, row.n_tokens, row.train_tokens) == (doc_id, held, len(tokens), plain.total)
        assert row.n_known == sum(plain.one[w] > 0 for w in tokens)
        assert row.base_score == pytest.approx(base, rel=1e-9) and row.score == pytest.approx(score, rel=5e-3)
        if held:
            ours, theirs = ours + row.score, theirs + row.base_score
    assert ours > 0.9 * theirs, "held-out text is likelier by bigrams"


def test_bundles_and_shards_do_not_change_scores(spark, load):
    docs = load("documents").limit(300)
    train = ~held_out(docs["doc_id"], 7, 2)
    one = sorted(interpolation.score_documents(docs, train).collect())
    many = sorted(interpolation.score_documents(docs.repartition(7), train, bundle_tokens=500, shard_bytes=20_000).collect())
    for a, b in zip(one, many):
        assert a[:5] == b[:5] and a.base_score == pytest.approx(b.base_score) and a.score == pytest.approx(b.score, rel=1e-9)


def test_odd_documents(odd_docs, monkeypatch):
    big = (1 << 53) + 1
    docs = odd_docs.withColumn("doc_id", F.col("doc_id") + F.lit(big - 1)).withColumn("train", F.lit("clash")).withColumn("row", F.lit(1))
    found = {r.doc_id: r for r in interpolation.score_documents(docs, docs["doc_id"] != big + 1).collect()}
    assert set(found) == {r.doc_id for r in docs.select("doc_id").collect()}
    assert found[big + 2].n_tokens == found[big + 3].n_tokens == found[big + 4].n_tokens == 1 and found[big + 2].score == found[big + 3].score < 0
    assert found[big + 7].n_tokens == 90_001 and found[big + 8].n_tokens == 2 and not found[None].trained
    none = interpolation.score_documents(odd_docs, F.lit(False)).collect()
    assert len(none) == odd_docs.count() and all(r.score == r.base_score == 0 and r.n_known == r.train_tokens == 0 for r in none)
    assert interpolation.score_documents(odd_docs.limit(0), F.lit(True)).count() == 0


def test_a_long_text_in_parts_counts_as_one(spark):
    text = " ".join(str(i % 977) for i in range(400_000))  # 1.5 MB
    docs = spark.createDataFrame([(1, text), (2, "5 6 7")], "doc_id long, text string")
    row = next(r for r in interpolation.score_documents(docs, F.lit(True), bundle_tokens=1_000).collect() if r.doc_id == 1)
    plain = Plain([text, "5 6 7"], [True, True])
    base = plain.score(plain.tokens[0])[1]
    assert (row.n_tokens, row.n_known, row.train_tokens) == (400_001, 400_001, 400_005) and row.base_score == pytest.approx(base)
