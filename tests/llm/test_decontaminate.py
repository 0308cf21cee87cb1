"""The whole rule of leaks against a plain search, and what must not count as a leak."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from kerbstat.llm import decontaminate as leak

PHRASE = "answer the following question about the passage above"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n))


def distance(window, text):
    """Least edits to any piece of the text."""
    row = np.zeros(len(text) + 1, int)
    letters, steps = np.frombuffer(text, np.uint8), np.arange(len(text) + 1)
    for i, x in enumerate(window, 1):
        new = np.r_[i, np.minimum(row[:-1] + (letters != x), row[1:] + 1)]
        row = np.minimum.accumulate(new - steps) + steps
    return row.min()


def replaced(window, text, run, left, right):
    """Whether the text holds the window with at most ``run`` bytes replaced by others, whose number differs by that at most."""
    for a in range(left, len(window) - right + 1):
        for x in range(0, min(run, len(window) - right - a) + 1):
            head, tail, at = window[:a], window[a + x :], -1
            while (at := text.find(head, at + 1)) >= 0:
                for y in range(0, x + run + 1):
                    if text.startswith(tail, at + a + y) and max(x, x - y) <= run:
                        return True
    return False


def test_the_whole_rule_against_a_plain_search():
    rng = random.Random(11)
    base = [words(rng, n) for n in (3, 8, 12, 14, 20, 30)]
    items = [(k, t) for k, t in enumerate(base)] + [(k + 10, PHRASE + " " + words(rng, 12)) for k in range(leak.COMMON + 4)]
    index = leak.build(items)
    lines = [b""]
    for _ in range(60):
        source = leak.normal(rng.choice(items)[1])
        low = rng.randint(0, max(0, len(source) - 60))
        cut = bytearray(source[low : low + rng.choice([40, 60, 75, 110])])
        for _ in range(rng.choice([0, 1, 2, 3])):
            at = rng.randrange(len(cut))
            cut[at : at + rng.choice([0, 1, 1, 9])] = rng.choice([b"", b"x", b"zz", b"yyyyyyyy"])
        lines.append(leak.normal(words(rng, 6)) + b" " + bytes(cut) + b" " + leak.normal(words(rng, 6)))
    found = {(line, w) for line, w, *_ in leak.leaks(index, lines)}
    wanted = set()
    for w in range(len(index.owner)):
        text = index.text[index.begin[w] : index.begin[w] + index.size[w]].tobytes()
        side = [0 if edge else leak.Q for edge in index.edges[w]]
        for n, line in enumerate(lines):
            if any(text[at : at + 9] in line for at in range(len(text) - 8)):
                if distance(text, line) <= index.edits[w] or (index.runs[w] and replaced(text, line, int(index.runs[w]), *side)):
                    wanted.add((n, w))
    assert found == wanted and len({line for line, _ in found}) > 20


@pytest.mark.parametrize("items", [5, 50, 1000])
def test_phrases_that_items_share_are_no_leak(items):
    rng = random.Random(items)
    index = leak.build([(k, f"{PHRASE} {words(rng, 20)}") for k in range(items)])
    text = leak.normal(f"{words(rng, 30)} {PHRASE} {words(rng, 30)}")
    assert not leak.leaks(index, [text, leak.normal(PHRASE), leak.normal(PHRASE[:46] + " " + words(rng, 40))])
    whole = f"{PHRASE} {words(random.Random(items), 20)}"
    assert {r[0] for r in leak.leaks(index, [leak.normal(words(rng, 9) + " " + whole)])} == {0}, "the first item itself is one"


@pytest.mark.parametrize("items", [10, 50, 1500])
def test_a_hot_phrase_costs_little(items):
    rng = random.Random(items)
    index = leak.build([(k, f"{PHRASE} {words(rng, 20)}") for k in range(items)])
    hot = leak.normal(" ".join(f"{PHRASE} {words(rng, 1)}" for _ in range(20)))
    began = time.process_time()
    found = leak.leaks(index, [hot])
    assert time.process_time() - began < 1.0
    assert items <= leak.COMMON or not found


def test_blocks_share_what_is_common(spark):
    rng = random.Random(4)
    phrase = words(rng, 14)  # longer than a window
    items = [(k, f"{phrase} {words(rng, 20)}") for k in range(30)]
    docs = [(k, f"{words(rng, 10)} {items[k][1]} {words(rng, 10)}") for k in range(3)] + [(9, f"{words(rng, 9)} {phrase} {words(rng, 9)}"), (None, None)]
    documents, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for size in (2_000, leak.BLOCK_BYTES):
        found = leak.find_leaks(documents, benchmark, block_bytes=size).collect()
        assert sorted((r.doc_id, r.item_id) for r in found) == [(0, 0), (1, 1), (2, 2)]
        kept = leak.keep_clean(documents, benchmark, block_bytes=size).collect()
        assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, ""), (9, docs[3][1])]


def test_the_index_of_a_block_is_small():
    import pickle

    rng = random.Random(2)
    index = leak.build([(k, words(rng, 60)) for k in range(1_000)])
    assert len(pickle.dumps(index)) < 60 * len(index.text)


@pytest.mark.parametrize("copies", [leak.COMMON, leak.COMMON + 1, 200])
def test_a_whole_item_is_found_however_many_items_say_it(spark, copies):
    rng = random.Random(copies)
    text = words(rng, 90)  # longer than the overlap of parts
    items = [(k, text + " " * k + "." * (k % 3)) for k in range(3)] + [(k + 10, f"{words(rng, 3)} {text} {words(rng, 3)}") for k in range(copies - 1)]
    index = leak.build(items)
    line = leak.normal(f"{words(rng, 9)} {text} {words(rng, 9)}")
    cut = leak.normal(text)[:-1] + b"#" + leak.normal(words(rng, 9))
    found = leak.leaks(index, [cut, line, b"", line + line])
    # Where the text is common, the longer items' own words are their evidence, and they do not stand there.
    common = copies > leak.COMMON
    assert {index.owner[w] for n, w, *_ in found if n == 1} == set(range(3 if common else len(items)))
    assert not common or {n for n, *_ in found} == {1, 3}
    long = "x " * ((leak.PART - 150) // 2) + text
    docs = spark.createDataFrame([(1, long), (2, words(rng, 30)), (3, None), (4, text)], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for size in (40_000, leak.BLOCK_BYTES):
        leaked = {(r.doc_id, r.item_id) for r in leak.find_leaks(docs, benchmark, block_bytes=size).collect()}
        assert {(d, i) for d in (1, 4) for i in range(3)} <= leaked and {d for d, _ in leaked} == {1, 4}
        assert sorted(r.doc_id for r in leak.keep_clean(docs, benchmark, block_bytes=size).collect()) == [2, 3]
