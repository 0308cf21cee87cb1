"""Every operator on nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from kerbstat.llm import bpe, decontaminate, langid, licenses, ngram_join, packing, quality, toxicity, urls

SPEC = bpe.read_spec(public_tokenizers.path("word_bpe_49k.json"))
RANKS = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()

PER_DOCUMENT = {
    "toxicity": lambda docs, labels: toxicity.detect(docs, toxicity.learn(docs, labels)),
    "quality": lambda docs, labels: quality.classify(docs, quality.learn(docs, labels)),
    "language": lambda docs, labels: langid.identify(docs, langid.learn(docs)),
    "bpe": lambda docs, labels: bpe.encode_documents(docs, SPEC, with_ids=True),
    "licenses": lambda docs, labels: licenses.scan(docs),
    "join": lambda docs, labels: ngram_join.link_documents(docs),
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(name, odd_docs, odd_labels):
    found = PER_DOCUMENT[name](odd_docs, odd_labels)
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in found.collect())
    assert ids == sorted((r.doc_id is None, r.doc_id or 0) for r in odd_docs.select("doc_id").collect())
    rows = {}
    for r in found.collect():
        assert rows.setdefault(r.doc_id, r) == r, "repeated rows get equal results"


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_empty_tables(name, odd_docs, odd_labels):
    assert PER_DOCUMENT[name](odd_docs.limit(0), odd_labels.limit(0)).count() == 0
    assert PER_DOCUMENT[name](odd_docs, odd_labels.limit(0)).count() == odd_docs.count()


def test_defined_results_of_empty_texts(odd_docs, odd_labels):
    by = lambda df: {r.doc_id: r for r in df.collect()}
    language = by(PER_DOCUMENT["language"](odd_docs, odd_labels))
    assert {language[i].lang_pred for i in (3, 4, 5, 6)} == {"und"} and language[1].lang_pred == "en"
    toxic = by(PER_DOCUMENT["toxicity"](odd_docs, odd_labels))
    assert toxic[3].score == toxic[4].score and 0 <= toxic[3].score <= 1
    good = by(PER_DOCUMENT["quality"](odd_docs, odd_labels))
    assert good[3].score == good[4].score
    joined = by(PER_DOCUMENT["join"](odd_docs, odd_labels))
    assert [(joined[i].n_shingles, joined[i].component_id) for i in (3, 4, 5)] == [(0, 3), (0, 4), (0, 5)]
    assert joined[2].component_id == 1 and joined[7].n_shingles == 1
    tokens = by(PER_DOCUMENT["bpe"](odd_docs, odd_labels))
    assert tokens[3].n_tokens == tokens[5].n_tokens == 0 and tokens[3].ids_sha256 == tokens[4].ids_sha256
    found = by(licenses.scan(odd_docs))
    assert (found[3].n_words, found[3].first_word, found[3].labels, found[3].score) == (0, None, "", 0.0)
    assert found[None].base_labels == "mit"


def test_packing_and_leaks(odd_docs, spark):
    packed = packing.pack(odd_docs, RANKS, public_tokenizers.PATTERN, length=64)
    assert packing.unpack(packed).select("doc_id").distinct().count() == odd_docs.select("doc_id").distinct().count()
    assert packing.pack(odd_docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    items = [(1, "The cat sat on the mat, and looked at the dog for a long while!"), (2, None), (3, ""), (None, "short")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(odd_docs, benchmark).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in found) == [(1, 1, 0), (1, 1, 0), (2, 1, 0)]
    assert decontaminate.find_leaks(odd_docs, benchmark.limit(0)).count() == 0
    assert decontaminate.find_leaks(odd_docs.limit(0), benchmark).count() == 0
    kept = decontaminate.keep_clean(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    blocks = decontaminate.find_leaks(odd_docs, benchmark, block_bytes=20)
    assert sorted(blocks.collect()) == sorted(found)


def test_stages_keep_the_columns(spark, odd_docs, folder):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, odd_docs, folder)
        assert kept.schema == odd_docs.schema, name
        assert stage(spark, odd_docs.limit(0), folder).count() == 0
    kept = corpus_pipeline.near_duplicates(spark, odd_docs, folder).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id) == [1, 3, 4, 5, 6, 7, 8, 9, 10]


BIG = (1 << 53) + 1


def beside_null(spark):
    """Ids and counts that doubles cannot hold, beside nulls in the same batch."""
    rows = [(BIG + 2 * i, f"the house stands by the river and number {i} is as long as the others are", "en", BIG) for i in range(4)]
    rows += [(None, "the house that has no number stands by the river as the others are, and is as long", "en", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").coalesce(1)


def test_large_ids_beside_null_stay_as_they_are(spark):
    docs = beside_null(spark)
    ids = {None, *(BIG + 2 * i for i in range(4))}
    labels = spark.createDataFrame([(BIG + 2 * i, i % 2, i % 2) for i in range(4)], "doc_id long, quality int, toxic int")
    for name, run in PER_DOCUMENT.items():
        assert {r.doc_id for r in run(docs, labels).collect()} == ids, name
    packed = packing.pack(docs, RANKS, public_tokenizers.PATTERN, length=64)
    assert {r.doc_id for r in packing.unpack(packed).collect()} == ids
    benchmark = spark.createDataFrame([(BIG, docs.collect()[0].text), (None, docs.collect()[4].text)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, benchmark).collect()} >= {(BIG, BIG), (None, None)}
    pages = spark.createDataFrame([(BIG, "http://a.net/"), (None, None)], "page_id long, url string").coalesce(1)
    rules = spark.createDataFrame([("block", "net", "/")], "verdict string, host string, path string")
    assert {r.page_id for r in urls.judge(pages, rules).collect()} == {BIG, None}


def test_stages_keep_whole_rows_unchanged(spark, folder):
    docs = beside_null(spark)
    rows = {tuple(r) for r in docs.collect()}
    known = langid.keep_known(docs, langid.learn(docs))
    assert {tuple(r) for r in known.collect()} == rows
    labels = spark.createDataFrame([(BIG, 1, 0)], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in quality.keep_good(docs, quality.learn(docs, labels)).collect()} == rows
    assert {tuple(r) for r in ngram_join.keep_one(docs).collect()} <= rows
    benchmark = spark.createDataFrame([(1, "nothing that any of these documents says, at some length")], "item_id long, text string")
    assert {tuple(r) for r in decontaminate.keep_clean(docs, benchmark).collect()} == rows


def test_an_id_with_several_texts_is_judged_text_by_text(spark):
    a, b = "one two three four five six seven eight nine ten", "red green blue black white grey brown pink gold teal"
    rows = [(1, a), (2, a), (2, b), (2, b), (None, a), (None, b + " x"), (None, "alone in the world as no other text is"), (3, None), (3, None)]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, a), (2, b), (None, rows[6][1]), (3, None)], key=str)


def test_linked_sets_share_an_index_entry():
    """For every threshold: two sets at it share an entry, whatever tokens are frequent."""
    rng = np.random.default_rng(5)
    for percent in range(51, 101):
        for size in (1, 2, 3, 5, 8, 20, 60, 200):
            both = -(-2 * size * percent // (100 + percent))  # the least overlap of two sets of that size
            pool = np.unique(rng.integers(0, 1 << 62, 4 * size + 8).astype(np.uint64))
            rng.shuffle(pool)
            x, y = np.sort(pool[:size]), np.sort(np.r_[pool[:both], pool[size : 2 * size - both]])
            for share in (0.0, 0.5, 1.0):
                frequent = np.sort(pool[rng.random(len(pool)) < share])
                entries = [set(ngram_join.signatures(s, frequent, percent).tolist()) for s in (x, y)]
                assert entries[0] & entries[1], (percent, size, share)
    with pytest.raises(ValueError):
        ngram_join.check_percent(50)


def test_language_stage_rejects_texts_of_no_learned_language(spark, folder, load):
    docs = load("documents")
    rng = np.random.default_rng(3)
    jumble = " ".join("".join(rng.choice(list("qxzjkwvy"), 7)) for _ in range(80))
    odd = [(-1, jumble, None, None, 0), (-2, "это предложение написано по русски и модели оно незнакомо", None, None, 0), (-3, "12 34", None, None, 0)]
    mixed = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    kept = corpus_pipeline.language(spark, mixed, folder)
    assert kept.filter("doc_id < 0").count() == 0 and kept.count() == docs.count()
