"""The registered queries of this subpackage, with the parameters and columns that they are held to."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstat.llm import ann, bpe, decontaminate, interpolation, langid, licenses, merkle, ngram_join, packing, quality, toxicity, trie, urls
from kerbstat.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"
PACKING_RANKS = "byte_bpe_50k.tiktoken"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [  # verdict, host, path
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.learn(docs, labels, ~held_out(labels["doc_id"], 3, 1))
    found = toxicity.detect(docs, model)
    return found.select("doc_id", held_out(found["doc_id"], 3, 1).alias("held_out"), "score", "predicted")


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(table(spark, folder, "documents"), bpe.read_spec(public_tokenizers.path(TOKENIZER)))


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_tokenizers.path(PACKING_RANKS), "rb") as file:
        return packing.pack(table(spark, folder, "documents"), file.read(), public_tokenizers.PATTERN)


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.learn(docs, ~held_out(docs["doc_id"], 3, 1))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out(found["doc_id"], 3, 1).alias("held_out"), "lang_pred", "score", "explained")


def op7_urls(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return urls.judge(table(spark, folder, "pages"), rules)


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.learn(docs, labels, ~held_out(labels["doc_id"], 4, 2))
    found = quality.classify(docs, model)
    return found.select("doc_id", held_out(found["doc_id"], 4, 2).alias("held_out"), "score", "predicted")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.link_documents(table(spark, folder, "documents"), words=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op11_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = interpolation.score_documents(docs, ~held_out(docs["doc_id"], 7, 2))
    return found.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return merkle.verify_documents(docs, F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0)


def op13_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(table(spark, folder, "conversations")))


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_bpe": op2_bpe,
        "op3_licenses": op3_licenses,
        "op4_packing": op4_packing,
        "op5_neighbours": op5_neighbours,
        "op6_language": op6_language,
        "op7_urls": op7_urls,
        "op8_quality": op8_quality,
        "op9_decontamination": op9_decontamination,
        "op10_ngram_join": op10_ngram_join,
        "op11_interpolation": op11_interpolation,
        "op12_merkle": op12_merkle,
        "op13_trie": op13_trie,
    }


def oracles() -> dict[str, str]:
    return {"op7_urls": urls_sql(), "op10_ngram_join": ngram_join_sql(), "op12_merkle": merkle_sql(), "op13_trie": trie_sql()}


def crc32_sql(text: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit: -1 stands for a step of the register."""
    steps = "flatten(list_transform(string_split(" + text + ", ''), lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda c, b: {step}), 4294967295)"


def merkle_sql(arity: int = 8, levels: int = 6, top: int = 3) -> str:
    """Every level as a table of its own; up to ``arity ** levels`` documents a language and ``arity ** top`` languages."""
    fields = ("doc_id", "source", "lang", "n_chars")
    part = lambda v: f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join([*map(part, fields), part(text)]) + ")"
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    steps = [
        f"leaves AS (SELECT doc_id, lang AS tree, {leaf('text')} AS digest, "
        f"CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf(lowered)} ELSE {leaf('text')} END AS changed FROM documents)",
        "t0 AS (SELECT doc_id, tree, digest, changed, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaves)",
    ]

    def climb(name: str, depth: int) -> None:
        for k in range(depth):
            below, both = f"{name}{k}", f"x.tree IS NOT DISTINCT FROM y.tree AND x.idx // {arity} = y.idx // {arity}"
            steps.append(
                f"{name}{k + 1} AS (SELECT tree, idx // {arity} AS idx, (n + {arity - 1}) // {arity} AS n, "
                f"CASE WHEN n = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest FROM {below} GROUP BY tree, idx // {arity}, n)"
            )
            steps.append(
                f"{name}s{k} AS (SELECT x.tree, x.idx, x.n, coalesce(string_agg(y.digest, '' ORDER BY y.idx) FILTER (y.idx < x.idx), '') AS before, "
                f"coalesce(string_agg(y.digest, '' ORDER BY y.idx) FILTER (y.idx > x.idx), '') AS after FROM {below} x JOIN {below} y ON {both} GROUP BY x.tree, x.idx, x.n)"
            )

    climb("t", levels)
    steps.append(f"r0 AS (SELECT 0 AS tree, tree AS name, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx, count(*) OVER () AS n, digest FROM t{levels})")
    climb("r", top)
    steps.append(f"p0 AS (SELECT t0.doc_id, t0.tree, t0.idx, t0.digest AS leaf, t0.changed AS folded, '' AS path, r0.idx AS place, r0.digest AS subroot FROM t0 JOIN r0 ON t0.tree IS NOT DISTINCT FROM r0.name)")
    number = 0
    for name, depth, tree, place in (("t", levels, "p.tree IS NOT DISTINCT FROM s.tree", "idx"), ("r", top, "true", "place")):
        for k in range(depth):
            steps.append(
                f"p{number + 1} AS (SELECT p.doc_id, p.tree, p.idx, p.leaf, CASE WHEN s.n = 1 THEN p.folded ELSE sha256(s.before || p.folded || s.after) END AS folded, "
                f"CASE WHEN s.n = 1 THEN p.path ELSE p.path || s.before || s.after END AS path, p.place, p.subroot "
                f"FROM p{number} p JOIN {name}s{k} s ON {tree} AND p.{place} // {arity ** k} = s.idx)"
            )
            number += 1
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT p.doc_id, p.leaf, p.subroot, r.digest AS root, sha256(p.path) AS proof_sha256, "
        f"p.folded AS folded_root, p.folded = r.digest AS verified FROM p{number} p, r{top} r"
    )


def trie_sql() -> str:
    """Every prefix of every conversation as a text of digests; each node's sums go to all of its prefixes."""
    return rf"""
WITH turns AS (
  SELECT conv_id, turn, CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '') AS body,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS BIGINT) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(sha256(body) ORDER BY turn NULLS FIRST, sha256(body)) AS digests, list(words ORDER BY turn NULLS FIRST, sha256(body)) AS words,
    {crc32_sql("CAST(any_value(conv_id) AS VARCHAR)")} % 4 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.digests, [])[:o.h], o.digests[o.h + 1:]) AS digests, list_concat(coalesce(b.words, [])[:o.h], o.words[o.h + 1:]) AS words
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
prefixes AS (
  SELECT conv_id, CAST(d AS BIGINT) AS depth, array_to_string(digests[:d], '') AS name, d = len(digests) AS ends, CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words
  FROM (SELECT *, unnest(range(0, len(digests) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT name, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY name, depth),
kids AS (SELECT left(name, CAST(64 * (depth - 1) AS BIGINT)) AS name, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
own_sums AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf, (n.n_convs - 1) * n.words AS saved
  FROM nodes n LEFT JOIN kids k USING (name, depth)),
sums AS (
  SELECT left(name, CAST(64 * up AS BIGINT)) AS name, up AS depth, CAST(sum(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM own_sums) GROUP BY ALL)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens, o.ends_sha256
FROM own_sums o JOIN sums s USING (name, depth) LEFT JOIN nodes p ON o.depth > 0 AND p.name = left(o.name, CAST(64 * (o.depth - 1) AS BIGINT)) AND p.depth = o.depth - 1"""


def ngram_join_sql(words: int = 4, percent: int = 85) -> str:
    """All pairs that share a shingle, and all that is reachable from each document; for small tables only."""
    return rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {words} THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - {words - 2}), lambda i: array_to_string(words[i:i + {words - 1}], ' '))) END AS shingles
  FROM cut),
each AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM sets s JOIN reach r ON s.doc_id = r.a GROUP BY s.doc_id, len(s.shingles)"""


def urls_sql() -> str:
    """The rules as a table; every rule is held against every page, which only a check may do."""
    rows = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in RULES)
    return rf"""
WITH rules(verdict, host, path) AS (VALUES {rows}),
parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
fits AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
  FROM parts p JOIN rules r ON ('.' || p.host) LIKE '%.' || r.host AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule,
  coalesce(f.verdict, CASE WHEN p.host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND f.place = 1"""
