"""URL rules in a sorted digest array.

A rule is a host and a path prefix, such as ``example.net/en/``. It fits its host and all subdomains where
the URL's path starts with the rule's; of several the longest text wins, then the longest host. Rule texts lie
sorted by their 64-bit xxhash, hashes, offsets and bytes in one file, which tasks map into
memory. A URL's candidates are the ends of its host at dots with its path cut at the lengths that
rules have; a batch's candidates are hashed and probed by one binary search, and every hit is confirmed against the
stored text, so colliding hashes do no harm.

Rules come in blocks of at most ``BLOCK_ROWS``, an array each, so that no array outgrows a task.
Null URLs and those without ``://`` have empty host and path and fit no rule. Without a rule the method
allows a URL that has a host and blocks one that has none. Of rules with the same text block wins. Null rules are ignored.
"""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstat.session import scratch_dir

BLOCK_ROWS = 2_000_000
MAGIC = b"kerburl1"
URL = re.compile(r"^.*?://([^/?#]*)([^?#]*)", re.DOTALL)
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split_url(url: str | None) -> tuple[str, str]:
    found = URL.match(url) if url else None
    return (found.group(1).translate(UPPER), found.group(2)) if found else ("", "")


def pack(rules: list[tuple[str, str, str]]) -> bytes:
    """The array of ``(verdict, host, path)`` rules: sorted hashes, offsets, texts with verdicts."""
    once: dict[bytes, bytes] = {}
    for verdict, host, path in rules:
        text = (host + "\0" + path).encode("utf-8", "surrogatepass")
        if once.get(text) != b"b":
            once[text] = verdict[:1].encode()
    rows = sorted((xxhash.xxh64_intdigest(t), t, v) for t, v in once.items())
    lengths = sorted({len(t.split(b"\0", 1)[1].decode("utf-8", "surrogatepass")) for t in once})
    ends = np.cumsum([0, *(len(t) + 1 for _, t, _ in rows)]).astype("<i8")
    out = io.BytesIO()
    out.write(MAGIC + np.array([len(rows), len(lengths)], "<i8").tobytes())
    out.write(np.array(lengths, "<i8").tobytes() + np.array([h for h, _, _ in rows], "<u8").tobytes() + ends.tobytes())
    out.write(b"".join(v + t for _, t, v in rows))
    return out.getvalue()


class Digests:
    """A mapped array file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        if raw[:8].tobytes() != MAGIC:
            raise ValueError(f"{path} is no digest array")
        n, m = (int(x) for x in raw[8:24].view("<i8"))
        at = 24 + 8 * m
        self.lengths = raw[24:at].view("<i8")
        self.hashes, self.ends = raw[at : at + 8 * n].view("<u8"), raw[at + 8 * n : at + 16 * n + 8].view("<i8")
        self.texts = raw[at + 16 * n + 8 :]

    def find(self, keys: list[bytes]) -> list[bytes | None]:
        """The verdict letter of each key, or None where no stored text equals it."""
        out: list[bytes | None] = [None] * len(keys)
        if not keys or not len(self.hashes):
            return out
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        low = np.searchsorted(self.hashes, wanted, "left")
        for i in np.flatnonzero(self.hashes[np.minimum(low, len(self.hashes) - 1)] == wanted):
            at = int(low[i])
            while at < len(self.hashes) and self.hashes[at] == wanted[i]:
                text = self.texts[self.ends[at] : self.ends[at + 1]].tobytes()
                if text[1:] == keys[i]:
                    out[i] = text[:1]
                at += 1
        return out


def candidates(host: str, path: str, lengths: list[int]) -> list[tuple[str, str]]:
    """What could fit, longest text first."""
    if not host:
        return []
    dots = [i + 1 for i, c in enumerate(host) if c == "."]
    ends = [host[i:] for i in [0, *dots] if host[i:]]
    found = [(h, path[:n]) for h in ends for n in lengths if n <= len(path)]
    return sorted(found, key=lambda c: (-len(c[0]) - len(c[1]), -len(c[0])))


def ship(spark, raw: bytes) -> str:
    """Store an array in the shared folder and let Spark bring it to every executor; returns the file's name."""
    name = f"digests-{uuid.uuid4().hex}.bin"
    folder = scratch_dir(spark, "digests")
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(target)
    try:
        stream.write(bytearray(raw))
    finally:
        stream.close()
    spark.sparkContext.addFile(system.makeQualified(target).toString())  # with the scheme of the file system it lies in
    return name


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per page. ``rules`` has ``host, path, verdict``.

    Rules reach the driver a block at a time; every page is probed against every block's array.
    """
    spark = pages.sparkSession
    clean = rules.select("verdict", "host", "path").dropna().filter(F.col("verdict").isin("allow", "block"))
    blocks = max(1, -(-clean.count() // block_rows))
    number = F.pmod(F.xxhash64("host", "path"), F.lit(blocks))
    names = []
    for k in range(blocks):
        names.append(ship(spark, pack([tuple(r) for r in clean.filter(number == k).toLocalIterator()])))

    source = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = [Digests(SparkFiles.get(name)) for name in names]
        lengths = sorted({int(n) for a in arrays for n in a.lengths})
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            owners, texts = [], []
            for i, (host, path) in enumerate(parts):
                for pair in candidates(host, path, lengths):
                    owners.append(i)
                    texts.append(pair)
            keys = [f"{h}\0{p}".encode("utf-8", "surrogatepass") for h, p in texts]
            found: list[bytes | None] = [None] * len(keys)
            for array in arrays:
                found = [a or b for a, b in zip(found, array.find(keys))]
            rule: list[str | None] = [None] * len(parts)
            verdict = ["allow" if host else "block" for host, _ in parts]
            for i, pair, letter in zip(owners, texts, found):
                if letter and rule[i] is None:
                    rule[i], verdict[i] = pair[0] + pair[1], "block" if letter == b"b" else "allow"
            texts = [pa.array(x, pa.string()) for x in ([h for h, _ in parts], [p for _, p in parts], rule, verdict)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *texts], names=["page_id", "host", "path", "rule", "verdict"])

    schema = T.StructType().add("page_id", source.schema["page_id"].dataType)
    for name in ("host", "path", "rule", "verdict"):
        schema = schema.add(name, "string")
    return source.mapInArrow(run, schema)
