"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most 4 bits exactly if their balls of radius 2
share a value. Distinct fingerprints are dealt to tasks and their variants are
written out and brought together there (see ``balls``); every pair that meets is
verified. Each task answers with a spanning star of what it linked, so no group
is ever expanded into pairs; connected components over those stars follow in
Spark.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and links like any other; repeated rows return repeated rows;
rows without doc_id take part, and a component of such rows only has a null
component_id; an empty table returns no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import balls
from tessera.llm.common import checkpointed, give_back

BITS = 64
SEED = 42
#: Shingles hashed at once, and fingerprints that a group of a task has on average.
AT_ONCE = 1 << 16
PER_GROUP = 1 << 14


def simhash(text: bytes, words: int = 4) -> int:
    """Fingerprint of one UTF-8 text (see the module for the rules)."""
    ws = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = (ends - np.fromiter(map(len, ws), np.int64, len(ws)))[: len(ws) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    n, ones = len(starts), np.zeros(BITS, np.int64)
    for at in range(0, n, AT_ONCE):
        stop = at + AT_ONCE
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:stop], ends[at:stop])], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            out = np.fromiter((simhash(t.as_py() or b"", words) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out.view(np.int64))], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint long")


def ball_links(distinct: DataFrame, n: int, radius: int = 2) -> DataFrame:
    """Star links (src, dst) among distinct fingerprints within 2*radius bits.

    distinct: a column ``fingerprint``; n: its rows, which fix the groups.
    """

    def links(table: pa.Table) -> pa.Table:
        fps = np.sort(table.column("fp").to_numpy()).view(np.uint64)
        block, part, parts, inner = (table.column(c)[0].as_py() for c in ("block", "part", "parts", "inner"))
        # what meets is verified pair by pair
        near = ((a[k], b[k]) for a, b in balls.meetings(fps, BITS, radius, block, part, parts, inner) for k in [np.bitwise_count(fps[a] ^ fps[b]) <= 2 * radius])
        root = balls.roots(len(fps), near)
        moved = root != np.arange(len(fps))
        signed = fps.view(np.int64)
        if len(fps) > balls.SMALL:
            give_back()
        return pa.table({"src": signed[moved], "dst": signed[root[moved]]})

    dealt = balls.dealt(distinct.select(F.col("fingerprint").alias("fp")), n, BITS, radius, PER_GROUP)
    return dealt.groupBy(*balls.GROUP).applyInArrow(links, "src long, dst long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node that each linked node reaches.

    Alternating large-star and small-star rounds; each halves what is left of
    the paths, and each is cut by a reliable checkpoint.
    """
    edges = checkpointed(links.filter("src <> dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct())
    while True:
        # done when all edges lead from a node to a root of its own and no root leads on
        sizes = edges.agg(F.count("*"), F.countDistinct("a")).first()
        if sizes[0] == sizes[1] and edges.select(F.col("b").alias("a")).join(edges, "a", "left_semi").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # read from where it was written, so that Spark can split the edges of a root that very many have
        least = checkpointed(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a")
        edges = checkpointed(small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint long, component_id) of every row: texts whose
    fingerprints differ in at most 2*radius bits, directly or by way of others,
    share the least doc_id among them."""
    prints = checkpointed(fingerprints(docs, words, id_col, text_col))
    distinct = checkpointed(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    roots = components(ball_links(distinct.select("fingerprint"), distinct.count(), radius))
    linked = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    named = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = linked.select("fingerprint", "root").join(named, "root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")
