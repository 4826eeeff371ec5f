"""Merkle dataset manifest by event-driven combineByKey.

Each row is a leaf. The leaves of a group (``lang``) are in order of their id;
every 8 consecutive nodes have a parent, until one is left, the group's subroot;
the subroots of all groups have the root the same way.

Leaves are numbered by a range partition and the counts of what lies before, so
no group is sorted in one task. A node's number and its group's size tell how
many children its parent has. Digests are events: a partial parent gathers
indexed child digests, and when it has them all it becomes an event for its own
parent, at once and in the same task (``absorb``). What a task can't resolve is
its frontier, a few partial parents a level; frontiers are merged by combineByKey
over their keys, dealt by a common ancestor some levels up, until none is left.
The links from parents to their children, followed back from the root, give each
block of leaves its way up; the rest of a proof is made within the block.

H is the lowercase hex SHA-256 of its inputs, concatenated. A leaf's inputs are
its columns, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself.

Defined results: a null group is one of its own and first, groups follow one
another bytewise; a null id comes first in its group; leaves of one id are
ordered by their digest, and equal rows are different leaves; an empty table
gives no rows; columns not named aren't read, and a column that is missing is an
error.
"""

from __future__ import annotations

import hashlib
import string
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, scratch_path

ARITY_BITS = 3
ARITY = 1 << ARITY_BITS
#: Leaves of so many levels, ARITY ** BLOCK of them, are proved in one task.
BLOCK = 4
#: Frontiers are dealt by their ancestor so many levels up.
CLIMB = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """How many levels a tree over n leaves has above them."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def arity(n: int, level: int, index: int) -> int:
    """How many children the node ``index`` of a level has in a tree over n leaves."""
    below = n
    for _ in range(level - 1):
        below = -(-below // ARITY)
    return min(ARITY, below - index * ARITY)


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: Sequence[Column]) -> Column:
    return F.sha2(F.encode(F.concat(*[field(c) for c in columns]), "UTF-8"), 256)


def _kept(rows: DataFrame, name: str) -> DataFrame:
    """rows written to the shared folder and read again."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows (grp, ...) + n, index: how many rows the group has, and a row's place
    in the group's order, from 0. Equal rows get places of their own, and a
    large group, or many rows of one id, are dealt to many tasks."""
    tied = _kept(rows.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    ranged = _kept(tied.repartitionByRange("grp", *order, "tie").withColumn("part", F.spark_partition_id()), "ranged")
    parts = ranged.groupBy("grp", "part").count()
    before = F.sum("count").over(Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("grp", "part", F.coalesce(before, F.lit(0)).alias("start"), F.sum("count").over(Window.partitionBy("grp")).alias("n"))
    within = F.row_number().over(Window.partitionBy("grp", "part").orderBy(*order, "tie"))
    return ranged.join(starts, ["grp", "part"]).withColumn("index", F.col("start") + within - 1).drop("start", "tie", "part")


#: A node, or where digest is null a partial one; its children's slots and digests.
NODE = "grp string, n long, level int, index long, slots array<int>, children array<string>, digest string"
Key = tuple[str, int, int, int]


def absorb(events: Iterable[tuple[Key, dict[int, str]]]) -> Iterator[tuple]:
    """Rows of NODE from partial parents ((grp, n, level, index), slot: digest).
    A parent that is complete is emitted and becomes an event for its own
    parent; what isn't complete at the end follows as the frontier."""
    pending: dict[Key, dict[int, str]] = {}
    for key, part in events:
        while True:
            held = pending.setdefault(key, {})
            held.update(part)
            grp, n, level, index = key
            if len(held) < arity(n, level, index):
                break
            children = [held[i] for i in range(len(held))]
            digest = sha(children)
            del pending[key]
            yield (*key, list(range(len(held))), children, digest)
            if level == height(n):
                break
            key, part = (grp, n, level + 1, index >> ARITY_BITS), {index & (ARITY - 1): digest}
    for key, held in pending.items():
        yield (*key, list(held), list(held.values()), None)


def _merge(a: dict[int, str], b: dict[int, str]) -> dict[int, str]:
    a.update(b)
    return a


def _dealt_by(low: int):
    """Deals keys by their ancestor CLIMB levels above the lowest that is open."""

    def place(key: Key) -> int:
        grp, n, level, index = key
        return zlib.crc32(f"{grp}/{index >> ARITY_BITS * max(0, low + CLIMB - level)}".encode())

    return place


def nodes(leaves: DataFrame) -> DataFrame:
    """NODE rows of all inner nodes over leaves (grp, n, index, digest)."""
    spark = leaves.sparkSession

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def events() -> Iterator[tuple[Key, dict[int, str]]]:
            for b in batches:
                for grp, n, index, digest in zip(*(c.to_pylist() for c in b.columns)):
                    if n > 1:
                        yield (grp, n, 1, index >> ARITY_BITS), {index & (ARITY - 1): digest}

        held = []
        for row in absorb(events()):
            held.append(row)
            if len(held) == 4096:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)

    done = _kept(leaves.select("grp", "n", "index", "digest").mapInArrow(first, NODE), "nodes")
    found = done.filter("digest IS NOT NULL")
    while True:
        frontier = done.filter("digest IS NULL")
        size = frontier.agg(F.count("*").alias("n"), F.min("level").alias("low")).first()
        if not size.n:
            return found
        partial = frontier.select("grp", "n", "level", "index", "slots", "children").rdd.map(lambda r: ((r[0], r[1], r[2], r[3]), dict(zip(r[4], r[5]))))
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        merged = partial.combineByKey(dict, _merge, _merge, numPartitions=width, partitionFunc=_dealt_by(size.low))
        done = _kept(spark.createDataFrame(merged.mapPartitions(absorb), NODE), "nodes")
        found = found.unionByName(done.filter("digest IS NOT NULL"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["grp", "n", "level", "index", "slots", "children", "digest"])


def levels(n: Column) -> Column:
    """height(n) as a column: n - 1 in base ARITY has that many digits."""
    digits = F.ceil(F.length(F.bin(n - 1)) / float(ARITY_BITS)).cast("int")
    return F.when(n > 1, digits).otherwise(0)


#: One step of a way up: the own slot and the digests of the others in the run.
STEP = "struct<slot: int, others: array<string>>"


def ways(inner: DataFrame, groups: DataFrame, level: int) -> DataFrame:
    """(grp, index, way array<STEP>): how one gets from each node of a level to
    its group's root; for a group that is no higher than that, from index 0 by
    no step. groups: grp, n, way: what follows after the group's root.

    Links are followed from the parents back to their children.
    """
    tops = groups.select("grp", "way", levels(F.col("n")).alias("top"))
    highest = tops.agg(F.max("top")).first()[0] or 0
    here = tops.filter(F.col("top") <= level).select("grp", F.lit(0).cast("long").alias("index"), "way")
    down = None
    for at in range(highest, level, -1):
        starts = tops.filter(F.col("top") == at).select("grp", F.lit(0).cast("long").alias("index"), "way")
        down = starts if down is None else down.unionByName(starts)
        links = inner.filter(F.col("level") == at).select("grp", "index", "children")
        each = links.join(down, ["grp", "index"]).select("grp", "index", "way", "children", F.posexplode("children").alias("slot", "own"))
        others = F.filter("children", lambda c, i: i != F.col("slot"))
        step = F.struct(F.col("slot").alias("slot"), others.alias("others"))
        down = _kept(each.select("grp", (F.col("index") * ARITY + F.col("slot")).alias("index"), F.concat(F.array(step), "way").alias("way")), "ways")
    return here if down is None else here.unionByName(down)


def fold(digest: str, way: Iterable[tuple[int, list[str]]]) -> str:
    """The root that a digest has by a way up."""
    for slot, others in way:
        digest = sha([*others[:slot], digest, *others[slot:]])
    return digest


def block_ways(digests: list[str], high: int) -> list[list[tuple[int, list[str]]]]:
    """The way of each leaf of a block up to the block's root, so many levels
    high: the last block of a group can be down to one node some levels earlier."""
    out: list[list] = [[] for _ in digests]
    level, span = digests, 1
    for _ in range(high):
        for i in range(len(digests)):
            at = i // span
            run = level[at // ARITY * ARITY : at // ARITY * ARITY + ARITY]
            slot = at % ARITY
            out[i].append((slot, run[:slot] + run[slot + 1 :]))
        level, span = [sha(level[i : i + ARITY]) for i in range(0, len(level), ARITY)], span * ARITY
    return out


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _proved(mine: pa.Table, up: pa.Table) -> pa.Table:
    """The rows of one block of leaves, with the block's way up."""
    mine = mine.sort_by("index")
    digests, tampered = mine.column("digest").to_pylist(), mine.column("tampered").to_pylist()
    above = [(s["slot"], s["others"]) for s in up.column("way")[0].as_py()]
    tail = "".join(d for _, others in above for d in others)
    roots: dict[str, str] = {}
    proofs, folded = [], []
    for own, other, way in zip(digests, tampered, block_ways(digests, up.column("high")[0].as_py())):
        proofs.append(sha([*(d for _, others in way for d in others), tail]))
        top = fold(own if other is None else other, way)
        if top not in roots:
            roots[top] = fold(top, above)
        folded.append(roots[top])
    same = [pa.array([up.column(c)[0].as_py()] * len(digests), pa.string()) for c in ("subroot", "root")]
    names = [x.split(" ")[0] for x in PROOF.split(", ")]
    return pa.table([mine.column("doc_id"), mine.column("digest"), *same, pa.array(proofs, pa.string()), pa.array(folded, pa.string())], names)


def tampered_text(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """PROOF rows of every row of docs. tampered: of which rows the root is
    folded from a leaf whose text has A-Z lower-cased; none by default."""
    columns = {c: F.col(c) for c in COLUMNS}
    changed = leaf([*list(columns.values())[:-1], tampered_text(F.col("text"))])
    group = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))  # null first, then bytewise
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), group.alias("grp"), leaf(list(columns.values())).alias("digest"), F.when(tampered if tampered is not None else F.lit(False), changed).alias("tampered"))
    leaves = _kept(numbered(rows, ["doc_id", "digest"]), "numbered")
    inner = nodes(leaves)
    # subroots are the leaves of the tree above
    whole = inner.filter((F.col("index") == 0) & (F.col("level") == levels(F.col("n")))).select("grp", "n", "digest")
    subroots = whole.unionByName(leaves.filter("n = 1").select("grp", "n", "digest"))
    upper = _kept(numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("own"), F.col("n").alias("size"), "digest"), ["own"]), "numbered")
    upper_inner = nodes(upper)
    one = upper.filter("n = 1").select("digest").unionByName(upper_inner.filter((F.col("index") == 0) & (F.col("level") == levels(F.col("n")))).select("digest"))
    root = one.select(F.max("digest")).first()[0]
    none = F.from_json(F.lit("[]"), f"array<{STEP}>")
    top = ways(upper_inner, upper.filter("index = 0").select("grp", "n", none.alias("way")), 0)
    groups = _kept(upper.select("index", F.col("own").alias("grp"), F.col("size").alias("n"), F.col("digest").alias("subroot")).join(top.select("index", "way"), "index").select("grp", "n", "subroot", "way"), "groups")
    high = F.least(levels(F.col("n")), F.lit(BLOCK)).alias("high")
    blocks = ways(inner, groups.select("grp", "n", "way"), BLOCK).join(groups.select("grp", "subroot", high), "grp").withColumn("root", F.lit(root))
    mine = leaves.select("grp", F.shiftright("index", ARITY_BITS * BLOCK).alias("block"), "index", "doc_id", "digest", "tampered")
    up = blocks.select("grp", F.col("index").alias("block"), "way", "subroot", "root", "high")
    return mine.groupBy("grp", "block").cogroup(up.groupBy("grp", "block")).applyInArrow(_proved, PROOF)
