"""Near copies by Jaccard similarity, found by balls over many short SimHashes.

Two texts are near copies if their sets of five-word shingles have a Jaccard
similarity of 0.8 or more. At 0.8 about 15 % of the bits of two SimHashes
differ, far more than one ball of radius 2 over 64 bits can bridge. So each set
has ``TABLES`` fingerprints of ``WIDTH`` bits, and balls of radius 2 are met in
every table (see ``balls``). What meets is ranked by all bits of both sets, and
verified on the texts themselves.

A group of copies is not expanded into pairs. In each table a set goes on with
the ``NEAREST`` sets it met that differ least; of those pairs, over all tables,
each set's ``LISTED`` nearest are listed, and rounds follow: of the pairs whose
sets aren't in one group yet, each set's ``VERIFIED`` nearest are verified, and
what is linked becomes one group, until a round links nothing or no pair is
left. So pairs stay in proportion to sets, and most groups are found. What that
leaves out, texts whose links are to others than their nearest, is made up for
by blocks (``rest``): where sets that met are still of several groups, all of
them are compared across groups. What met is told apart from what is listed:
each task answers with a star of all that met in it, whatever is listed, and
sets of a star are linked by all their bits (``clouds``). So the law is: two sets
are linked if they met in some table, differ in at most ``APART`` of all bits and
have a similarity of 0.8 or more; none of the three caps takes a link away.

Defined results: a null text counts as empty; a text of fewer words than a
shingle is one shingle; texts of one set (texts without words too) are copies;
of each group one row stays, that of the least doc_id (rows without doc_id come
last), and of several rows of that doc_id one of those with the least key of its
set; an empty table returns no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import balls
from tessera.llm.common import checkpointed, give_back
from tessera.llm.simhash import SEED, components

WORDS, SIMILAR = 5, 0.8
TABLES, WIDTH, RADIUS = 16, 40, 2
NEAREST, LISTED, VERIFIED = 2, 8, 4
#: Of all bits of two sets at most so many differ: at similarity 0.8 97 do, with a deviation of 9.
APART = 160
#: Sets of a star that differ in so few bits are told by the first of them.
CLOSE = 96
#: Sets of stars that a task compares on average.
STARS = 1 << 16
#: Distinct sets that a task's group has on average.
PER_GROUP = 1 << 19
#: Sets of a cloud that a block has on average, and shingles that are counted at once.
BLOCK, SHINGLES_AT_ONCE = 256, 4096


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of one UTF-8 text."""
    ws = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not ws:
        return np.zeros(0, np.uint64)
    joined = b" ".join(ws)
    digest = xxhash.xxh64_intdigest
    if len(ws) <= words:
        return np.array([digest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, ws), np.int64, len(ws))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(ws) - words + 1].tolist()
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())), np.uint64, len(starts)))


def prints(hashes: np.ndarray) -> np.ndarray:
    """The TABLES fingerprints of WIDTH bits of a set of hashes."""
    ones = np.zeros(TABLES * WIDTH, np.int64)
    step = np.arange(1, TABLES * WIDTH // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(hashes), 255):  # 255 ones fit into a byte
        z = hashes[at : at + 255, None] + step[None, :]  # SplitMix64
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
        ones += np.unpackbits(z.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    bits = (2 * ones > len(hashes)).reshape(TABLES, WIDTH).astype(np.int64)
    return bits @ (1 << np.arange(WIDTH, dtype=np.int64))


def _set_key(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def sets(docs: DataFrame) -> DataFrame:
    """(doc_id, set_key, prints) of every row."""
    fields = [pa.field("doc_id", pa.int64()), pa.field("set_key", pa.int64()), pa.field("prints", pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, marks = np.zeros(len(b), np.uint64), np.zeros((len(b), TABLES), np.int64)
            for i, t in enumerate(b.column(1).cast(pa.binary())):
                hashes = shingles(t.as_py() or b"")
                keys[i], marks[i] = _set_key(hashes), prints(hashes)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1, dtype=np.int32) * TABLES), pa.array(marks.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys.view(np.int64)), lists], schema=pa.schema(fields))
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, set_key long, prints array<long>")


def _nearest(a: np.ndarray, b: np.ndarray, apart: np.ndarray, most: int) -> np.ndarray:
    """Which pairs are among the ``most`` nearest of either end; of those equally
    near, the ones whose other end met the most, as an original has."""
    keep = np.zeros(len(a), bool)
    met = np.bincount(np.concatenate([a, b])) if len(a) else a
    for end, other in ((a, b), (b, a)):
        order = np.lexsort((other, -met[other], apart, end))
        ends = end[order]
        keep[order[np.arange(len(ends)) - np.searchsorted(ends, ends) < most]] = True
    return keep


def meetings(distinct: DataFrame, n: int) -> DataFrame:
    """(a, b, star) of set keys that met in some table: the nearest pairs, and
    stars of all that met in a task, each set with the least that it reaches.

    distinct: set_key, prints; n: its rows, which fix the groups.
    """

    def pairs(table: pa.Table) -> pa.Table:
        keys, at = np.unique(table.column("set_key").to_numpy(), return_index=True)
        prints = table.column("fp").to_numpy()[at].astype(np.int64).view(np.uint64)
        block, part, parts, inner = (table.column(c)[0].as_py() for c in ("block", "part", "parts", "inner"))
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

        def met() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for pair in balls.meetings(prints, WIDTH, RADIUS, block, part, parts, inner):
                held.append(pair)
                if sum(len(h[0]) for h in held[1:]) > balls.CHUNK:
                    held[:] = [_best(held, prints)]
                yield pair

        root = balls.roots(len(keys), met())
        a, b = _best(held, prints)
        held.clear()
        moved = np.flatnonzero(root != np.arange(len(keys)))
        if len(keys) > balls.SMALL:
            give_back()
        star = np.arange(len(a) + len(moved)) >= len(a)
        return pa.table({"a": keys[np.r_[a, moved]], "b": keys[np.r_[b, root[moved]]], "star": star})

    each = distinct.select("set_key", F.posexplode("prints").alias("tab", "fp"))
    dealt = balls.dealt(each, n, WIDTH, RADIUS, PER_GROUP, ("tab",))
    return dealt.groupBy("tab", *balls.GROUP).applyInArrow(pairs, "a long, b long, star boolean").distinct()


def candidates(met: DataFrame, distinct: DataFrame) -> DataFrame:
    """Pairs (a, b, apart) of those that met, with how many of all their bits differ."""
    x, y = (distinct.select(F.col("set_key").alias(k), F.col("prints").alias(f"p{k}")) for k in "ab")
    apart = F.aggregate(F.zip_with("pa", "pb", lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda s, v: s + v)
    return met.filter("NOT star").join(x, "a").join(y, "b").select("a", "b", apart.alias("apart")).filter(F.col("apart") <= APART)


def _clouds(cloud: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The least index that each set reaches by sets of its star, which are next
    to each other, that differ in at most APART bits.

    The first set of a star is compared with all. Those within APART + CLOSE are
    linked to it (a few too many, which does no harm), and those within CLOSE are
    done with: whatever is within APART of one of them has been linked too. The
    first of what is left follows.
    """
    a, b, left = [], [], np.arange(len(cloud))
    while len(left):
        begins = np.r_[True, cloud[left[1:]] != cloud[left[:-1]]]
        first = left[np.maximum.accumulate(np.where(begins, np.arange(len(left)), 0))]
        apart = np.bitwise_count(prints[left] ^ prints[first]).sum(axis=1, dtype=np.int64)
        near = ~begins & (apart <= APART + CLOSE)
        a.append(first[near])
        b.append(left[near])
        left = left[~begins & (apart > CLOSE)]
        if len(a) > 256:
            root = balls.roots(len(cloud), zip(a, b))
            moved = np.flatnonzero(root != np.arange(len(cloud)))
            a, b = [root[moved]], [moved]
    return balls.roots(len(cloud), zip(a, b))


def clouds(met: DataFrame, distinct: DataFrame) -> DataFrame:
    """Links (a, b) between sets that met, so that any two that met in some table
    and differ in at most APART of all bits reach each other."""
    stars = met.filter("star").select(F.col("b").alias("star"), F.col("a").alias("set_key"))
    every = checkpointed(stars.unionByName(stars.select("star", F.col("star").alias("set_key")).distinct()))

    def linked(table: pa.Table) -> pa.Table:
        keys, star = table.column("set_key").to_numpy(), table.column("star").to_numpy()
        prints = table.column("prints").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(keys), TABLES)
        order = np.lexsort((keys, star))
        keys = keys[order]
        root = _clouds(star[order], prints[order])
        moved = root != np.arange(len(keys))
        return pa.table({"a": keys[moved], "b": keys[root[moved]]})

    tasks = every.count() // STARS + 1
    dealt = every.join(distinct, "set_key").select("star", "set_key", "prints", F.pmod(F.xxhash64("star"), F.lit(tasks)).alias("task"))
    return dealt.groupBy("task").applyInArrow(linked, "a long, b long").distinct()


def nearest(pairs: DataFrame, most: int) -> DataFrame:
    """Those of the pairs (a, b, apart) that are among the ``most`` nearest of a,
    or of b. A set that very many are near to is cut down before the shuffle."""
    out = None
    for end, other in (("a", "b"), ("b", "a")):
        nth = F.row_number().over(Window.partitionBy(end).orderBy("apart", other))
        some = pairs.withColumn("nth", nth).filter(F.col("nth") <= most).drop("nth")
        out = some if out is None else out.unionByName(some)
    return out.distinct()


def _best(held: list[tuple[np.ndarray, np.ndarray]], prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = (np.concatenate([h[i] for h in held]).astype(np.int64) for i in (0, 1))
    codes = np.unique(np.minimum(a, b) << 32 | np.maximum(a, b))
    a, b = codes >> 32, codes & 0xFFFFFFFF
    keep = _nearest(a, b, np.bitwise_count(prints[a] ^ prints[b]), NEAREST)
    return a[keep], b[keep]


def _texts(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(set_key, text) of the sets that are needed, one text of each.

    A bitmap of 32 bits a needed set (32 MB at most) leaves out nearly all other
    texts before the shuffle, and a join the rest.
    """
    size = 1 << min(28, max(15, (32 * needed.count()).bit_length()))
    place = F.col("set_key").bitwiseAND(size - 1)
    parts = needed.select(place.alias("p")).groupBy(F.floor(F.col("p") / 32768).alias("k")).agg(F.bitmap_construct_agg(F.pmod("p", F.lit(32768))).alias("bits"))
    bitmap = np.zeros(size // 8, np.uint8)
    for r in parts.collect():
        bitmap[r.k * 4096 : (r.k + 1) * 4096] = np.frombuffer(r.bits, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.array([_set_key(shingles(t.as_py() or b"")) for t in b.column(0).cast(pa.binary())], np.uint64)
            at = (keys & np.uint64(size - 1)).astype(np.int64)
            may = pa.array((bitmap[at >> 3] >> (at & 7) & 1).astype(bool))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), b.column(0)], ["set_key", "text"]).filter(may)

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "set_key long, text string")
    # one text of a set before the shuffle, so that a set that very many texts have is no large group
    return rows.groupBy("set_key").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).join(needed, "set_key", "left_semi")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets have a similarity of SIMILAR or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())):
                x, y = shingles(x.as_py()), shingles(y.as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= SIMILAR * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        give_back()

    left = pairs.select("a", "b").join(texts.select(F.col("set_key").alias("a"), F.col("text").alias("x")), "a")
    full = left.join(texts.select(F.col("set_key").alias("b"), F.col("text").alias("y")), "b")
    return full.select(F.col("a").alias("src"), F.col("b").alias("dst"), "x", "y").mapInArrow(run, "src long, dst long")


def links(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, root) of the sets that are linked, by rounds over the pairs."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set_key")).distinct()
    texts = checkpointed(_texts(docs, checkpointed(ends)))
    left, of = pairs, None
    while True:
        now = checkpointed(nearest(left, VERIFIED))
        new = checkpointed(verified(now, texts))
        if of is not None and new.isEmpty():
            return of
        of = checkpointed(components(new if of is None else of.select(F.col("node").alias("src"), F.col("root").alias("dst")).unionByName(new)))
        ra, rb = of.select(F.col("node").alias("a"), F.col("root").alias("ra")), of.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        apart = left.join(now.select("a", "b"), ["a", "b"], "left_anti").join(ra, "a", "left").join(rb, "b", "left")
        left = checkpointed(apart.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b", "apart"))
        if left.isEmpty():
            return of


def _alike(table: pa.Table) -> pa.Table:
    """Links (src, dst), as stars, between the sets of a pair of blocks that are
    similar enough and not of one group yet: (own block, root, hashes)."""
    keys, root = table.column("set_key").to_numpy(), table.column("root").to_numpy()
    _, group = np.unique(root, return_inverse=True)
    sets_ = [np.frombuffer(h.as_py(), np.uint64) for h in table.column("hashes")]
    size = np.array([len(x) for x in sets_], np.int64)
    flat = np.concatenate(sets_) if len(sets_) else np.zeros(0, np.uint64)
    _, shingle, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1  # only what several sets have can be common
    of = np.repeat(np.arange(len(sets_)), size)
    use = times[shingle] > 1
    of, shingle = of[use], shared[shingle[use]]
    order = np.argsort(shingle, kind="stable")
    of, shingle = of[order], shingle[order]
    common = np.zeros((len(sets_), len(sets_)), np.float32)
    for at in range(0, int(shingle[-1]) + 1 if len(shingle) else 0, SHINGLES_AT_ONCE):
        low, high = np.searchsorted(shingle, [at, at + SHINGLES_AT_ONCE])
        part = np.zeros((len(sets_), SHINGLES_AT_ONCE), np.float32)
        part[of[low:high], shingle[low:high] - at] = 1
        common += part @ part.T
    similar = common >= SIMILAR * (size[:, None] + size[None, :] - common) - 1e-3
    similar &= group[:, None] != group[None, :]
    a, b = np.nonzero(np.triu(similar, 1))
    # single precision has let through what comes near: whole numbers decide
    both = np.rint(common[a, b]).astype(np.int64)
    right = both >= SIMILAR * (size[a] + size[b] - both)
    a, b = a[right], b[right]
    at = balls.roots(len(sets_), iter([(a, b)]))
    moved = at != np.arange(len(sets_))
    return pa.table({"src": keys[moved], "dst": keys[at[moved]]})


def rest(of: DataFrame, met: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between groups that what was listed doesn't tell: the exact way.

    Sets that met, directly or by way of others (``clouds``), are a cloud. In a cloud of
    several groups every set is compared with every one of another group, by
    blocks: sets are dealt to blocks of some ``BLOCK`` by their key, each pair of
    blocks is a task, and a task answers with a spanning star of what it linked.
    A set of a cloud of m sets is sent to m / BLOCK tasks.
    """
    met = components(met.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    root = of.select("node", F.col("root").alias("group"))
    ends = met.select("node", F.col("root").alias("cloud"))
    every = ends.unionByName(ends.select(F.col("cloud").alias("node"), "cloud").distinct()).join(root, "node", "left")
    every = checkpointed(every.select(F.col("node").alias("set_key"), "cloud", F.coalesce("group", "node").alias("root")))
    sizes = every.groupBy("cloud").agg(F.count("*").alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    members = checkpointed(every.join(sizes.select("cloud", F.ceil(F.col("m") / BLOCK).alias("blocks")), "cloud"))
    if members.isEmpty():
        return members.select(F.col("set_key").alias("src"), F.col("root").alias("dst"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = pa.array([shingles(t.as_py()).tobytes() for t in b.column(1).cast(pa.binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), each], ["set_key", "hashes"])

    hashes = _texts(docs, members.select("set_key")).mapInArrow(hashed, "set_key long, hashes binary")
    own = F.pmod(F.xxhash64("set_key"), F.col("blocks"))
    dealt = members.join(checkpointed(hashes), "set_key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    tasks = dealt.select("cloud", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "set_key", "root", "hashes")
    return tasks.groupBy("cloud", "i", "j").applyInArrow(_alike, "src long, dst long").distinct()


def groups(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """(set_key, root) of every distinct set in rows, which are those of sets()."""
    distinct = checkpointed(rows.groupBy("set_key").agg(F.first("prints").alias("prints")))
    met = checkpointed(meetings(distinct, distinct.count()))
    of = links(docs, checkpointed(nearest(candidates(met, distinct), LISTED)))
    more = checkpointed(rest(of, clouds(met, distinct), docs))
    if not more.isEmpty():
        of = components(of.select(F.col("node").alias("src"), F.col("root").alias("dst")).unionByName(more))
    return distinct.select("set_key").join(of.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay: one of each group of near copies.

    Where a doc_id has one row, rows are chosen by it; the rows of the others,
    and those without doc_id, by doc_id and set.
    """
    rows = checkpointed(sets(docs))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.col("set_key"))).alias("x")
    keep = rows.select("doc_id", "set_key").join(groups(rows, docs), "set_key").groupBy("root").agg(least)
    keep = checkpointed(keep.select("x.doc_id", "x.set_key"))
    doubtful = checkpointed(rows.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").select("doc_id"))
    plain = docs.join(keep.join(doubtful, "doc_id", "left_anti").filter("doc_id IS NOT NULL").select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    if doubtful.isEmpty():
        return plain

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.array([_set_key(shingles(t.as_py() or b"")) for t in b.column(0).cast(pa.binary())], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys.view(np.int64))], ["text", "set_key"])

    d = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("t"))
    d = d.join(doubtful, F.col("id").eqNullSafe(doubtful["doc_id"]), "left_semi")
    k = d.select(F.col("t").alias("text")).distinct().mapInArrow(keyed, "text string, set_key long")
    d = d.join(k, F.col("t").eqNullSafe(k["text"])).select("row", "id", "set_key")
    d = d.join(keep, F.col("id").eqNullSafe(keep["doc_id"]) & (d["set_key"] == keep["set_key"]), "left_semi")
    return plain.unionByName(d.dropDuplicates(["id", "set_key"]).select("row.*"))
