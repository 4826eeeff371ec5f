"""Ball hashing against all pairs by brute force."""

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tessera.llm import balls, simhash


def brute_fingerprint(text, words=4):
    ws = text.encode().lower().split()
    if not ws:
        return 0
    grams = [b" ".join(ws[i : i + words]) for i in range(len(ws) - words + 1)] or [b" ".join(ws)]
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints, most):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_matches_brute_force(awkward, nothing):
    rows = awkward.collect()
    prints = [brute_fingerprint(r.text or "") for r in rows]
    want = sorted(zip([r.doc_id for r in rows], prints, brute_components([r.doc_id for r in rows], prints, 4)), key=str)
    got = sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in simhash.near_duplicates(awkward).collect()), key=str)
    assert got == want
    assert simhash.near_duplicates(nothing).count() == 0


def test_spark_hash_is_the_same(spark):
    text = "one two three four"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64) == simhash.simhash(text.encode())


def clustered():
    """Fingerprints with others at 1 to 6 bits from them, and what links them."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.int64)
    prints = set(base.tolist())
    for f in base[:25].tolist():
        for k in range(1, 7):
            g = f
            for b in rng.choice(63, k, replace=False).tolist():
                g ^= 1 << b
            prints.add(g)
    prints = sorted(prints)
    return np.array(prints, dtype=np.int64).view(np.uint64), brute_components(list(range(len(prints))), prints, 4)


@pytest.mark.parametrize("chunk", [300, 1 << 21])
@pytest.mark.parametrize("parts", [0, 3])
def test_meetings_reach_every_pair_within_the_radius(monkeypatch, chunk, parts):
    fps, want = clustered()
    monkeypatch.setattr(balls, "CHUNK", chunk)
    pairs = [p for part in range(1 << parts) for p in balls.meetings(fps, 64, 2, -1, part, parts)]
    assert all((np.bitwise_count(fps[a] ^ fps[b]) <= 4).all() for a, b in pairs)
    assert balls.roots(len(fps), iter(pairs)).tolist() == want


def test_meetings_where_hashes_collide(monkeypatch):
    """With a multiplier of nil all values have one hash."""
    fps, want = clustered()
    monkeypatch.setattr(balls, "MULTIPLIER", np.uint64(0))
    pairs = [(a[k], b[k]) for a, b in balls.meetings(fps, 64, 2, -1) for k in [np.bitwise_count(fps[a] ^ fps[b]) <= 4]]
    assert balls.roots(len(fps), iter(pairs)).tolist() == want


@pytest.mark.parametrize("per_group", [4, 40, 1 << 14])
def test_links_however_fingerprints_are_dealt(spark, monkeypatch, per_group):
    """Small groups are dealt by block, and those that are large cut into parts."""
    fps, want = clustered()
    monkeypatch.setattr(simhash, "PER_GROUP", per_group)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fingerprint long")
    at = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    pairs = [(at[r.src], at[r.dst]) for r in simhash.ball_links(df, len(fps)).collect()]
    a, b = np.array(pairs).T
    assert balls.roots(len(fps), iter([(a, b)])).tolist() == want


def test_clustered_fingerprints_have_few_copies(spark):
    """Fingerprints that agree in the leading bits of four blocks: of each a few
    copies, in groups that a task can hold, and every close pair meets in one."""
    rng, n = np.random.default_rng(12), 400_000
    heads = sum(((1 << 5) - 1) << (high - 5) for _, high in balls.blocks(64, 2)[:4])
    fps = np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64) & ~np.int64(heads))
    df = spark.createDataFrame([], "fp long").unionByName(spark.createDataFrame(pa.table({"fp": fps})))
    dealt = balls.dealt(df, len(fps), 64, 2, 1 << 14).groupBy(*balls.GROUP).agg(F.count("*").alias("n"))
    total, largest = dealt.agg(F.sum("n"), F.max("n")).first()
    assert total <= 21.5 * len(fps) and largest <= 4 << 14
    near = fps[:300].copy()
    for i in range(len(near)):
        for b in rng.choice(63, 4, replace=False).tolist():
            near[i] ^= 1 << b
    pairs = spark.createDataFrame([(i, int(x)) for i, two in enumerate(zip(fps[:300], near)) for x in two], "pair int, fp long")
    # dealt together with all others, so that groups are as large as theirs
    group = balls.dealt(pairs.unionByName(df.withColumn("pair", F.lit(-1))), len(fps), 64, 2, 1 << 14).filter("pair >= 0")
    met = group.groupBy("pair", *balls.GROUP).count().filter("count = 2").select("pair").distinct()
    assert met.count() == 300


def test_components_of_long_chains(spark):
    edges = spark.range(300).select((F.col("id") * 7 % 301).alias("src"), ((F.col("id") + 1) * 7 % 301).alias("dst"))
    assert {r.root for r in simhash.components(edges).collect()} == {0}
