"""The near-dedup stage against Jaccard similarity by brute force."""

import random
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from conftest import SCHEMA
from tessera.llm import near


def brute_kept(rows, words=5, similar=0.8):
    """doc_ids of the least row of each group of texts linked at ``similar``."""
    ws = [(t or "").encode().lower().split() for _, t in rows]
    sets = [{tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} for w in ws]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and both >= similar * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {d for i, (d, _) in enumerate(rows) if find(i) == i}


def kept(spark, rows):
    docs = spark.createDataFrame([(d, t, "en", "a", len(t or ""), "x", 1, 2) for d, t in rows], SCHEMA).repartition(3)
    return corpus_pipeline.near_stage(spark, docs, "").collect()


def planted(seed=3, groups=40):
    """Groups of edited copies, at Jaccard 0.7 to 0.97 of their original."""
    rnd = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(60, 400))]
        texts.append(base)
        for _ in range(rnd.randint(1, 3)):
            near = list(base)
            for _ in range(max(1, int(len(base) * rnd.uniform(0.003, 0.03)))):
                near[rnd.randrange(len(near))] = f"edit{rnd.randrange(10**6)}"
            texts.append(near)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_keeps_one_of_each_group_at_jaccard_0_8(spark):
    rows = planted()
    got, right = {r.doc_id for r in kept(spark, rows)}, brute_kept(rows)
    assert right <= got
    assert len(got - right) <= 0.02 * (len(rows) - len(right))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_keeps_one_of_each_group_of_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    got = {r.doc_id for r in corpus_pipeline.near_stage(spark, docs, "").select("doc_id").collect()}
    assert got == brute_kept(sorted((r.doc_id, r.text) for r in docs.collect()))


def test_a_large_group_is_one(spark):
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(w if k != at else f"x{i}" for k, w in enumerate(base))) for i, at in enumerate(rnd.randrange(200) for _ in range(300))]
    assert [r.doc_id for r in kept(spark, rows)] == [0]


def test_rows_without_doc_id(spark):
    rows = [(None, "alone without a name"), (None, "alone without a name"), (None, "this one has a named copy"), (7, "This one has a named COPY"), (None, None), (None, " ")]
    got = kept(spark, rows)
    assert sorted(((r.doc_id, (r.text or "").strip()) for r in got), key=str) == sorted([(7, "This one has a named COPY"), (None, "alone without a name"), (None, "")], key=str)


def test_rows_that_repeat_a_doc_id(spark):
    """Which row stays is told by its set too, and one of equal rows stays."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    near = " ".join([*base[:50], "other", *base[51:]])
    base, apart = " ".join(base), " ".join(f"v{rnd.randrange(999)}" for _ in range(80))
    got = kept(spark, [(1, base), (1, apart), (2, near), (5, apart), (1, apart)])
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(1, base), (1, apart)])
    got = kept(spark, [(None, base), (None, near), (None, near)])
    assert len(got) == 1


def test_copies_around_one_text(spark):
    """Copies that are near their original, but not near one another."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        text = list(base)
        for at in rnd.sample(range(0, 150, 9), 2):
            text[at] = f"x{i}"
        rows.append((i, " ".join(text)))
    assert {r.doc_id for r in kept(spark, rows)} == brute_kept(rows)


@pytest.mark.parametrize("block", [16, 256])
def test_a_cloud_of_many_groups(spark, monkeypatch, block):
    """Copies of one text that isn't there: alike enough to meet, but linked here and there only."""
    monkeypatch.setattr(near, "BLOCK", block)
    rnd = random.Random(10)
    base, rows = [f"w{i}" for i in range(160)], []
    for i in range(260):
        text = list(base)
        for at in rnd.sample(range(0, 160, 6), rnd.randint(2, 4)):
            text[at] = f"x{rnd.randrange(40)}"
        rows.append((i, " ".join(text)))
    want = brute_kept(rows)
    assert 20 < len(want) < 240
    assert {r.doc_id for r in kept(spark, rows)} == want


@pytest.mark.parametrize("per_group", [near.PER_GROUP, 3])
def test_a_link_behind_nearer_strangers(spark, monkeypatch, per_group):
    """Two near copies meet in one table, where strangers are nearer to both: more
    of them than are listed, and none within APART bits over all tables. One task a
    table, and tables dealt by blocks."""
    monkeypatch.setattr(near, "PER_GROUP", per_group)
    rnd = random.Random(12)
    flip = lambda p, bits: [v ^ sum(1 << k for k in bits[t]) for t, v in enumerate(p)]
    one = [rnd.getrandbits(near.WIDTH) for _ in range(near.TABLES)]
    two = flip(one, [range(20, 24)] + [rnd.sample(range(near.WIDTH), 8) for _ in range(near.TABLES - 1)])
    marks = [one, two]
    for p in (one, two):
        for k in range(6):
            marks.append([p[0] ^ 1 << k] + [rnd.getrandbits(near.WIDTH) for _ in range(near.TABLES - 1)])
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base), " ".join([*base, "and", "more"])] + [" ".join(f"v{rnd.randrange(10**6)}" for _ in range(50)) for _ in marks[2:]]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t), "x", 1, 2) for i, t in enumerate(texts)], SCHEMA)
    keys = {r.doc_id: r.set_key for r in near.sets(docs).collect()}
    rows = spark.createDataFrame([(i, keys[i], m) for i, m in enumerate(marks)], "doc_id long, set_key long, prints array<long>")
    root = {r.set_key: r.root for r in near.groups(rows, docs).collect()}
    assert root[keys[0]] == root[keys[1]] and len(set(root.values())) == len(texts) - 1


def test_clouds_against_all_pairs():
    """Sets of stars reach each other where they differ in at most APART bits."""
    rng = np.random.default_rng(13)
    centre = rng.integers(0, 1 << near.WIDTH, (12, near.TABLES), dtype=np.uint64)
    prints = np.concatenate([centre[rng.integers(0, 12, 700)] for _ in range(2)])
    for most in (0, 1, 2, 5, 8):  # bits of a table that are changed, by row
        some = np.flatnonzero(rng.integers(0, 5, len(prints)) == most % 5)
        for _ in range(most):
            prints[some] ^= np.uint64(1) << rng.integers(0, near.WIDTH, (len(some), near.TABLES), dtype=np.uint64)
    star = np.sort(rng.integers(0, 30, len(prints)))
    root = near._clouds(star, prints)
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :]).sum(axis=2, dtype=np.int64)
    right = (star[:, None] == star[None, :]) & (apart <= near.APART)
    assert (root[:, None] == root[None, :])[right].all() and (star[root] == star).all()
    far = (star[:, None] == star[None, :]) & (root[:, None] != root[None, :])
    assert far.any() and (apart[far] > near.APART).all() and 30 < len(set(root.tolist())) < 1000
