"""The Merkle manifest against a tree built in one place."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tessera.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, index int, leaf string"
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    put = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(*(put(v) for v in row))


def tree(leaves):
    """The root, and each leaf's way: (slot, siblings) level by level."""
    ways, span, level = [[] for _ in leaves], 1, list(leaves)
    while len(level) > 1:
        for i, way in enumerate(ways):
            at = i // span
            lo = at // 8 * 8
            run = level[lo : lo + 8]
            way.append((at - lo, run[: at - lo] + run[at - lo + 1 :]))
        level, span = [sha(*level[i : i + 8]) for i in range(0, len(level), 8)], span * 8
    return level[0], ways


def climb(digest, way):
    for slot, others in way:
        digest = sha(*others[:slot], digest, *others[slot:])
    return digest


def brute(rows, tampered):
    by = defaultdict(list)
    for d, text, lang, source, n in rows:
        low = text.translate(LOWER) if text is not None else None
        by[lang].append(((d is not None, d), leaf((d, source, lang, n, text)), leaf((d, source, lang, n, low)), d))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        by[g].sort(key=lambda x: (x[0][0], x[3] or 0, x[1]))
        trees[g] = tree([x[1] for x in by[g]])
    root, tops = tree([trees[g][0] for g in langs])
    out = Counter()
    for g, top in zip(langs, tops):
        for (_, own, low, d), way in zip(by[g], trees[g][1]):
            way = [*way, *top]
            folded = climb(low if d is not None and tampered(d) else own, way)
            out[d, own, trees[g][0], root, sha(*(x for _, others in way for x in others)), folded] += 1
    return out


def awkward(n, seed=2):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["Abc", "abc", None, "", "ÄÖ " * 5]), rnd.choices(["en", "de", None, "é", "zh"], [70, 20, 5, 4, 1])[0], rnd.choice(["a", None]), rnd.choice([1, None])) for i in range(n)]
    rows += [(5, "Twice", "en", "a", 1)] * 40 + [(None, "x", "en", "a", 1), (None, "y", None, None, None), (3, "Long " * 30000, "en", "a", 1), (7, "alone", "lone", "a", 1)]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "g", 1, "x") for r in rows], SCHEMA)


@pytest.mark.parametrize(("n", "block", "climb_by"), [(0, 4, 4), (300, 4, 4), (700, 1, 1), (700, 2, 4)])
def test_manifest_matches_one_tree(spark, monkeypatch, n, block, climb_by):
    monkeypatch.setattr(manifest, "BLOCK", block)
    monkeypatch.setattr(manifest, "CLIMB", climb_by)
    rows = awkward(n)
    got = manifest.manifest(frame(spark, rows).repartition(5), F.col("doc_id") % 3 == 0)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, lambda d: d % 3 == 0)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_one_group_of_any_size(spark, n):
    rows = [(i, f"t{i}", "en", "a", 1) for i in range(n)]
    assert Counter(tuple(r) for r in manifest.manifest(frame(spark, rows)).collect()) == brute(rows, lambda d: False)


def test_many_groups_and_no_rows(spark):
    rows = [(i, "T", f"lang{i % 150}", "a", 1) for i in range(400)]
    assert Counter(tuple(r) for r in manifest.manifest(frame(spark, rows)).collect()) == brute(rows, lambda d: False)
    empty = manifest.manifest(frame(spark, []))
    assert empty.collect() == [] and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]


def test_partial_parents_meet_in_any_order():
    n, rnd = 1000, random.Random(4)
    leaves = [sha(str(i)) for i in range(n)]
    events = [(("g", n, 1, i // 8), {i % 8: d}) for i, d in enumerate(leaves)]
    rnd.shuffle(events)
    rows, frontier = [], []
    for at in range(0, n, 130):  # tasks that each see some of the leaves
        for r in manifest.absorb(events[at : at + 130]):
            (rows if r[6] else frontier).append(r)
    while frontier:
        merged = {}
        for g, m, level, index, slots, children, _ in frontier:
            merged.setdefault((g, m, level, index), {}).update(zip(slots, children))
        frontier = []
        for r in manifest.absorb(merged.items()):
            (rows if r[6] else frontier).append(r)
    assert [r[6] for r in rows if r[2] == manifest.height(n)] == [tree(leaves)[0]]
    assert len(rows) == len({r[:4] for r in rows}) == 125 + 16 + 2 + 1
