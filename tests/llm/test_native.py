"""The native operators against brute force on rows made to be awkward."""

import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tessera.llm import exact_dedup, mixing, quality, sharding
from tessera.llm.common import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("batches", [1, 3])
def test_exact_dedup_matches_brute_force(spark, awkward, nothing, batches):
    with exact_dedup.DigestIndex.temporary(spark, 4) as index:
        got = rows_of(exact_dedup.deduplicate_newest_first(awkward, index, batches))
        assert exact_dedup.deduplicate_newest_first(nothing, index, batches).count() == 0
        assert index.table().count() == len({g["digest"] for g in got})
    assert not spark.catalog.tableExists(index.name)
    groups = defaultdict(list)
    for r in awkward.collect():
        groups[hashlib.sha256((r.text or "").translate(LOWER).encode()).hexdigest()].append(r.doc_id)
    want = Counter((d, max((i for i in ids if i is not None), default=None), len(ids), h) for h, ids in groups.items() for d in ids)
    assert Counter((g["doc_id"], g["keep_id"], g["group_size"], g["digest"]) for g in got) == want
    kept = Counter(g["digest"] for g in got if g["kept"])
    assert set(kept) == set(groups) and set(kept.values()) == {1}


def test_digest_index_grows_and_drops_later_copies(spark, nothing):
    schema = "doc_id long, text string"
    with exact_dedup.DigestIndex.temporary(spark, 4) as index:
        assert exact_dedup.deduplicate(nothing, index).count() == 0
        first = exact_dedup.kept_documents(spark.createDataFrame([(1, "a"), (2, "A"), (3, "b"), (3, "b")], schema), index)
        assert sorted(map(tuple, first.collect())) == [(2, "A"), (3, "b")]
        second = exact_dedup.kept_documents(spark.createDataFrame([(9, "a"), (8, "c"), (None, "d")], schema), index)
        assert sorted(r.text for r in second.collect()) == ["c", "d"]
        assert index.table().count() == 4
        # a text that was rare fills the next batch: it is joined as a hot one of that batch
        hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("B")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
        got = exact_dedup.deduplicate(hot, index).groupBy("kept", "keep_id", "group_size").count().filter("group_size > 1").collect()
        assert [tuple(r) for r in got] == [(False, 3, 1000, 1000)]


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_kept_documents_whatever_the_batches(spark, awkward, batches):
    with exact_dedup.DigestIndex.temporary(spark, 4) as index:
        got = Counter((r.doc_id, r.text) for r in exact_dedup.kept_documents(awkward, index, batches).collect())
    groups = defaultdict(list)
    for r in awkward.collect():
        groups[(r.text or "").translate(LOWER)].append((r.doc_id is not None, r.doc_id or 0))
    assert Counter(d for d, _ in got.elements()) == Counter(max(ids)[1] if max(ids)[0] else None for ids in groups.values())
    assert {(t or "").translate(LOWER) for _, t in got} == set(groups)


def test_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "x", 1, 2, 3), (2, "A B", "s", "y", 1, 2, 3)], "doc_id long, text string, source string, digest string, _copies int, _th int, copies int")
    with exact_dedup.DigestIndex.temporary(spark, 4) as index:
        out = exact_dedup.kept_documents(docs, index)
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [(2, "A B", "s", "y", 1, 2, 3)]
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and {r.digest for r in mixed.collect()} == {"x", "y"}


def test_shards(spark, awkward, nothing):
    path = scratch_path(spark, "map")
    got = rows_of(sharding.shard(awkward, path, shards=4, slots=64))
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in awkward.collect())
    assert Counter((g["doc_id"], g["size"], g["text_crc32"]) for g in got) == want
    places = defaultdict(list)
    for g in got:
        places[g["shard"]].append(g["place"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert sharding.shard(nothing, scratch_path(spark, "map")).count() == 0


def test_shard_sizes_and_growth(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    path = scratch_path(spark, "map")
    rows = sharding.shard(docs, path, shards=8)
    sizes = [r.b for r in rows.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 0.001 * sum(sizes)
    old = {r.virtual_slot: r.shard for r in sharding.SlotMap(spark, path).read(1).collect()}
    new = {r.virtual_slot: r.shard for r in sharding.add_shard(sharding.records(docs), path, 1, 8).collect()}
    assert set(old) == set(new) and all(new[k] in (old[k], 8) for k in old)
    by = sharding.slot_sizes(sharding.records(docs)).collect()
    load = Counter()
    for r in by:
        load[new[r.virtual_slot]] += r.bytes
    assert abs(load[8] - sum(load.values()) / 9) < 0.01 * sum(load.values()) / 9


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        t = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if t[s] > cap * sizes[s] + 1e-9}
        if not over:
            return t | {s: cap * sizes[s] for s in capped}
        capped |= over


def test_mix_targets_and_taken(spark, awkward, nothing):
    got = rows_of(mixing.mix(awkward))
    sizes = Counter()
    for r in awkward.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    want = brute_targets(sizes)
    taken, longest = Counter(), Counter()
    for g in got:
        assert g["source_size"] == sizes[g["source"]] and g["target"] == pytest.approx(want[g["source"]])
        assert 0 <= g["taken"] <= 3 * g["size"] and g["taken"] == g["copies"] * g["size"]
        taken[g["source"]] += g["taken"]
        longest[g["source"]] = max(longest[g["source"]], g["size"])
    assert len(got) == awkward.count()
    assert all(abs(taken[s] - want[s]) <= longest[s] for s in sizes)
    key = lambda x: [str(v) for v in x.values()]
    assert sorted(got, key=key) == sorted(rows_of(mixing.mix(awkward.repartition(7))), key=key)
    assert mixing.mix(nothing).count() == 0


def test_mix_comes_near_over_many_documents(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (1 + F.col("id") % 50).cast("int")).alias("text"), F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17)).alias("source"))
    sums = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("want"))
    assert all(abs(r.t - r.want) <= 50 for r in sums.collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert abs(mixed.select(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0] - sums.agg(F.sum("t")).first()[0]) == 0


def brute_quality(text):
    ws = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    c, cov = Counter(wins), set()
    for i, x in enumerate(wins):
        if c[x] > 1:
            cov |= set(range(i, i + 8))
    return len(ws), sum(map(len, ws)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(cov)


def test_quality_base_matches_brute_force(awkward, nothing):
    got = rows_of(quality.judged(awkward))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((g["doc_id"], *(g[n] for n in names)) for g in got) == Counter((r.doc_id, *brute_quality(r.text or "")) for r in awkward.collect())
    for g in got:
        assert g["base_failed"] == (g["n_words"] < 20 or 100 * g["n_repeat_words"] > 30 * g["n_words"])
        assert not (g["kept"] and g["base_failed"])
    assert quality.judged(nothing).count() == 0


def test_sketches_merge_and_find_outliers(spark):
    text = F.when(F.col("id") % 100 == 7, F.lit("$$$ %% && ** word " * 30)).otherwise(F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("w"), F.hash(i, "id") % 997))))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), (F.col("id") % 3).cast("string").alias("source"))
    bad = quality.judged(docs, max_repeat_percent=100).filter("NOT kept")
    assert {r.doc_id for r in bad.collect()} == set(range(7, 3000, 100))
    rows = quality.measures(docs)
    parts = quality.sketch(rows.filter("doc_id < 1000"), ["source"]).unionByName(quality.sketch(rows.filter("doc_id >= 1000"), ["source"]))
    assert sorted(map(str, quality.quartiles(parts, ["source"]).collect())) == sorted(map(str, quality.quartiles(quality.sketch(rows, ["source"]), ["source"]).collect()))


def test_fences_follow_the_group_the_more_documents_it_has(spark):
    columns = {f"{r}_{p}": p for r in quality.RULES for p in (25, 75)}
    one = lambda n, lang: spark.createDataFrame([("en", "s", n, *[v * 10 for v in columns.values()])], f"lang string, source string, documents long, {', '.join(f'{c} long' for c in columns)}") if lang is None else spark.createDataFrame([("en", n, *columns.values())], f"lang string, documents long, {', '.join(f'{c} long' for c in columns)}")
    of_all, of_lang = dict(columns), one(10**6, "en")
    got = [quality.fences(one(n, None), of_lang, of_all).first().max_symbol_permille for n in (0, 100, 10**7)]
    assert got[0] == 75 + 3 * 50 + 50 and got[0] < got[1] < got[2] and abs(got[2] - (750 + 3 * 500 + 50)) < 0.1


def test_bins(spark):
    got = {r.id: r.b for r in spark.range(5000).select("id", quality.bin_of(F.col("id")).alias("b")).collect()}
    assert all(b <= v < b + max(1, v / 32) + 1 for v, b in got.items()) and all(got[v] == v for v in range(64))
