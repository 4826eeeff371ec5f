"""Decontamination by suffix arrays against plain search for windows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tessera.llm import decontaminate, suffixes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, items string, n_hit int, Text2 string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    wins = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i : i + window]), set()).add("" if name is None else str(name))
    lengths, out = {len(x) for x in wins}, []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if own := wins.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        out.append((doc_id, len(w), len(hit), tuple(sorted(found)), tuple((s, e) for s, e in runs(hit))))
    return Counter(out)


def runs(hit):
    begins = sorted(i for i in hit if i - 1 not in hit)
    ends = sorted(i + 1 for i in hit if i + 1 not in hit)
    return zip(begins, ends)


def result(df):
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), tuple((s.begin, s.end) for s in r.spans)) for r in df.collect())


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(9)
    vocabulary = ["the", "of", "Ünïcode", "naïve", "x1", "averyveryverylongwordindeed", "中文词语中文词语中文词语", "zz", "q"] + [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([3, 9, 10, 11, 25, 60])))) for i in range(30)]
    items += [(7, "Same item, other row " * 4), (100, items[3][1]), (101, None), (102, "..."), (None, "no id item has these eleven words in it, all of them"), (200, "short one"), (201, "SHORT one")]
    docs = []
    for i in range(120):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 80))]
        if i % 3 == 0:
            item = words(rnd.choice(items)[1])
            cut = item[rnd.randint(0, 2) :][: rnd.choice([8, 10, 30, 80])]
            w[rnd.randint(0, len(w)) : 0] = [x.upper() for x in cut]
        docs.append((i, rnd.choice([" ", "\n", ", ", "-"]).join(w)))
    docs += [(200, None), (201, ""), (202, "\x00 .,"), (None, items[5][1]), (203, "short"), (204, "one"), (205, "Short-ONE"), (206, "averyveryverylongwordindeedX " * 12)]
    docs += [(300, items[4][1] + " end")] * 50 + [(301, "the " * 60000 + items[8][1])]
    rnd.shuffle(docs)
    return docs, items, spark.createDataFrame([(d, t, "x", 1, "y") for d, t in docs], DOCS).repartition(3), spark.createDataFrame([(d, t, 5) for d, t in items], "item_id long, text string, doc_id int")


@pytest.mark.parametrize(("shard_bytes", "block_bytes"), [(1 << 23, 1 << 23), (2000, 1 << 23), (5000, 300)])
def test_scan_matches_plain_search(tables, shard_bytes, block_bytes):
    docs, items, d, i = tables
    assert result(decontaminate.scan(d, i, shard_bytes=shard_bytes, block_bytes=block_bytes)) == brute(docs, items)


def test_removal_keeps_columns_and_clean_rows(tables):
    docs, items, d, i = tables
    out = decontaminate.removed(d, i, shard_bytes=4000)
    assert out.columns == d.columns
    want = Counter()
    for (doc_id, _, n_hit, *_), n in brute(docs, items).items():
        want[doc_id] += n if not n_hit else 0
    assert Counter(r.doc_id for r in out.collect()) == +want


def test_empty_tables(tables, spark):
    docs, _, d, i = tables
    assert decontaminate.scan(d.limit(0), i).collect() == []
    assert result(decontaminate.scan(d, i.limit(0))) == brute(docs, [])


def test_longest_matches(tables):
    docs, items, d, i = tables
    got = {r.item_id: r for r in decontaminate.longest_matches(d, i.filter("item_id IS NULL OR item_id <> 7"), shard_bytes=4000).collect()}
    texts = {}
    for k, t in docs:
        texts.setdefault(k, []).append(words(t))
    for name, text in items:
        if name == 7:
            continue
        w, best = words(text), 0
        for dw in (x for v in texts.values() for x in v):
            places = {}
            for p, x in enumerate(dw[-400:]):
                places.setdefault(x, []).append(p)
            for a in range(len(w)):
                for p in places.get(w[a], ()):
                    n = 0
                    while a + n < len(w) and p + n < len(dw[-400:]) and w[a + n] == dw[-400:][p + n]:
                        n += 1
                    best = max(best, n)
        r = got.get("" if name is None else str(name))
        assert (r.length if r else 0) == best
        if r:
            assert any(x[r.doc_at : r.doc_at + r.length] == w[r.item_at : r.item_at + r.length] for x in texts[r.doc_id])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=120), st.integers(1, 40))
def test_suffix_array_is_in_order(ids, depth):
    ids = np.array([*ids, 0], np.int32)
    order = suffixes.suffix_array(ids, depth)
    assert sorted(order.tolist()) == np.flatnonzero(ids).tolist()
    ends = np.flatnonzero(ids == 0)
    read = [ids[p : min(p + depth, ends[np.searchsorted(ends, p)])].tolist() for p in order.tolist()]
    assert read == sorted(read)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aBz9 ._é中\x00\n", max_size=40), max_size=6))
def test_words_are_cut_as_the_rule_says(texts):
    w = suffixes.of_texts([t.encode() for t in texts])
    got = [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)]
    assert got == [x for t in texts for x in words(t)]
    assert np.diff(w.first).tolist() == [len(words(t)) for t in texts]
    _, numbers = suffixes.Vocabulary.of(w)
    assert len(set(zip(got, numbers.tolist()))) == len(set(got)) == len(set(numbers.tolist()))
