"""Operators on small tables made by hand: the cases that the data may lack."""

import datetime as dt
import hashlib
import http.server
import json
import statistics
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import predicates, stats
from tessera.operators import crosssection, factors, quality, temporal, universe
from tessera.sources import rest, tables
from tessera.streaming import incremental

D = dt.date


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_restatement_is_seen_only_after_it_was_accepted(spark):
    """The cut-off comes before the choice of vintage, and is at 16:00."""
    rows = [(1, D(2020, 3, 31), 1, dt.datetime(2020, 5, 1, 9), 10.0), (1, D(2020, 3, 31), 2, dt.datetime(2020, 8, 1, 15, 59), 20.0), (1, D(2020, 6, 30), 1, dt.datetime(2020, 8, 1, 16, 1), 5.0), (1, D(2019, 12, 31), 1, None, 1.0)]
    s = spark.createDataFrame(rows, "sec int, period_end date, vintage_id int, accepted timestamp_ntz, gp double")
    grid = spark.createDataFrame([(1, D(2020, 4, 30)), (1, D(2020, 7, 31)), (1, D(2020, 8, 1)), (1, D(2020, 8, 2))], "sec int, as_of date")
    got = {(r.as_of, r.period_end): r.gp for r in temporal.visible_statements(grid, s).collect()}
    assert got == {(D(2020, 7, 31), D(2020, 3, 31)): 10.0, (D(2020, 8, 1), D(2020, 3, 31)): 20.0, (D(2020, 8, 2), D(2020, 3, 31)): 20.0, (D(2020, 8, 2), D(2020, 6, 30)): 5.0}


def test_asof_age_ties_and_missing(spark):
    left = spark.createDataFrame([("a", 10), ("a", 3), ("b", 5), (None, 5)], "k string, t int").withColumn("t", F.date_add(F.lit("2020-01-01").cast("date"), "t"))
    right = spark.createDataFrame([("a", 4, 1.0), ("a", 4, 2.0), ("a", 10, 3.0)], "k string, t int, v double").withColumn("u", F.date_add(F.lit("2020-01-01").cast("date"), "t")).drop("t")
    got = {(r.k, r.t.day): r.v for r in temporal.asof_backward(left, right, "k", "t", "u", ["v"]).collect()}
    assert got == {("a", 11): 3.0, ("a", 4): None, ("b", 6): None, (None, 6): None}
    aged = temporal.asof_backward(left, right.filter("v < 3"), "k", "t", "u", ["v"], max_age_days=5)
    assert {(r.k, r.t.day): r.v for r in aged.collect()}[("a", 11)] is None


def test_intervals_merge_and_contain(spark):
    rows = [("x", D(2020, 1, 1), D(2020, 2, 1)), ("x", D(2020, 2, 1), D(2020, 3, 1)), ("x", D(2020, 5, 1), None), ("x", D(2020, 6, 1), D(2020, 7, 1)), ("y", D(2020, 1, 1), None), ("y", D(2020, 1, 1), None)]
    i = spark.createDataFrame(rows, "k string, valid_from date, valid_to date")
    got = sorted((r.k, r.valid_from, r.valid_to, r.n) for r in temporal.merged(i, ["k"]).collect())
    assert got == [("x", D(2020, 1, 1), D(2020, 3, 1), 2), ("x", D(2020, 5, 1), None, 2), ("y", D(2020, 1, 1), None, 2)]
    left = sorted((r.k, r.valid_from) for r in temporal.uncontained(i, ["k"]).collect())
    assert left == [("x", D(2020, 1, 1)), ("x", D(2020, 2, 1)), ("x", D(2020, 5, 1)), ("y", D(2020, 1, 1))]


def test_rename_chain_follows_to_the_end(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("p", "q"), ("q", "p")], "old string, new string")
    got = {r.start: r.last for r in temporal.rename_chain(e).collect()}
    assert got == {"a": "d", "b": "d", "c": "d", "x": "y", "p": None, "q": None}
    long = spark.range(300).select(F.col("id").alias("old"), (F.col("id") + 1).alias("new"))
    assert {(r.last, r.start + r.steps) for r in temporal.rename_chain(long).collect()} == {(300, 300)}
    assert temporal.rename_chain(long.limit(0)).count() == 0


def test_probit_equals_the_standard_library(spark):
    p = [1e-12, 1e-6, 0.01, 0.07, 0.3, 0.5, 0.8, 0.999, 1 - 1e-9]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in p], "p double").select(stats.probit(F.col("p"))).collect()]
    assert got == pytest.approx([statistics.NormalDist().inv_cdf(x) for x in p], rel=1e-9, abs=1e-12)
    assert one(spark, stats.probit(F.lit(0.0)))[0] is None


def test_newey_west_equals_numpy(spark):
    x = np.random.default_rng(3).normal(size=50)
    df = spark.createDataFrame([("f", i, float(v)) for i, v in enumerate(x)], "k string, t int, v double")
    got = stats.newey_west(df, "v", "t", ["k"], 3).first()
    e = x - x.mean()
    s = e @ e + sum(2 * (1 - j / 4) * (e[j:] @ e[:-j]) for j in (1, 2, 3))
    assert got.t == pytest.approx(x.mean() / (np.sqrt(s) / len(x)))


def test_ols_and_standardise_on_degenerate_groups(spark):
    df = spark.createDataFrame([("g", float(i), 1.0, 2.0 * i + 1) for i in range(8)] + [("small", 1.0, 1.0, 1.0), (None, None, None, None)], "g string, a double, b double, y double")
    got = {r.term: r.beta for r in stats.grouped_ols(df, "y", ["a", "b"], "g", 5).collect()}
    assert got["intercept"] == pytest.approx(8.0) and got["a"] == pytest.approx(2 * np.std(range(8))) and got["b"] == pytest.approx(0, abs=1e-9)
    flat = spark.createDataFrame([("g", "f", i, 1.0, "s", 10.0) for i in range(4)], "as_of string, factor string, sec int, value double, sector string, mktcap double")
    assert [r.z_sector_size for r in crosssection.standardise(flat).collect()] == [0.0] * 4


def test_predicates_on_null_and_zero(spark):
    r = one(spark, predicates.first_truthy(F.lit(0.0), F.lit(None).cast("double"), F.lit(0.0)).alias("a"), predicates.zero_as_null(F.lit(0)).alias("b"), predicates.same_issuer(F.lit("000"), F.lit("7")).alias("c"), predicates.same_issuer(F.lit("007"), F.lit("7")).alias("d"), predicates.same_issuer(F.lit("8"), F.lit("7")).alias("e"))
    assert (r.a, r.b, r.c, r.d, r.e) == (0.0, None, True, True, False)
    assert one(spark, predicates.split_ratio(F.lit(None), F.lit(None), F.lit("3:2")))[0] == 1.5
    assert one(spark, predicates.split_ratio(F.lit(None), F.lit(None), F.lit("x-0")))[0] is None
    assert one(spark, predicates.lag_class(F.lit(None).cast("date"), F.lit("2020-01-01").cast("date")))[0] == "missing"
    assert one(spark, predicates.iso_week(F.lit("2021-01-03").cast("date")))[0] == "2020-W53"


def test_upper_median_needs_rows(spark):
    rows = [(1, D(2020, 1, 1) + dt.timedelta(i), float(i + 1), 1.0) for i in range(4)]
    b = spark.createDataFrame(rows, "sec int, d date, close double, volume double")
    got = [r.adv for r in universe.trailing_adv(b, rows=3, minimum=2).orderBy("d").collect()]
    assert got == [None, 2.0, 2.0, 3.0]


def test_surprise_history_leaves_out_the_current_one(spark):
    rows = [(1, D(2020, 1, i + 1), float(i % 3), 0.5 if i != 2 else None) for i in range(8)]
    got = factors.standardised_surprise(spark.createDataFrame(rows, "sec int, report_date date, actual double, estimate double"), minimum=4).orderBy("report_date").collect()
    diffs = [r.diff for r in got]
    assert len(got) == 7 and [r.sue for r in got[:4]] == [None] * 4
    assert got[5].sue == round(diffs[5] / statistics.pstdev(diffs[:5]), 4)


def test_keyed_writes(spark, tmp_path):
    have = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "e"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, tables.only_new(have, new, ["k"], ["v"]).collect())) == [(3, "d")]
    assert sorted(map(tuple, tables.upserted(have, new, ["k"], ["v"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    ids = tables.with_ids(spark.createDataFrame([(f"k{i}",) for i in range(300)], "name string").repartition(5), "name").collect()
    assert sorted(r.id for r in ids) == list(range(1, 301))
    path = str(tmp_path / "t")
    tables.replace_partitions(have.withColumn("p", F.col("k")), path, ["p"])
    tables.replace_partitions(spark.createDataFrame([(9, "z", 2)], "k int, v string, p int"), path, ["p"])
    assert sorted((r.k, r.p) for r in spark.read.parquet(path).collect()) == [(1, 1), (9, 2)]
    tables.rebuild(have, path)
    assert spark.read.parquet(path).count() == 2


def test_vintages_and_later_rows(spark):
    have = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, vintage_id int, h string")
    feed = spark.createDataFrame([("a", "x"), ("b", None), ("c", "z")], "k string, h string")
    assert sorted((r.k, r.vintage_id) for r in incremental.new_vintages(have, feed, ["k"], "h").collect()) == [("a", 3), ("c", 1)]
    stored = spark.createDataFrame([("a", 5)], "k string, t int")
    new = spark.createDataFrame([("a", 5), ("a", 4), ("a", 6), ("b", 9)], "k string, t int")
    assert [tuple(r) for r in incremental.later_rows(stored, new, "k", "t").collect()] == [("a", 6)]


def test_schedule_rules_at_their_edges(spark):
    times = {
        dt.datetime(2024, 5, 1, 22, 59): [], dt.datetime(2024, 5, 1, 23): [("daily", "2024-05-01")],
        dt.datetime(2024, 5, 4, 11, 59): [], dt.datetime(2024, 5, 4, 12): [("weekly", "2024-W18")], dt.datetime(2024, 5, 5, 23): [("monthly", "2024-05")],
        dt.datetime(2024, 5, 2, 12, 59): [], dt.datetime(2024, 5, 2, 13): [("monthly", "2024-05")], dt.datetime(2024, 5, 31, 23): [("daily", "2024-05-31"), ("monthly", "2024-05")],
        dt.datetime(2024, 6, 1, 13): [("weekly", "2024-W22")],
    }
    rows = incremental.due(spark.createDataFrame([(t,) for t in times], "now timestamp_ntz")).collect()
    assert {t: sorted((r.job, r.period) for r in rows if r.now == t) for t in times} == {t: sorted(x) for t, x in times.items()}


def test_periods_are_claimed_once_and_again_when_stale(spark):
    t = dt.datetime(2024, 5, 1, 12)
    log = spark.createDataFrame([("a", "ended", "ok", t, ""), ("a", "failed", "error", t, ""), ("a", "held", "running", t - dt.timedelta(hours=6), ""), ("a", "stale", "running", t - dt.timedelta(hours=6, seconds=1), "")], "job string, period string, status string, ran_at timestamp_ntz, detail string")
    asked = spark.createDataFrame([("a", p, t + dt.timedelta(minutes=m)) for p in ("ended", "failed", "held", "stale", "new") for m in (0, 1)], "job string, period string, now timestamp_ntz").filter("period <> 'held' OR minute(now) = 0")
    claims = incremental.claimable(asked, log)
    assert sorted(r.period for r in claims.collect()) == ["new", "stale"]
    after = incremental.recorded(log, claims, "running", F.lit("claimed"))
    assert {r.period: (r.status, r.detail) for r in after.collect()} == {"ended": ("ok", ""), "failed": ("error", ""), "held": ("running", ""), "stale": ("running", "claimed"), "new": ("running", "claimed")}
    assert incremental.claimable(asked.filter("period <> 'held'"), after).count() == 0


def test_stream_takes_each_key_once(spark, tmp_path):
    rows = [(i % 5, dt.datetime(2024, 1, 1 + i % 3)) for i in range(30)]
    spark.createDataFrame(rows, "k int, at timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k int, at timestamp").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    incremental.run_available(incremental.once_within(stream, "at", ["k"], "5 days"), lambda b, n: b.write.mode("append").parquet(out), str(tmp_path / "state"))
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]


def test_gates(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert tuple(quality.violations(rows, F.col("x") > 1).first()) == (3, 2)
    assert tuple(quality.share(rows.filter("x > 9"), F.col("x") > 1, 0.9).first()) == (0, 1.0, True)


class Served(http.server.BaseHTTPRequestHandler):
    """Seven pages of two rows; ``old`` is unknown, page 1 is busy at first, and what
    ``broken`` says always fails, or the first time only."""

    tries, broken, asked, pages = {}, {}, [], 7

    def do_GET(self):
        n = self.tries[self.path] = self.tries.get(self.path, 0) + 1
        self.asked.append(self.path)
        page = int(self.path.split("page=")[1].split("&")[0])
        body = {"rows": [{"id": 10 * page + i, "name": None if i else "x"} for i in range(2)]} if page < self.pages else []
        code = 429 if page == 1 and n == 1 and "old" not in self.path else 200
        if "old" in self.path or any(mark in self.path and page == p and (always or n == 1) for mark, (p, always) in self.broken.items()):
            code, body = 404, {}
        self.send_response(code)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *a):
        pass


@pytest.fixture(scope="module")
def served():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Served)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


EVERY = [10 * p + i for p in range(7) for i in range(2)]


def paged(reader, spark):
    spark.dataSource.register(rest.PagedJson)
    return reader.format("paged_json").schema("id long, name string").option("interval", 0.01).option("backoff", 0.01)


def test_paged_json_source(spark, served):
    read = lambda: paged(spark.read, spark)
    for tasks in (1, 3, 9):
        got = read().option("tasks", tasks).option("urls", f"{served}/old{tasks}?page={{page}}\n{served}/new{tasks}?page={{page}}{{&since}}").load().collect()
        assert sorted(r.id for r in got) == EVERY
        assert sorted(r.id for r in read().option("tasks", tasks).option("url", f"{served}/one{tasks}?page={{page}}").load().collect()) == EVERY
    some = read().option("pages", 3).option("url", f"{served}/some?page={{page}}")
    assert sorted(r.id for r in some.option("tasks", 2).load().collect()) == EVERY[:6]
    with pytest.raises(Exception, match="no rows"):
        read().option("first", 7).option("url", f"{served}/none?page={{page}}").load().collect()
    assert read().option("first", 7).option("allow_empty", "true").option("url", f"{served}/none?page={{page}}").load().count() == 0
    with pytest.raises(ValueError):
        rest.rows_of({"error": "no"})
    assert rest.filled("u?page={page}{&since}{&to}", {"since": "5"}, 3) == "u?page=3&since=5"


@pytest.mark.parametrize("tasks", [1, 2, 5])
@pytest.mark.parametrize("pages", [None, 7])
def test_a_lost_page_fails_the_scan(spark, served, tasks, pages):
    mark = f"lost{tasks}{pages}"
    Served.broken = {mark: (3, True)}
    scan = paged(spark.read, spark).option("tasks", tasks).option("url", f"{served}/{mark}?page={{page}}")
    with pytest.raises(Exception, match="404"):
        (scan.option("pages", pages) if pages else scan).load().collect()
    Served.broken = {}
    assert sorted(r.id for r in scan.load().collect()) == EVERY


def test_a_page_that_its_template_fails_on_is_not_empty(spark):
    import urllib.error

    reader = rest.PagedReader(None, {"urls": "a{page}\nb{page}"})
    error = lambda code: urllib.error.HTTPError("u", code, "", None, None)

    def page(number, answers, templates=None):
        def fetch(url):
            if isinstance(answers[url[0]], Exception):
                raise answers[url[0]]
            return answers[url[0]]

        reader.fetch = fetch
        return reader.page(number, templates or reader.templates())

    assert page(0, {"a": error(404), "b": []}) == [] and page(0, {"a": error(404), "b": [{}]}) == [{}]
    assert page(0, {"a": rest.ErrorAnswer(), "b": []}) == []
    for a, b in ((error(404), error(404)), (error(500), []), (TimeoutError(), []), (ValueError(), [])):
        with pytest.raises(Exception):  # noqa: B017
            page(0, {"a": a, "b": b})
    known = reader.templates()
    known.remember("b{page}")
    with pytest.raises(urllib.error.HTTPError):
        page(3, {"a": [], "b": error(404)}, known)
    assert page(3, {"a": error(404), "b": []}, known) == []


def test_filters_narrow_the_request(spark, served):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        scan = paged(spark.read, spark).option("pages", 2).option("push", "id:>=:from, name:=:name").option("url", f"{served}/push?page={{page}}{{&from}}{{&name}}")
        Served.asked.clear()
        assert [r.id for r in scan.load().filter("id >= 10 AND name = 'x'").collect()] == [10]
        assert set(Served.asked) == {f"/push?page={p}&from=10&name=x" for p in (0, 1)}
        Served.asked.clear()
        assert [r.id for r in scan.load().filter("id > 10").collect()] == [11]
        assert set(Served.asked) == {f"/push?page={p}" for p in (0, 1)}
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def follow(spark, url, out, state, **options):
    stream = paged(spark.readStream, spark).option("url", url)
    for k, v in options.items():
        stream = stream.option(k, v)
    q = stream.load().writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return sorted(r.id for r in spark.read.schema("id long").parquet(out).collect())


def test_pages_as_a_stream(spark, served, tmp_path):
    """New pages follow where the last run ended; a page that errors once costs nothing,
    one that always errors fails the query and is read again when it answers."""
    at = [str(tmp_path / x) for x in ("out", "state")]
    Served.pages, Served.broken = 5, {"grow": (4, False)}
    try:
        with pytest.raises(Exception, match="404"):
            follow(spark, f"{served}/grow?page={{page}}", *at, tasks=2)
        assert follow(spark, f"{served}/grow?page={{page}}", *at, tasks=2) == EVERY[:10]
        Served.pages, Served.broken = 7, {"grow": (5, True)}
        with pytest.raises(Exception, match="404"):
            follow(spark, f"{served}/grow?page={{page}}", *at, tasks=2)
        Served.broken = {}
        assert follow(spark, f"{served}/grow?page={{page}}", *at, tasks=3) == EVERY
        assert follow(spark, f"{served}/grow?page={{page}}", *at) == EVERY
    finally:
        Served.pages, Served.broken = 7, {}


@pytest.mark.parametrize("most", [0, 1, 3, 4, 100])
def test_offsets_are_found_by_halving(most):
    for there in (0, 1, 2, 3, 5, 8, 13):
        stream = rest.PagedStream(None, {"url": "{page}", "pages_per_batch": str(most)})
        asked = []
        stream.reader.page = lambda n, _, there=there: asked.append(n) or ([{}] if n < there else [])
        offset, batches = stream.initialOffset(), []
        while (end := stream.latestOffset()) != offset:
            parts = stream.partitions(offset, end)
            assert sum(p.count for p in parts) == end["page"] - offset["page"] and (not most or end["page"] - offset["page"] <= most)
            offset = end
            batches.append(end["page"])
        assert offset["page"] == there
        if not most:
            assert len(asked) <= 4 * (there.bit_length() + 1) + 2


def test_remembered_template(spark):
    """The template that answered is asked first for the pages that follow."""
    reader = rest.PagedReader(None, {"urls": "a{page}\nb{page}", "pages": "3"})
    reader.schema = type("S", (), {"fields": []})()
    asked = []
    reader.fetch = lambda url: asked.append(url) or ([{}] if url[0] == "b" else [])
    list(reader.read(reader.partitions()[0]))
    assert asked == ["a0", "b0", "b1", "b2"]


@pytest.mark.parametrize("n", [4, 29, 30])
def test_bootstrap_equals_numpy_on_the_same_draws(spark, n):
    x = np.random.default_rng(4).normal(size=n)
    df = spark.createDataFrame([("f", i, float(v)) for i, v in enumerate(x)], "k string, t int, v double")
    got = stats.block_bootstrap(df.unionByName(df.limit(1).withColumn("v", F.lit(None).cast("double"))), "v", "t", "k", draws=300).first()
    means = []
    for draw in range(1, 301):
        starts = [int(hashlib.md5(f"20260726:f:{draw}:{j}".encode()).hexdigest()[:13], 16) % n for j in range(n // 6 + 1)]
        means.append(np.mean([x[(s + j) % n] for s in starts for j in range(6)][:n]))
    assert (got.low, got.high) == pytest.approx((np.quantile(means, 0.025), np.quantile(means, 0.975))) and got.n == n


def linkage(names, d, cut):
    groups = [[i] for i in range(len(names))]
    while len(groups) > 1:
        v, i, j = min((d[np.ix_(a, b)].mean(), x, y) for x, a in enumerate(groups) for y, b in enumerate(groups) if x < y)
        if v > cut:
            break
        groups[i] += groups.pop(j)
    return sorted(",".join(sorted(names[k] for k in g)) for g in groups)


def test_average_linkage_equals_its_definition(spark):
    rng = np.random.default_rng(7)
    names = [f"s{i:02}" for i in range(9)]
    d = rng.random((9, 9))
    d = (d + d.T) / 2
    pairs = spark.createDataFrame([(names[i], names[j], float(d[i, j])) for i in range(9) for j in range(i + 1, 9)], "a string, b string, distance double")
    cuts = [0.1, 0.3, 0.4, 0.5, 0.9]
    got = stats.average_linkage(pairs, cuts).collect()
    for c in cuts:
        assert [r.members for r in sorted((r for r in got if r.cut == c), key=lambda r: r.cluster)] == linkage(names, d, c)
    assert stats.average_linkage(pairs.limit(0), cuts).count() == 0
    assert [r.members for r in stats.average_linkage(pairs.filter("a = 's00' AND b = 's01'"), [2.0]).collect()] == ["s00,s01"]


def test_least_squares_equal_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 4))
    y = x @ [1.0, -2.0, 0.5, 0.0] + rng.normal(size=60)
    got = {r.term: r.beta for r in stats.grouped_ols(spark.createDataFrame([("g", *map(float, r), float(v)) for r, v in zip(x, y)], "g string, a double, b double, c double, d double, y double"), "y", list("abcd"), "g", 5).collect()}
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.lstsq(np.column_stack([np.ones(60), z]), y, rcond=None)[0]
    assert [got[t] for t in ("intercept", *"abcd")] == pytest.approx(list(want))
    alike = stats.eliminated(np.array([[1.0, 1.0], [1.0, 1.0]]), np.array([2.0, 2.0]), 1e-9)
    assert alike.tolist() == [2.0, 0.0]


def test_visibility_equals_brute_force(spark):
    """Vintages out of order, gaps and many periods, against the definition."""
    import random

    rnd = random.Random(2)
    rows = []
    for sec in range(4):
        for q in range(14):
            end = D(2018, 1, 31) + dt.timedelta(91 * q)
            for v in range(1, rnd.randint(1, 4)):
                accepted = None if rnd.random() < 0.1 else dt.datetime.combine(end, dt.time(rnd.randint(9, 20))) + dt.timedelta(rnd.randint(-5, 500))
                rows.append((sec, end, v, accepted, float(rnd.randint(1, 99))))
    s = spark.createDataFrame(rows, "sec int, period_end date, vintage_id int, accepted timestamp_ntz, gp double")
    months = [D(2018 + k // 12, k % 12 + 1, 27) for k in range(3, 60)]
    grid = spark.createDataFrame([(m, 10 + i) for i, m in enumerate(months)], "as_of date, ai long")
    for last in (3, None):
        want = set()
        for m in months:
            close = dt.datetime.combine(m, dt.time(16))
            for sec in range(4):
                best = {}
                for r in rows:
                    if r[0] == sec and r[1] <= m and r[3] is not None and r[3] <= close:
                        best[r[1]] = max(best.get(r[1], (0, 0)), (r[2], r[4]))
                for nth, end in enumerate(sorted(best, reverse=True)[:last], 1):
                    want.add((sec, m, end, *best[end], nth))
        got = {(r.sec, r.as_of, r.period_end, r.vintage_id, r.gp, r.nth) for r in temporal.visible_on_grid(s, grid, last).collect()}
        assert got == want


def test_vendor_exit_gates(spark):
    names = [
        (1, True, True, True, False, False, False, False, False, False), (2, True, None, True, True, False, True, False, True, False),
        (3, True, True, True, True, True, True, True, False, True), (4, True, True, True, True, False, False, None, None, None), (5, True, True, False, True, None, None, None, None, None),
    ]
    names = spark.createDataFrame(names, "sec int, issuer boolean, instrument boolean, active boolean, gone boolean, may_trade boolean, renamed boolean, change_known boolean, deal boolean, listed_gone boolean")
    pairs = spark.createDataFrame([(1, D(2024, 1, i + 1), i in (3, 7)) for i in range(8)] + [(2, D(2024, 1, 1), False)], "sec int, d date, mismatch boolean")
    ends = [D(2020 + i // 4, 3 * (i % 4) + 1, 28) for i in range(10)]
    lags = [500, 500, 10, 20, 200, 201, None, 30, 40, 50]  # the first two are older than the latest eight
    filings = [(1, p, None if n is None else dt.datetime.combine(p, dt.time(17)) + dt.timedelta(n)) for p, n in zip(ends, lags)] + [(3, ends[0], dt.datetime.combine(ends[0], dt.time(9)) + dt.timedelta(45))]
    gates = quality.vendor_exit(names, pairs, spark.createDataFrame(filings, "sec int, period_end date, accepted timestamp"))
    got = {r.sec: r for r in gates.collect()}
    assert [got[i].flags for i in range(1, 6)] == ["", "missing-anchors,chimera-suspect(active),change-not-in-feed", "", "chimera-suspect(active)", ""]
    assert [got[i].end_known for i in range(1, 6)] == [None, "rung1-deal-feed", "rung2-delisted-feed", "reused/active-manual-map", "UNRESOLVED"]
    assert (got[1].days, got[1].match_pct, got[1].first_mismatch) == (8, 75.0, D(2024, 1, 4)) and (got[4].days, got[4].match_pct) == (0, None)
    assert (got[1].statements, got[1].with_accepted, got[1].median_lag) == (8, 7, 40)
    assert got[1].weird == f"{ends[2]}:10d,{ends[5]}:201d" and (got[3].median_lag, got[3].weird) == (45, "") and (got[2].statements, got[2].median_lag) == (0, None)
    assert [tuple(r) for r in quality.vendor_exit_summary(gates).collect()] == [("identity", 3, 5), ("returns", 1, 2), ("statements", 1, 2), ("delisting", 3, 4)]
    none = quality.vendor_exit(names.limit(0), pairs.limit(0), gates.limit(0).select("sec", F.lit(None).cast("date").alias("period_end"), F.lit(None).cast("timestamp").alias("accepted")))
    assert none.count() == 0 and [r.of_ for r in quality.vendor_exit_summary(none).collect()] == [0] * 4


def test_lost_batch_is_replayed_over_what_it_left(spark, tmp_path):
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).write.parquet(str(tmp_path / "in"), mode="append")
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "in"))
    out, state, calls = str(tmp_path / "out"), str(tmp_path / "state"), []
    write = incremental.by_number(out)

    def flaky(fails):
        def each(batch, number):
            calls.append(number)
            if len([n for n in calls if n == number]) <= fails.get(number, 0):
                write(batch.limit(1), number)  # lost halfway
                raise ConnectionError("lost")
            write(batch, number)

        return each

    # two losses cost nothing, a third fails the stream, and one started anew takes that batch up again
    incremental.run_available(stream(), incremental.replayed(flaky({0: 2}), wait=0.01), state)
    assert calls[:3] == [0, 0, 0] and sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(30))
    spark.range(30, 40).write.parquet(str(tmp_path / "in"), mode="append")
    calls.clear()
    new = max(int(p.name[6:]) for p in (tmp_path / "out").iterdir()) + 1
    with pytest.raises(Exception, match="lost"):
        incremental.run_available(stream(), incremental.replayed(flaky({new: 3}), wait=0.01), state)
    assert calls == [new] * 3
    incremental.run_available(stream(), incremental.replayed(write, wait=0.01), state)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(40))
    with pytest.raises(KeyError):
        incremental.replayed(lambda b, n: {}["other"])(None, 0)
