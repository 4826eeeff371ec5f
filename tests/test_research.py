"""Research operators against NumPy, the standard library and brute force."""

import datetime as dt
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import stats
from tessera.operators import returns, risk, selection, temporal

D = dt.date


def test_two_sided_p_equals_the_standard_library(spark):
    z = [0.0, -0.3, 1.0, 1.96, -2.5, 5.0, 7.0, 7.2, 9.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in z], "z double").select(stats.two_sided_p(F.col("z"))).collect()]
    assert got == pytest.approx([2 * statistics.NormalDist().cdf(-abs(v)) for v in z], rel=1e-6, abs=1e-15)
    assert got[:7] == pytest.approx([2 * statistics.NormalDist().cdf(-abs(v)) for v in z[:7]], rel=1e-8)


def test_step_up_rule(spark):
    rnd = random.Random(1)
    p = [round(rnd.random() ** 3, 3) for _ in range(40)] + [0.01, 0.01, 1.0, None]
    rows = [("f" if i % 3 else "g", f"t{i}", v) for i, v in enumerate(p)]
    got = {r.term: r.q for r in stats.benjamini_hochberg(spark.createDataFrame(rows, "family string, term string, p double"), "family", "p", "term").collect()}
    for fam in "fg":
        own = sorted((v, t) for f, t, v in rows if f == fam and v is not None)
        for r, (_, t) in enumerate(own, 1):
            assert got[t] == pytest.approx(min(1.0, *(v * len(own) / k for k, (v, _) in enumerate(own, 1) if k >= r)))
    assert got["t43"] is None


def test_shrunk_covariance_equals_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 3)) @ rng.normal(size=(3, 3)) + 0.7
    start = D(2000, 1, 31)
    rows = [(start + dt.timedelta(31 * t), f"f{i}", float(x[t, i])) for t in range(40) for i in range(3)]
    got = {(r.as_of, r.a, r.b): r for r in risk.shrunk_covariance(spark.createDataFrame(rows, "as_of date, term string, value double"), 24, 12).collect()}
    assert len(got) == 29 * 6
    for t in (11, 20, 39):
        w = x[max(0, t - 23) : t + 1]
        e = w - w.mean(0)
        s, off = e.T @ e / len(w), ~np.eye(3, dtype=bool)
        noise = ((e[:, :, None] * e[:, None, :] - s) ** 2).mean(0) / len(w)
        intensity = min(1.0, noise[off].sum() / (s[off] ** 2).sum())
        r = got[start + dt.timedelta(31 * t), "f0", "f2"]
        assert (r.n, r.cov, r.intensity, r.shrunk) == (len(w), pytest.approx(s[0, 2]), pytest.approx(intensity), pytest.approx(s[0, 2] * (1 - intensity)))
        assert got[start + dt.timedelta(31 * t), "f1", "f1"].shrunk == pytest.approx(s[1, 1])


def test_specific_variance_weighs_the_latest_most(spark):
    rows = [(1, D(2000, 1, 1) + dt.timedelta(31 * i), i, float(i % 5) - 2) for i in range(50) if i % 7]
    got = {r.as_of: r for r in risk.specific_variance(spark.createDataFrame(rows, "sec int, as_of date, ai long, residual double"), 12, 36, 6).collect()}
    last = rows[-1]
    own = [(2 ** ((i - last[2]) / 12), e) for _, _, i, e in rows if last[2] - 35 <= i <= last[2]]
    assert got[last[1]].variance == pytest.approx(sum(w * e * e for w, e in own) / sum(w for w, _ in own)) and got[last[1]].n == len(own)
    assert rows[4][1] not in got


def test_spread_by_highs_and_lows(spark):
    """A price that doesn't move but bounces between bid and ask shows its spread; a gap overnight is taken out."""
    s = 0.01
    flat = [(1, D(2020, 1, 1 + i), 100 * (1 + s / 2), 100 * (1 - s / 2), 100.0) for i in range(4)]
    gap = [(2, D(2020, 1, 1), 101.0, 99.0, 100.0), (2, D(2020, 1, 2), 121.0, 119.0, 120.0)]
    got = {(r.sec, r.d.day): r.spread for r in risk.high_low_spread(spark.createDataFrame(flat + gap, "sec int, d date, high double, low double, close double")).collect()}
    assert got[1, 1] is None and got[1, 3] == pytest.approx(s, rel=1e-3)
    h, l0, lo = 121 - 19.0, 99.0, 119 - 19.0  # moved down by 119 - 100
    beta, gamma = np.log(h / lo) ** 2 + np.log(101 / 99) ** 2, np.log(max(h, 101) / min(lo, l0)) ** 2
    alpha = (np.sqrt(2 * beta) - np.sqrt(beta)) / risk.ROOT - np.sqrt(gamma / risk.ROOT)
    assert got[2, 2] == pytest.approx(max(0, 2 * (np.exp(alpha) - 1) / (1 + np.exp(alpha))))
    cost = risk.trading_cost(spark.createDataFrame(flat, "sec int, d date, high double, low double, close double"), 0.04).first()
    assert (cost.days, cost.volatility) == (3, 0.0) and cost.cost == pytest.approx(s / 2, rel=1e-3)


def test_returns_by_trading_days(spark):
    days = [D(2020, 1, 1) + dt.timedelta(i * 3) for i in range(12)]
    rows = [(1, d, 100.0 + i) for i, d in enumerate(days)] + [(2, days[0], 10.0), (2, days[2], 12.0), (2, days[9], 15.0)]
    got = {(r.sec, r.d): r for r in returns.horizon_returns(spark.createDataFrame(rows, "sec int, d date, level double"), [2, 5]).collect()}
    assert got[1, days[3]].r_2 == pytest.approx(105 / 103 - 1) and got[1, days[9]].r_2 == pytest.approx(111 / 109 - 1)
    assert got[1, days[10]].r_2 is None and got[1, days[7]].r_5 is None
    assert got[2, days[0]].r_2 == pytest.approx(0.2) and got[2, days[2]].r_5 is None and got[2, days[0]].r_5 == pytest.approx(0.2)


def test_a_name_delisted_within_the_month_keeps_its_return(spark):
    grid = spark.createDataFrame([(D(2020, 1, 31), 1), (D(2020, 2, 28), 2), (D(2020, 3, 31), 3)], "as_of date, ai int")
    cells = spark.createDataFrame([(s, D(2020, 1, 31), 1, 100.0) for s in (1, 2, 3)] + [(3, D(2020, 2, 28), 2, 110.0)], "sec int, as_of date, ai int, tr double")
    ends = spark.createDataFrame([(1, D(2020, 2, 20), -0.5, "deal"), (2, D(2020, 2, 20), -0.5, "unknown")], "sec int, delist_date date, terminal_return double, method string")
    last = spark.createDataFrame([(1, D(2020, 2, 19), 90.0), (2, D(2020, 2, 19), 90.0), (3, D(2020, 2, 28), 110.0)], "sec int, last_d date, last_tr double")
    got = {(r.sec, r.ai): (r.fwd, r.plain) for r in returns.forward_returns(cells, grid, ends, last).collect()}
    assert got[1, 1] == (pytest.approx(0.9 * 0.5 - 1), None) and got[2, 1] == (pytest.approx(-0.1), None)
    assert got[3, 1] == (pytest.approx(0.1), pytest.approx(0.1)) and got[3, 2] == (None, None)


def brute_disc(values, p):
    own = sorted(v for v in values if v is not None)
    return own[max(1, -(-int(round(p * 1e6)) * len(own) // 10**6)) - 1] if own else None


@pytest.mark.parametrize("bins", [64, 4096])
def test_selection_equals_sorting(spark, bins):
    rnd = random.Random(3)
    rows = [("a", rnd.choice([1.5, 2.5, -7.0])) for _ in range(200)] + [("b", rnd.gauss(0, 1) * 10 ** rnd.randint(-9, 9)) for _ in range(301)]
    rows += [("c", 5.0), ("d", None), (None, 1.0), (None, 2.0), (None, None), ("e", 1e308), ("e", -1e308), ("e", 0.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in selection.discrete_percentiles(df, "v", {"x": 0.25, "y": 0.5, "z": 1.0}, ["k"], bins).collect()}
    for k in {k for k, _ in rows}:
        own = [v for g, v in rows if g == k]
        assert [got[k].x, got[k].y, got[k].z] == [brute_disc(own, p) for p in (0.25, 0.5, 1.0)]
        assert got[k].n == sum(v is not None for v in own)
    whole = selection.discrete_percentiles(df, "v", {"x": 0.5}, bins=bins).first()
    assert (whole.n, whole.x) == (sum(v is not None for _, v in rows), brute_disc([v for _, v in rows], 0.5))
    assert tuple(selection.discrete_percentiles(df.limit(0), "v", {"x": 0.5}).first()) == (0, None)


def some_intervals(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a = D(2015, 1, 1) + dt.timedelta(rnd.randint(0, 1500))
        out.append((rnd.choice(["x", "x", "y", None]), i % 40, a, None if rnd.random() < 0.1 else a + dt.timedelta(rnd.choice([-3, 0, 5, 40, 900]))))
    return out + [("x", 1, D(2016, 1, 1), D(2016, 5, 1))] * 2


def test_resolving_equals_brute_force(spark):
    rows = some_intervals(150, 1)
    asks = [(i, random.Random(i).choice(["x", "y", "z", None]), D(2014, 12, 1) + dt.timedelta(11 * i)) for i in range(180)] + [(999, "x", None)]
    i = spark.createDataFrame(rows, "k string, sec int, valid_from date, valid_to date")
    for bin_days in (30, 366):
        got = {r.id: r.sec for r in temporal.resolve(spark.createDataFrame(asks, "id int, k string, t date"), i, "k", "t", "sec", bin_days=bin_days).collect()}
        for n, k, t in asks:
            hit = [(a, s) for kk, s, a, b in rows if k is not None and t is not None and kk == k and a <= t and (b is None or b >= t)]
            assert got[n] == (max(hit)[1] if hit else None)
        assert len(got) == len(asks)


def test_containment_equals_brute_force(spark):
    rows = [(k, a, b) for k, _, a, b in some_intervals(160, 2)]
    far = D(9999, 12, 31)
    want = {r for r in rows if not any(o != r and o[0] == r[0] and o[1] <= r[1] and (o[2] or far) >= (r[2] or far) for o in rows)}
    df = spark.createDataFrame(rows, "k string, valid_from date, valid_to date")
    for stretch in ("year", "month"):
        assert Counter(map(tuple, temporal.uncontained(df, ["k"], stretch).collect())) == Counter(want)
