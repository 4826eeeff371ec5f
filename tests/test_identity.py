"""Identity chains by sums over days, against brute force and in the rows they make."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import temporal
from tessera.plans import quality

START = dt.date(1999, 12, 20)


def rows_of_joins(spark, since):
    """Rows that joins of the executions from number since on have made."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store, total = spark._jsparkSession.sharedState().statusStore(), 0
    for i in range(since, store.executionsCount()):
        execution = store.executionsList(i, 1).head()
        values, nodes = store.executionMetrics(execution.executionId()), store.planGraph(execution.executionId()).allNodes()
        for n in range(nodes.size()):
            metrics = nodes.apply(n).metrics()
            for m in range(metrics.size() if "Join" in nodes.apply(n).name() else 0):
                made = metrics.apply(m)
                if made.name() == "number of output rows" and values.contains(made.accumulatorId()):
                    total += int(values.apply(made.accumulatorId()).replace(",", ""))
    return total


@pytest.mark.parametrize("seed", range(4))
def test_held_alike_equals_brute_force(spark, seed):
    rnd, rows = random.Random(seed), []
    for e in range(7):
        for k in "xyz":
            t = rnd.randrange(-3, 4)
            while t < 24 and rnd.random() < 0.8:
                end = t + rnd.randrange(12)
                rows.append((k, e, START + dt.timedelta(t), None if rnd.random() < 0.2 else START + dt.timedelta(end)))
                if rows[-1][3] is None:
                    break
                t = end + rnd.randrange(1, 4)
    rows += [("x", 99, START + dt.timedelta(5), START), (None, 1, START, None), ("y", None, START, None)]
    holds = lambda k, t: {e for key, e, f, g in rows if key == k and e is not None and f <= t and (g is None or t <= g)}
    asked = [(i, rnd.choice("xyz"), START + dt.timedelta(rnd.randrange(-5, 40)), rnd.choice("xyz"), START + dt.timedelta(rnd.randrange(-5, 40))) for i in range(400)]
    want = {i for i, a, s, b, t in asked if holds(a, s) and holds(a, s) == holds(b, t)}
    intervals = spark.createDataFrame(rows, "symbol string, sec int, valid_from date, valid_to date")
    got = temporal.held_alike(spark.createDataFrame(asked, "id int, a_key string, a_time date, b_key string, b_time date"), intervals, "symbol", "sec")
    assert sorted(r.id for r in got.collect()) == sorted(want) and 10 < len(want) < 390


def test_sharing_is_counted_and_not_taken_from_digests(spark, monkeypatch):
    rows = [("x", 1, START, None), ("x", 2, START, None), ("y", 1, START, None), ("y", 3, START, None), ("z", 2, START, None), ("z", 1, START, None)]
    asked = [(1, "x", START, "y", START), (2, "x", START, "z", START)]
    monkeypatch.setattr(temporal.F, "xxhash64", lambda *c: F.lit(0).cast("long"))  # digests that tell nothing apart
    got = temporal.held_alike(spark.createDataFrame(asked, "id int, a_key string, a_time date, b_key string, b_time date"), spark.createDataFrame(rows, "symbol string, sec int, valid_from date, valid_to date"), "symbol", "sec")
    assert [r.id for r in got.collect()] == [2]


def test_a_symbol_that_many_securities_use_makes_no_pairs(spark, tmp_path):
    """3,000 securities change from one symbol to another: each symbol is held by
    up to as many on a day, and a join by symbol makes their square."""
    n = 3000
    sec, day = F.col("id") % n * 200, F.expr("timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast(id * 7 % 300 as int))")
    late = F.when(F.col("id") < n, day).otherwise(F.expr("timestamp_ntz'1998-01-01 00:00:00' + make_dt_interval(cast(id * 7 % 300 as int))"))
    stays = F.expr("timestamp_ntz'1995-12-01 00:00:00'")  # so that the first symbol is held by all of them then
    orders = spark.range(2 * n).select(sec.alias("o_custkey"), late.alias("o_orderdate"))
    orders.union(spark.range(n).select((F.col("id") * 200).alias("o_custkey"), stays.alias("o_orderdate"))).write.parquet(str(tmp_path / "orders.parquet"))
    since = spark._jsparkSession.sharedState().statusStore().executionsCount()
    got = quality.gate_identity_chains(spark, str(tmp_path)).collect()
    assert (got[0].rows_, got[0].violations) == (n, 0)
    assert rows_of_joins(spark, since) < 40 * n
