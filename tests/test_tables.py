"""Keyed tables by deltas, and months rebuilt by a manifest."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.sources import keyed_table
from tessera.streaming import recompute

D = dt.date


@pytest.fixture()
def table(spark, request):
    t = keyed_table.KeyedTable(spark, f"kt_{abs(hash(request.node.name))}", "k", 4)
    yield t
    t.drop()


@pytest.mark.parametrize("compact", [False, True])
def test_batches_in_any_mix_equal_a_dict(spark, table, compact):
    rnd, want = random.Random(6), {}
    schema = "k long, v string"
    rows = [(i, f"base{i}") for i in range(50)]
    table.create(spark.createDataFrame(rows + [(None, "no key"), (3, "base9")], schema))
    want.update(rows)
    for n in range(6):
        batch = [(rnd.randint(0, 90), f"{n}.{rnd.randint(0, 99):02}") for _ in range(rnd.choice([0, 1, 30]))] + [(None, "x")]
        first = {}
        for k, v in sorted((b for b in batch if b[0] is not None), key=lambda b: b[1]):
            first.setdefault(k, v)
        if n % 2:
            table.insert_new(spark.createDataFrame(batch, schema), ["v"])
            want = first | want
        else:
            table.upsert(spark.createDataFrame(batch, schema), ["v"])
            want = want | first
        if compact and n in (1, 4):
            table.compact()
        again = keyed_table.KeyedTable(spark, table.name, "k", 4)  # all state is in the catalogue
        got = [tuple(r) for r in again.read().collect()]
        assert len(got) == len(want) and dict(got) == want


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_the_base_is_not_shuffled(spark, table):
    table.create(spark.range(20000).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    table.upsert(spark.range(100).select((F.col("id") * 7).alias("k"), F.lit("b").alias("v")))
    assert exchanges(table.read()) == 0
    table.upsert(spark.range(50).select((F.col("id") * 11).alias("k"), F.lit("c").alias("v")))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    base = plan[plan.index("LeftAnti") : plan.index("\n   :  +- ")]  # the left side of the join
    assert "FileScan" in base and "Exchange" not in base and "Exchange" in plan
    assert table.read().groupBy("v").count().orderBy("v").collect() == [("a", 20000 - 100 - 50 + len({7 * i for i in range(100)} & {11 * i for i in range(50)})), ("b", 100 - len({7 * i for i in range(100)} & {11 * i for i in range(50)})), ("c", 50)]


def rows(spark, cells):
    return spark.createDataFrame(cells, "m date, sec int, x double")


def months(n):
    return [D(2020, 1 + i, 28) for i in range(n)]


def test_only_changed_months_are_built(spark, tmp_path):
    cells = [(m, s, float(s)) for m in months(5) for s in range(3)]
    table = recompute.MonthlyTable(spark, str(tmp_path), "m", "n long, x double")
    asked = []

    def build(source):
        def make(wanted):
            asked.append(sorted(r.m for r in wanted.collect()))
            return source.join(F.broadcast(wanted), "m").groupBy("m").agg(F.count("*").alias("n"), F.sum("x").alias("x"))

        return make

    def refresh(source):
        got = table.refresh(source, build(source))
        full = source.groupBy("m").agg(F.count("*").alias("n"), F.sum("x").alias("x"))
        assert sorted((r.m, r.n, r.x) for r in table.read().collect()) == sorted((r.m, r.n, r.x) for r in full.collect())
        return got

    assert refresh(rows(spark, cells)) == months(5)
    assert refresh(rows(spark, list(reversed(cells)))) == [] and len(asked) == 1  # order doesn't count
    cells[4] = (cells[4][0], 1, None)
    assert refresh(rows(spark, cells)) == [months(5)[1]]
    assert refresh(rows(spark, [c for c in cells if c[0] != months(5)[2]] + [(D(2020, 9, 28), 1, 1.0)])) == [months(5)[2], D(2020, 9, 28)]
    assert refresh(rows(spark, [])) == [m for m in months(5) if m != months(5)[2]] + [D(2020, 9, 28)]


def test_a_refresh_that_fails_is_done_over(spark, tmp_path):
    cells = [(m, 1, 1.0) for m in months(3)]
    table = recompute.MonthlyTable(spark, str(tmp_path), "m", "x double")
    make = lambda source: lambda wanted: source.join(F.broadcast(wanted), "m").select("m", "x")
    first = rows(spark, cells)
    table.refresh(first, make(first))

    def broken(wanted):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        table.refresh(rows(spark, cells[:2] + [(months(3)[2], 1, 2.0)]), broken)
    assert table.refresh(first, make(first)) == [months(3)[2]]  # back as it was, but that month was struck
    assert sorted(r.m for r in table.read().collect()) == months(3)


def test_a_failed_gate_raises(spark):
    assert recompute.required(spark.sql("SELECT true AS passed, 1 AS n"), "one").first().n == 1
    for gate in ("SELECT false AS passed", "SELECT CAST(NULL AS BOOLEAN) AS passed", "SELECT true AS passed WHERE false"):
        with pytest.raises(recompute.GateFailed, match="gate"):
            recompute.required(spark.sql(gate), "gate")
