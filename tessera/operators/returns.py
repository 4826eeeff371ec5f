"""Total returns, reconciliation, forward returns and momentum on a month grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_returns(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """bars + prev, ratio, dividend, r: simple total returns."""
    a = actions.groupBy("sec", "d").agg(F.max(F.when(F.col("kind") == "split", F.col("value"))).alias("split"), F.sum(F.when(F.col("kind") == "dividend", F.col("value"))).alias("dividend"))
    w = Window.partitionBy("sec").orderBy("d")
    rows = bars.join(a, ["sec", "d"], "left").withColumn("prev", F.lag("close").over(w))
    return rows.withColumn("r", F.try_divide(F.col("close") * F.coalesce("split", F.lit(1.0)) + F.coalesce("dividend", F.lit(0.0)), F.col("prev")) - 1)


def index_level(returns: DataFrame, start: float = 100.0, base: Column | None = None) -> DataFrame:
    """returns + level: compounded unrounded from the start."""
    w = Window.partitionBy("sec").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    first = F.lit(start) if base is None else base
    return returns.withColumn("level", first * F.product(1 + F.coalesce("r", F.lit(0.0))).over(w))


def extended_level(stored: DataFrame, new_returns: DataFrame) -> DataFrame:
    """Levels for days after the last stored one, compounded from its stored
    (rounded) value. What is not later than that is ignored."""
    last = stored.groupBy("sec").agg(F.max(F.struct("d", "level")).alias("x")).select("sec", F.col("x.d").alias("last_d"), F.col("x.level").alias("base"))
    later = new_returns.join(last, "sec").filter("d > last_d")
    return index_level(later, base=F.col("base"))


def dense(cells: DataFrame, grid: DataFrame, beyond: int = 12) -> DataFrame:
    """Every month of the grid from a security's first cell to ``beyond`` months
    after its last, with nulls where it has no cell, so that lags count months
    and not rows."""
    spans = cells.groupBy("sec").agg(F.min("ai").alias("lo"), F.max("ai").alias("hi"))
    every = spans.select("sec", F.explode(F.sequence("lo", F.col("hi") + beyond)).alias("ai")).join(F.broadcast(grid.select("as_of", "ai")), "ai")  # a grid row a month
    return every.join(cells.drop("ai"), ["sec", "as_of"], "left")


def lagged(c: str, n: int) -> Column:
    """The value n months back, zero counting as missing."""
    return F.nullif(F.lag(c, n).over(Window.partitionBy("sec").orderBy("ai")), F.lit(0.0))


def momentum(cells: DataFrame, grid: DataFrame, near: int = 1, far: int = 12) -> DataFrame:
    """(sec, as_of, ai, value): return from far to near months back."""
    d = dense(cells, grid)
    return d.withColumn("value", lagged("tr", near) / lagged("tr", far) - 1).select("sec", "as_of", "ai", "value")


def forward_returns(cells: DataFrame, grid: DataFrame, delistings: DataFrame | None = None, last_trades: DataFrame | None = None, compounding_method: str = "deal") -> DataFrame:
    """(sec, as_of, ai, fwd, plain): return to the next as_of, or to the last trade
    in between where there is no next cell, compounded with the terminal return of
    a delisting in that span by the method given; plain is without that fallback
    and the only one where last trades aren't given."""
    w = Window.partitionBy("sec").orderBy("ai")
    rows = dense(cells, grid).withColumn("nxt", F.lead("as_of").over(w)).withColumn("tr1", F.nullif(F.lead("tr").over(w), F.lit(0.0))).withColumn("tr0", F.nullif("tr", F.lit(0.0)))
    full = F.col("tr1") / F.col("tr0") - 1
    if last_trades is None:
        return rows.select("sec", "as_of", "ai", full.alias("fwd"))
    rows = rows.join(last_trades.select("sec", "last_d", "last_tr"), "sec", "left").join(delistings.select("sec", "delist_date", "terminal_return", "method"), "sec", "left")
    within = lambda c: (F.col(c) > F.col("as_of")) & (F.col(c) <= F.col("nxt"))
    part = F.when(within("last_d"), F.col("last_tr") / F.col("tr0") - 1)
    ends = within("delist_date") & (F.col("method") == compounding_method) & F.col("terminal_return").isNotNull()
    part = F.when(ends, (1 + part) * (1 + F.col("terminal_return")) - 1).otherwise(part)
    return rows.select("sec", "as_of", "ai", F.coalesce(full, part).alias("fwd"), full.alias("plain"))


def horizon_returns(levels: DataFrame, horizons: list[int]) -> DataFrame:
    """levels (sec, d, level) + pos, r_<h>: the return to the last trade within
    the next h days of the trading calendar, for all horizons from one order of a
    security's rows; null where the calendar ends before, or nothing trades.

    The calendar, a row a day, gives every day its position; it is broadcast."""
    days = levels.select("d").distinct()
    calendar = days.withColumn("pos", F.row_number().over(Window.orderBy("d"))).withColumn("last", F.count("*").over(Window.partitionBy(F.lit(0))))
    rows = levels.join(F.broadcast(calendar), "d")
    w = Window.partitionBy("sec").orderBy("pos")
    for h in horizons:
        there = F.last("level").over(w.rangeBetween(1, h))
        rows = rows.withColumn(f"r_{h}", F.when(F.col("pos") + h <= F.col("last"), there / F.nullif("level", F.lit(0.0)) - 1))
    return rows.drop("last")


def match_score(pairs: DataFrame) -> DataFrame:
    """sec, n, bad, pct, first_mismatch from (sec, d, mismatch, insane): the share
    of days that match, null where the other series is unusable."""
    ok = ~F.col("insane")
    g = pairs.groupBy("sec").agg(F.count_if(ok).alias("n"), F.count_if(F.col("insane")).alias("bad"), F.count_if(ok & F.col("mismatch")).alias("mism"), F.min(F.when(ok & F.col("mismatch"), F.col("d"))).alias("first_mismatch"))
    usable = (F.col("n") > 0) & (F.col("bad") <= F.greatest(F.lit(10.0), 0.02 * F.col("n")))
    return g.select("sec", "n", "bad", F.when(usable, F.round(100 * (1 - F.col("mism") / F.col("n")), 2)).alias("pct"), "first_mismatch")
