"""Risk and cost: shrunk covariance, specific variance, spreads from highs and lows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shrunk_covariance(series: DataFrame, months: int = 36, minimum: int = 12) -> DataFrame:
    """(as_of, a, b, n, cov, intensity, shrunk) for a <= b at every month, over
    the last ``months`` rows of series (as_of, term, value).

    Covariances between terms are drawn towards nil, variances stay. How far is
    the sum of the covariances' sampling variances over that of their squares.
    All moments up to the fourth are window sums over a pair's products, so one
    pass over pairs of terms gives both; pairs are a registry's, and months its
    history.
    """
    x, y = (series.select("as_of", F.col("term").alias(k), F.col("value").alias(f"x{k}")).filter(f"x{k} IS NOT NULL") for k in "ab")
    rows = x.join(y, "as_of").filter("a <= b")
    w = Window.partitionBy("a", "b").orderBy("as_of").rowsBetween(1 - months, 0)
    u, v = F.col("xa"), F.col("xb")
    sums = {"s10": u, "s01": v, "s20": u * u, "s02": v * v, "s11": u * v, "s21": u * u * v, "s12": u * v * v, "s22": u * u * v * v}
    m = rows.select("as_of", "a", "b", F.count("*").over(w).alias("n"), *[F.avg(c).over(w).alias(k) for k, c in sums.items()])
    p, q = F.col("s10"), F.col("s01")
    cov = F.col("s11") - p * q
    # the mean of the squared products of deviations
    squared = (
        F.col("s22") - 2 * q * F.col("s21") - 2 * p * F.col("s12") + q * q * F.col("s20") + p * p * F.col("s02") + 4 * p * q * F.col("s11") - 3 * p * p * q * q
    )
    m = m.withColumn("cov", cov).withColumn("noise", F.greatest((squared - cov * cov) / F.col("n"), F.lit(0.0))).filter(F.col("n") >= minimum)
    month, off = Window.partitionBy("as_of"), F.col("a") < F.col("b")
    total = lambda c: F.coalesce(F.sum(F.when(off, c)).over(month), F.lit(0.0))
    size = total(F.col("cov") * F.col("cov"))
    intensity = F.when(size > 1e-30, F.least(total(F.col("noise")) / size, F.lit(1.0))).otherwise(1.0)
    m = m.withColumn("intensity", intensity)
    return m.select("as_of", "a", "b", "n", "cov", "intensity", F.when(off, F.col("cov") * (1 - F.col("intensity"))).otherwise(F.col("cov")).alias("shrunk"))


def specific_variance(residuals: DataFrame, half_life: float = 12.0, months: int = 36, minimum: int = 6) -> DataFrame:
    """(sec, as_of, n, variance): the mean square of a name's residuals
    (sec, as_of, ai, residual) over the last months, each half as heavy as one
    ``half_life`` months later."""
    w = Window.partitionBy("sec").orderBy("ai").rangeBetween(1 - months, 0)
    weight = F.pow(F.lit(2.0), F.col("ai") / half_life)
    rows = residuals.filter("residual IS NOT NULL").withColumn("n", F.count("*").over(w))
    rows = rows.withColumn("variance", F.sum(weight * F.col("residual") * F.col("residual")).over(w) / F.sum(weight).over(w))
    return rows.filter(F.col("n") >= minimum).select("sec", "as_of", "n", "variance")


ROOT = 3 - 2 * math.sqrt(2)


def high_low_spread(days: DataFrame) -> DataFrame:
    """days (sec, d, high, low, close) + spread: the proportional spread that the
    ranges of a day and of the trading day before make likely: a range grows with
    the root of time by volatility, but not by spread. A day that opens a gap over
    the close before is moved back by it; estimates below nil are nil; a
    security's first day has none."""
    w = Window.partitionBy("sec").orderBy("d")
    rows = days.withColumn("_c", F.lag("close").over(w)).withColumn("_h", F.lag("high").over(w)).withColumn("_l", F.lag("low").over(w))
    gap = F.when(F.col("low") > F.col("_c"), F.col("low") - F.col("_c")).when(F.col("high") < F.col("_c"), F.col("high") - F.col("_c")).otherwise(0.0)
    rows = rows.withColumn("_hi", F.col("high") - gap).withColumn("_lo", F.col("low") - gap)
    square = lambda c: c * c
    beta = square(F.ln(F.col("_hi") / F.col("_lo"))) + square(F.ln(F.col("_h") / F.col("_l")))
    gamma = square(F.ln(F.greatest("_hi", "_h") / F.least("_lo", "_l")))
    alpha = (F.sqrt(2 * beta) - F.sqrt(beta)) / ROOT - F.sqrt(gamma / ROOT)
    spread = F.greatest(2 * (F.exp(alpha) - 1) / (1 + F.exp(alpha)), F.lit(0.0))
    return rows.withColumn("spread", F.when(F.col("_h").isNotNull() & (F.col("_lo") > 0), spread)).drop("_c", "_h", "_l", "_hi", "_lo")


def trading_cost(days: DataFrame, participation: float = 0.01, scale: float = 1.0) -> DataFrame:
    """(sec, m, days, spread, volatility, cost) a month: half the mean spread, and
    the daily volatility times the root of the share of volume that is traded."""
    w = Window.partitionBy("sec").orderBy("d")
    rows = high_low_spread(days).withColumn("r", F.ln(F.col("close") / F.lag("close").over(w)))
    g = rows.groupBy("sec", F.trunc("d", "MM").alias("m")).agg(F.count("spread").alias("days"), F.avg("spread").alias("spread"), F.stddev_pop("r").alias("volatility"))
    cost = F.col("spread") / 2 + scale * F.col("volatility") * math.sqrt(participation)
    return g.filter("days > 0").withColumn("cost", cost)
