"""Signals: statement ratios seen at a point in time, and price history ones.

Every function returns (sec, as_of, value) for what is economically valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.returns import dense, lagged

#: factor: (family, sign expected beforehand, financials left out) (fixed values).
REGISTRY = {
    "ebit_ev": ("value", 1, True), "gp_a": ("quality", 1, True), "accruals": ("quality", -1, True), "asset_growth": ("quality", -1, True),
    "mom_12_1": ("momentum", 1, False), "bp": ("value", 1, False), "net_issuance": ("quality", -1, False), "sue": ("events", 1, False),
    "vol_12m": ("low_risk", -1, False), "beta_36m": ("low_risk", -1, False), "trk_core_1m": ("tracker", 1, False),
}


def trailing_year(visible: DataFrame, values: list[str], span: tuple[int, int] = (240, 390)) -> DataFrame:
    """The latest period's row of each (sec, as_of), with whole: whether the last
    four visible quarters span a plausible year, and ttm_<value>: their sums,
    null unless that is so and all four have a value."""
    w = Window.partitionBy("sec", "as_of").orderBy("period_end").rowsBetween(-3, 0)
    days = F.datediff("period_end", F.min("period_end").over(w))
    whole = (F.count(F.lit(1)).over(w) == 4) & days.between(*span)
    rows = visible.withColumn("whole", whole)
    for v in values:
        rows = rows.withColumn(f"ttm_{v}", F.when(F.col("whole") & (F.count(v).over(w) == 4), F.sum(v).over(w)))
    return rows.filter("nth = 1")


def year_ago(visible: DataFrame, values: list[str], span: tuple[int, int] = (300, 430)) -> DataFrame:
    """(sec, as_of, ago_<value>): of the visible periods a year before the latest
    one, the most recent. Each group holds a few periods."""
    latest = F.max("period_end").over(Window.partitionBy("sec", "as_of"))
    rows = visible.withColumn("back", F.datediff(latest, "period_end")).filter(F.col("back").between(*span))
    best = rows.groupBy("sec", "as_of").agg(F.max(F.struct("period_end", *values)).alias("x"))
    return best.select("sec", "as_of", *[F.col(f"x.{v}").alias(f"ago_{v}") for v in values])


def truthy(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(0.0))


def statement_factors(visible: DataFrame, members: DataFrame) -> DataFrame:
    """(sec, as_of, factor, value) of the six ratios built on statements.

    members: (sec, as_of, mktcap, is_fin). A ratio that isn't valid has no row;
    those built on a year of income or on assets leave financials out.
    """
    now = trailing_year(visible, ["ebit", "gp", "ni", "cfo"])
    rows = members.join(now, ["sec", "as_of"]).join(year_ago(visible, ["assets", "shares"]), ["sec", "as_of"], "left")
    mc, ta, ago = F.col("mktcap"), truthy("assets"), truthy("ago_assets")
    ev = mc + F.col("debt") - F.col("cash")
    year = F.col("whole") & ~F.col("is_fin")
    valid_ev = (ev > F.greatest(F.lit(1e8), 0.05 * mc)) & ta.isNotNull()
    ratios = {
        "ebit_ev": F.when(year & valid_ev, F.col("ttm_ebit") / ev),
        "gp_a": F.when(year, F.col("ttm_gp") / ta),
        "accruals": F.when(year, (F.col("ttm_ni") - F.col("ttm_cfo")) / F.when(ago.isNotNull(), (ta + ago) / 2).otherwise(ta)),
        "asset_growth": F.when(year, ta / ago - 1),
        "bp": F.when(F.col("equity") > 0, F.col("equity") / mc),
        "net_issuance": truthy("shares") / F.when(F.col("ago_shares") > 0, F.col("ago_shares")) - 1,
    }
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("factor"), v.alias("value")) for k, v in ratios.items()]))
    return rows.select("sec", "as_of", each.alias("x")).select("sec", "as_of", "x.*").filter("value IS NOT NULL")


def standardised_surprise(reports: DataFrame, window: int = 8, minimum: int = 4, floor: float = 1e-9) -> DataFrame:
    """reports with an estimate + diff, sue: the surprise over the deviation of
    the ones before it. Reports without estimate don't enter the history."""
    w = Window.partitionBy("sec").orderBy("report_date").rowsBetween(-window, -1)
    rows = reports.filter("estimate IS NOT NULL").withColumn("diff", F.col("actual") - F.col("estimate"))
    sd = F.stddev_pop("diff").over(w)
    return rows.withColumn("sue", F.when((F.count("diff").over(w) >= minimum) & (sd > floor), F.round(F.col("diff") / sd, 4)))


def monthly_return(cells: DataFrame, grid: DataFrame) -> DataFrame:
    """(sec, as_of, ai, value): return over the last month of the grid."""
    d = dense(cells, grid)
    return d.withColumn("value", F.nullif("tr", F.lit(0.0)) / lagged("tr", 1) - 1).select("sec", "as_of", "ai", "value")


def volatility(cells: DataFrame, grid: DataFrame, months: int = 12) -> DataFrame:
    """(sec, as_of, ai, value): annualised deviation, all months needed."""
    w = Window.partitionBy("sec").orderBy("ai").rowsBetween(1 - months, 0)
    r = monthly_return(cells, grid)
    return r.withColumn("value", F.when(F.count("value").over(w) == months, F.stddev_samp("value").over(w) * F.sqrt(F.lit(12.0))))


def market_beta(cells: DataFrame, grid: DataFrame, benchmark: DataFrame, months: int = 36, minimum: int = 24, floor: float = 1e-10) -> DataFrame:
    """(sec, as_of, ai, value): sample covariance with the benchmark's monthly
    return over its population variance, on months that have both."""
    w = Window.partitionBy("sec").orderBy("ai").rowsBetween(1 - months, 0)
    r = monthly_return(cells, grid).join(F.broadcast(benchmark.select("as_of", "bench")), "as_of", "left")  # a row a month
    both = F.when(F.col("value").isNotNull() & F.col("bench").isNotNull(), F.col("bench"))
    ours = F.when(both.isNotNull(), F.col("value"))
    var = F.var_pop(both).over(w)
    beta = F.when((F.count(both).over(w) >= minimum) & (var > floor), F.covar_samp(ours, both).over(w) / var)
    return r.select("sec", "as_of", "ai", beta.alias("value"))
