"""Trading grid, liquidity, eligibility and size buckets of the monthly universe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trading_grid(bars: DataFrame, min_rows: int = 100) -> DataFrame:
    """(as_of, ai): the last day of each month on which enough securities traded,
    numbered from 1. Two partial aggregations; the grid has a row a month."""
    days = bars.groupBy("d").count().filter(F.col("count") >= min_rows)
    grid = days.groupBy(F.trunc("d", "MM").alias("m")).agg(F.max("d").alias("as_of"))
    return grid.select("as_of", F.row_number().over(Window.orderBy("as_of")).cast("long").alias("ai"))


def complete_months(rows: DataFrame, today: Column, as_of: str = "as_of") -> DataFrame:
    """rows without those of the month that today lies in, which isn't over."""
    return rows.filter(F.trunc(as_of, "MM") < F.trunc(today, "MM"))


def upper_median(x: Column, window) -> Column:
    """The middle of the sorted values in a frame, the upper one of two."""
    values = F.sort_array(F.collect_list(x).over(window))
    return F.get(values, F.floor(F.size(values) / 2).cast("int"))


def trailing_adv(bars: DataFrame, rows: int = 63, minimum: int = 40) -> DataFrame:
    """bars + adv: upper median of daily value over trailing rows, null if too few."""
    w = Window.partitionBy("sec").orderBy("d").rowsBetween(1 - rows, 0)
    value = F.col("close") * F.col("volume")
    return bars.withColumn("adv", F.when(F.count(value).over(w) >= minimum, upper_median(value, w)))


def snapshots(bars: DataFrame, grid: DataFrame, shares: DataFrame, adv_rows: int = 63, adv_minimum: int = 40) -> DataFrame:
    """(as_of, sec, price, adv, mktcap, gap): each security's last bar in the
    month of each as_of, at or before it."""
    b = trailing_adv(bars, adv_rows, adv_minimum)
    g = grid.select("as_of", F.trunc("as_of", "MM").alias("m"))
    joined = b.withColumn("m", F.trunc("d", "MM")).join(F.broadcast(g), "m").filter("d <= as_of")  # a row a month
    last = joined.groupBy("as_of", "sec").agg(F.max(F.struct("d", "close", "adv")).alias("x"))
    out = last.join(shares.select("sec", "shares"), "sec")
    return out.select("as_of", "sec", F.col("x.close").alias("price"), F.col("x.adv").alias("adv"), (F.col("x.close") * F.col("shares")).alias("mktcap"), F.datediff("as_of", "x.d").alias("gap"))


def eligible(min_mktcap: float, min_adv: float, min_price: float, max_gap: int) -> Column:
    ok = (F.col("mktcap") >= min_mktcap) & (F.col("adv") >= min_adv) & (F.col("price") >= min_price) & (F.col("gap") <= max_gap)
    return F.coalesce(ok, F.lit(False))


def exclusion_reason(min_mktcap: float, min_adv: float, min_price: float, max_gap: int) -> Column:
    """The first bar that a security misses; null for members."""
    return (
        F.when(F.col("mktcap").isNull(), "mktcap-missing").when(F.col("adv").isNull(), "adv-warmup").when(F.col("mktcap") < min_mktcap, "cap")
        .when(F.col("price") < min_price, "price").when((F.col("adv") < min_adv) | (F.col("gap") > max_gap), "adv/staleness")
    )


def size_buckets(members: DataFrame) -> DataFrame:
    """members + size_bucket 1 to 3 by market cap within each as_of."""
    return members.withColumn("size_bucket", F.ntile(3).over(Window.partitionBy("as_of").orderBy("mktcap", "sec")))
