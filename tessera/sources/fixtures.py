"""Panel tables of the research engine, derived from the star-schema test tables.

Suppliers stand for securities, line items for trades, orders for earnings
reports and symbol usage, and so on. Each adapter is a plain projection or
aggregation; those that many queries start from are stored by their key.
``CTES`` holds the same definitions in DuckDB SQL for the oracles.

Money is summed in whole cents, so that sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.stored import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str | Column) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) * 100).cast("long")


@stored("sec")
def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars (sec, d, close, volume)."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sec"), F.col("l_shipdate").cast("date").alias("d"), cents("l_extendedprice").alias("c"), F.col("l_quantity").cast("long").alias("q"))
    return li.groupBy("sec", "d").agg((F.sum("c").cast("double") / F.sum("q") / 100).alias("close"), F.sum("q").cast("double").alias("volume"))


def securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sec, sector, is_fin, shares)."""
    s = table(spark, sf_dir, "supplier")
    sec = F.col("s_suppkey")
    return s.select(sec.alias("sec"), F.concat(F.lit("S"), (F.col("s_nationkey") % 5).cast("string")).alias("sector"), (F.col("s_nationkey") % 7 == 0).alias("is_fin"), (1000000 + sec * 7919 % 1000 * 10000).cast("double").alias("shares"))


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corporate actions (sec, d, kind, value): dividends and splits."""
    b = bars(spark, sf_dir)
    day = F.dayofyear("d")
    div = b.filter((F.col("sec") + day) % 97 == 0).select("sec", "d", F.lit("dividend").alias("kind"), (F.floor(F.col("close")) / 100).alias("value"))
    split = b.filter((F.col("sec") * 31 + day) % 487 == 0).select("sec", "d", F.lit("split").alias("kind"), F.lit(2.0).alias("value"))
    return div.unionByName(split)


@stored()
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-end grid (as_of, ai): last day of each month with enough bars."""
    from tessera.operators.universe import trading_grid

    return trading_grid(bars(spark, sf_dir), min_rows=5)


@stored("sec")
def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sec, d, close, level): bars up to a delisting, and the total return index
    over them as it is stored, with six places."""
    from tessera.operators.returns import daily_returns, index_level

    ends = delistings(spark, sf_dir).select("sec", "delist_date")
    alive = bars(spark, sf_dir).join(ends, "sec", "left").filter("delist_date IS NULL OR d <= delist_date").drop("delist_date")
    return index_level(daily_returns(alive, actions(spark, sf_dir))).select("sec", "d", "close", F.round("level", 6).alias("level"))


@stored("sec")
def month_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sec, as_of, ai, tr, close): the last index level and close in each month
    of the grid. The test securities trade on few days, so it is the month's last
    day of theirs and not the grid's very day."""
    last = levels(spark, sf_dir).groupBy("sec", F.trunc("d", "MM").alias("m")).agg(F.max(F.struct("d", "level", "close")).alias("x"))
    grid = calendar(spark, sf_dir).withColumn("m", F.trunc("as_of", "MM"))
    return last.join(F.broadcast(grid), "m").select("sec", "as_of", "ai", F.col("x.level").alias("tr"), "x.close")  # a grid row a month


@stored("sec")
def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitemporal quarterly statements: (sec, period_end, vintage_id, accepted,
    timing_pit, ebit, gp, ni, cfo, assets, debt, cash, equity, shares).

    Vintage 1 leaves out returned items, vintage 2 restates with all of them.
    """
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("sec"), F.last_day(F.add_months(F.date_trunc("quarter", "l_shipdate").cast("date"), 2)).alias("period_end"),
        cents("l_extendedprice").alias("c"), F.col("l_quantity").cast("long").alias("q"), F.col("l_returnflag").alias("f"),
    )
    both = li.select("*", F.explode(F.when(F.col("f") == "R", F.array(F.lit(2))).otherwise(F.array(F.lit(1), F.lit(2)))).alias("vintage_id"))
    g = both.groupBy("sec", "period_end", "vintage_id").agg(F.sum("c").alias("rev"), F.sum("q").alias("q"), F.count("*").alias("n"))
    lag = (F.col("sec") * 13 + F.month("period_end") * 7) % 80 + F.when(F.col("vintage_id") == 2, 90).otherwise(0)
    rev = F.col("rev").cast("double") / 100
    return g.select(
        "sec", "period_end", "vintage_id",
        (F.date_add("period_end", lag.cast("int")).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.lit(9) + F.col("sec") % 12).cast("int"))).alias("accepted"),
        (lag > 10).alias("timing_pit"),
        (rev * 0.25).alias("ebit"), (rev * 0.5).alias("gp"), (rev * 0.125).alias("ni"), (F.col("q") * 100.0).alias("cfo"),
        F.when(F.col("n") % 11 != 0, rev * 4 + F.col("q")).alias("assets"), (rev * 0.5).alias("debt"), F.when(F.col("n") % 13 != 0, rev * 0.25).alias("cash"),
        (rev * 2 - F.col("q") * 1500.0).alias("equity"), (F.col("q") * 1000.0).alias("shares"),
    )


def surprises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sec, report_date, actual, estimate?): one row a security and day."""
    o = table(spark, sf_dir, "orders")
    est = F.when(F.col("p") != "5-LOW", F.col("c") - F.col("c") % 5000 + 1000)
    g = o.groupBy((F.col("o_custkey") % 400).alias("sec"), F.col("o_orderdate").cast("date").alias("report_date")).agg(F.sum(cents("o_totalprice")).alias("c"), F.min("o_orderpriority").alias("p"))
    return g.select("sec", "report_date", (F.col("c") / 100000.0).alias("actual"), (est / 100000.0).alias("estimate"))


def symbol_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol usage (symbol, sec, valid_from, valid_to?), ends closed, null open."""
    o = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    g = o.groupBy(F.col("o_custkey").alias("sec"), (F.col("o_custkey") * 7 + F.floor(F.col("y") / 3)) % 200).agg(F.min("o_orderdate").cast("date").alias("valid_from"), F.max("o_orderdate").cast("date").alias("last"))
    g = g.toDF("sec", "s", "valid_from", "last")
    return g.select(F.concat(F.lit("SYM"), F.col("s").cast("string")).alias("symbol"), "sec", "valid_from", F.when(F.col("sec") % 10 != 0, F.col("last")).alias("valid_to"))


def delistings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sec, delist_date, terminal_return, method)."""
    b = bars(spark, sf_dir).filter(F.col("sec") % 10 == 3)
    g = b.groupBy("sec").agg(F.max("d").alias("x"))
    return g.select("sec", F.date_sub("x", (400 + F.col("sec") % 37 * 20).cast("int")).alias("delist_date"), ((F.col("sec") % 7 - 3) / 10.0).alias("terminal_return"), F.when(F.col("sec") % 20 == 3, "deal").otherwise("unknown").alias("method"))


CTES = {
    "bars": """SELECT l_suppkey AS sec, CAST(l_shipdate AS DATE) AS d,
  CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE) AS close,
  CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS volume
  FROM lineitem GROUP BY 1, 2""",
    "securities": """SELECT s_suppkey AS sec, 'S' || CAST(s_nationkey % 5 AS VARCHAR) AS sector, s_nationkey % 7 = 0 AS is_fin,
  CAST(1000000 + s_suppkey * 7919 % 1000 * 10000 AS DOUBLE) AS shares FROM supplier""",
    "actions": """SELECT sec, d, 'dividend' AS kind, FLOOR(close) / CAST(100 AS DOUBLE) AS value FROM bars WHERE (sec + dayofyear(d)) % 97 = 0
  UNION ALL SELECT sec, d, 'split', CAST(2 AS DOUBLE) FROM bars WHERE (sec * 31 + dayofyear(d)) % 487 = 0""",
    "calendar": """SELECT as_of, ROW_NUMBER() OVER (ORDER BY as_of) AS ai FROM (
  SELECT MAX(d) AS as_of FROM (SELECT d FROM bars GROUP BY d HAVING COUNT(*) >= 5) GROUP BY date_trunc('month', d))""",
    "statements": """SELECT sec, period_end, vintage_id,
  CAST(period_end AS TIMESTAMP) + to_days(CAST(lag AS INTEGER)) + to_hours(9 + sec % 12) AS accepted, lag > 10 AS timing_pit,
  rev * 0.25::DOUBLE AS ebit, rev * 0.5::DOUBLE AS gp, rev * 0.125::DOUBLE AS ni, q * 100::DOUBLE AS cfo,
  CASE WHEN n % 11 <> 0 THEN rev * 4 + q END AS assets, rev * 0.5::DOUBLE AS debt, CASE WHEN n % 13 <> 0 THEN rev * 0.25::DOUBLE END AS cash,
  rev * 2 - q * 1500::DOUBLE AS equity, q * 1000::DOUBLE AS shares FROM (
  SELECT sec, period_end, vintage_id, CAST(SUM(c) AS DOUBLE) / 100::DOUBLE AS rev, CAST(SUM(q) AS DOUBLE) AS q, COUNT(*) AS n,
    (sec * 13 + month(period_end) * 7) % 80 + CASE WHEN vintage_id = 2 THEN 90 ELSE 0 END AS lag FROM (
    SELECT l_suppkey AS sec, last_day(CAST(date_trunc('quarter', l_shipdate) AS DATE) + INTERVAL 2 MONTH) AS period_end,
      CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS c, CAST(l_quantity AS BIGINT) AS q, v.vintage_id
    FROM lineitem JOIN (VALUES (1), (2)) v(vintage_id) ON v.vintage_id = 2 OR l_returnflag <> 'R')
  GROUP BY 1, 2, 3)""",
    "surprises": """SELECT sec, report_date, c / 100000::DOUBLE AS actual, CASE WHEN p <> '5-LOW' THEN (c - c % 5000 + 1000) / 100000::DOUBLE END AS estimate FROM (
  SELECT o_custkey % 400 AS sec, CAST(o_orderdate AS DATE) AS report_date, CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS c, MIN(o_orderpriority) AS p
  FROM orders GROUP BY 1, 2)""",
    "symbol_map": """SELECT 'SYM' || CAST(s AS VARCHAR) AS symbol, sec, valid_from, CASE WHEN sec % 10 <> 0 THEN last END AS valid_to FROM (
  SELECT o_custkey AS sec, (o_custkey * 7 + year(o_orderdate) // 3) % 200 AS s, CAST(MIN(o_orderdate) AS DATE) AS valid_from, CAST(MAX(o_orderdate) AS DATE) AS last
  FROM orders GROUP BY 1, 2)""",
    "delistings": """SELECT sec, MAX(d) - CAST(400 + sec % 37 * 20 AS INTEGER) AS delist_date, (sec % 7 - 3) / 10::DOUBLE AS terminal_return,
  CASE WHEN sec % 20 = 3 THEN 'deal' ELSE 'unknown' END AS method FROM bars WHERE sec % 10 = 3 GROUP BY sec""",
    "levels": """SELECT sec, d, close, ROUND(100 * product(1 + COALESCE(CASE WHEN prev <> 0 THEN (close * COALESCE(split, 1) + COALESCE(dividend, 0)) / prev END - 1, 0))
    OVER (PARTITION BY sec ORDER BY d ROWS UNBOUNDED PRECEDING), 6) AS level FROM (
  SELECT b.sec, b.d, b.close, lag(b.close) OVER (PARTITION BY b.sec ORDER BY b.d) AS prev, a.split, a.dividend FROM bars b LEFT JOIN delistings x ON x.sec = b.sec
  LEFT JOIN (SELECT sec, d, MAX(CASE WHEN kind = 'split' THEN value END) AS split, SUM(CASE WHEN kind = 'dividend' THEN value END) AS dividend FROM actions GROUP BY 1, 2) a
    ON a.sec = b.sec AND a.d = b.d WHERE x.sec IS NULL OR b.d <= x.delist_date)""",
    "month_end": """SELECT l.sec, c.as_of, c.ai, l.tr, l.close FROM (SELECT sec, date_trunc('month', d) AS m, max_by(level, d) AS tr, max_by(close, d) AS close FROM levels GROUP BY 1, 2) l
  JOIN calendar c ON date_trunc('month', c.as_of) = l.m""",
}


def with_ctes(body: str, **more: str) -> str:
    """DuckDB SQL: the fixtures and further definitions in front of a query."""
    parts = [f"{name} AS MATERIALIZED ({sql})" for name, sql in (CTES | more).items()]
    return "WITH " + ",\n".join(parts) + "\n" + body
