"""Queries over price history: returns, levels, liquidity, universe, momentum."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import predicates
from tessera.operators import factors, returns, universe
from tessera.operators.crosssection import counted_spread
from tessera.plans.registry import query
from tessera.sources import fixtures as X
from tessera.sources.stored import stored

DAILY = """SELECT sec, d, close, prev, CASE WHEN prev <> 0 THEN (close * COALESCE(split, 1) + COALESCE(dividend, 0)) / prev END - 1 AS r FROM (
  SELECT b.sec, b.d, b.close, lag(b.close) OVER (PARTITION BY b.sec ORDER BY b.d) AS prev, a.split, a.dividend FROM bars b LEFT JOIN (
    SELECT sec, d, MAX(CASE WHEN kind = 'split' THEN value END) AS split, SUM(CASE WHEN kind = 'dividend'
    THEN value END) AS dividend FROM actions GROUP BY 1, 2) a ON a.sec = b.sec AND a.d = b.d)"""


def daily(spark, d):
    return returns.daily_returns(X.bars(spark, d), X.actions(spark, d))


@query("SELECT as_of, ai FROM calendar")
def universe_month_end(spark, d):
    return X.calendar(spark, d)


@query("SELECT sec, d, ROUND(r, 8) AS r FROM daily", daily=DAILY)
def daily_total_return(spark, d):
    return daily(spark, d).select("sec", "d", F.round("r", 8).alias("r"))


LEVEL = """SELECT sec, d, 100 * product(1 + COALESCE(r, 0)) OVER (PARTITION BY sec ORDER BY d ROWS UNBOUNDED PRECEDING) AS level FROM daily"""


@query("SELECT sec, date_trunc('month', d)::DATE AS m, ROUND(arg_max(level, d), 4) AS level FROM lvl GROUP BY 1, 2", daily=DAILY, lvl=LEVEL)
def tr_index(spark, d):
    rows = returns.index_level(daily(spark, d))
    return rows.groupBy("sec", F.trunc("d", "MM").alias("m")).agg(F.round(F.max_by("level", "d"), 4).alias("level"))


@query("""SELECT sec, arg_max(n, d) AS days, ROUND(arg_max(base * g, d), 4) AS level
  FROM (SELECT r.sec, r.d, s.level AS base, product(1 + COALESCE(r.r, 0)) OVER w AS g, COUNT(*) OVER w AS n
  FROM daily r JOIN (SELECT sec, MAX(d) AS last_d, ROUND(arg_max(level, d), 6) AS level FROM lvl WHERE d < DATE '2000-01-01'
  GROUP BY 1) s ON s.sec = r.sec AND r.d > s.last_d
  WINDOW w AS (PARTITION BY r.sec ORDER BY r.d ROWS UNBOUNDED PRECEDING)) GROUP BY 1""", daily=DAILY, lvl=LEVEL)
def tr_extension(spark, d):
    r = daily(spark, d)
    stored = returns.index_level(r).filter("d < DATE'2000-01-01'").select("sec", "d", F.round("level", 6).alias("level"))
    rows = returns.extended_level(stored, r.select("sec", "d", "r"))
    return rows.groupBy("sec").agg(F.count("*").alias("days"), F.round(F.max_by("level", "d"), 4).alias("level"))


# reconciliation against a second series: the same prices, disturbed by rule
PAIRS = """SELECT sec, d, abs(r - o) > greatest(0.001::DOUBLE, 0.011::DOUBLE / prev, 0.011::DOUBLE / (prev + 1)) AS mismatch, abs(o) > 1
  AND abs(r) < 0.2::DOUBLE AS insane, abs(r) > 0.5::DOUBLE AND abs(r - o) > 0.3::DOUBLE AS seam FROM (
  SELECT *, CASE WHEN (sec + dayofyear(d)) % 29 = 0 THEN r + 0.4::DOUBLE WHEN (sec + dayofyear(d)) % 83 = 0
  THEN r + 3 ELSE r END AS o FROM daily WHERE r IS NOT NULL)"""


def _pairs(spark, d):
    k = F.col("sec") + F.dayofyear("d")
    rows = daily(spark, d).filter("r IS NOT NULL").withColumn("o", F.when(k % 29 == 0, F.col("r") + 0.4).when(k % 83 == 0, F.col("r") + 3).otherwise(F.col("r")))
    r, o = F.col("r"), F.col("o")
    seam = predicates.seam(r, o, F.lit(None), jump=0.5, apart=0.3)
    return rows.select("sec", "d", predicates.off_tolerance(r, o, F.col("prev"), F.col("prev") + 1).alias("mismatch"), predicates.other_insane(r, o).alias("insane"), seam.alias("seam"))


@query("""SELECT sec, n, bad, CASE WHEN n > 0 AND bad <= greatest(10::DOUBLE, 0.02::DOUBLE * n)
  THEN ROUND(100 * (1 - mism / n::DOUBLE), 2) END AS pct, first_mismatch FROM (
  SELECT sec, COUNT(CASE WHEN NOT insane THEN 1 END) AS n, COUNT(CASE WHEN insane THEN 1 END) AS bad, COUNT(CASE WHEN NOT insane AND mismatch
  THEN 1 END) AS mism, MIN(CASE WHEN NOT insane AND mismatch THEN d END) AS first_mismatch FROM pairs GROUP BY 1)""", daily=DAILY, pairs=PAIRS)
def recon_score(spark, d):
    return returns.match_score(_pairs(spark, d))


@query("SELECT sec, COUNT(CASE WHEN mismatch THEN 1 END) AS aware, COUNT(CASE WHEN seam THEN 1 END) AS seams, COUNT(CASE WHEN insane THEN 1 END) AS insane FROM pairs GROUP BY 1", daily=DAILY, pairs=PAIRS)
def recon_counterfactuals(spark, d):
    return _pairs(spark, d).groupBy("sec").agg(F.count_if("mismatch").alias("aware"), F.count_if("seam").alias("seams"), F.count_if("insane").alias("insane"))


ADV = """SELECT sec, d, close, CASE WHEN n >= 40 THEN list_sort(v)[n // 2 + 1] END AS adv
  FROM (SELECT sec, d, close, list(close * volume) OVER w AS v, COUNT(*) OVER w AS n FROM bars
  WINDOW w AS (PARTITION BY sec ORDER BY d ROWS 62 PRECEDING))"""
SNAP = """SELECT c.as_of, b.sec, arg_max(b.close, b.d) AS price, max_by(b.adv, b.d) AS adv0, MAX(b.d) AS last_d FROM adv b
  JOIN calendar c ON date_trunc('month', c.as_of) = date_trunc('month', b.d) AND b.d <= c.as_of GROUP BY 1, 2"""
SNAPSHOT = """SELECT s.as_of, s.sec, s.price, a.adv, s.price * x.shares AS mktcap, date_diff('day', s.last_d, s.as_of) AS gap FROM snap s
  JOIN adv a ON a.sec = s.sec AND a.d = s.last_d JOIN securities x ON x.sec = s.sec"""
UNIVERSE = dict(adv=ADV, snap=SNAP, snapshot=SNAPSHOT)
BARS = dict(min_mktcap=3e9, min_adv=3e4, min_price=1200.0, max_gap=12)
ELIGIBLE = "COALESCE(mktcap >= 3e9 AND adv >= 3e4 AND price >= 1200 AND gap <= 12, FALSE)"


@stored("as_of")
def snapshot(spark, d):
    return universe.snapshots(X.bars(spark, d), X.calendar(spark, d), X.securities(spark, d))


@query("SELECT sec, d, ROUND(adv, 4) AS adv FROM adv", adv=ADV)
def adv63_upper_median(spark, d):
    return universe.trailing_adv(X.bars(spark, d)).select("sec", "d", F.round("adv", 4).alias("adv"))


@query(f"SELECT as_of, sec, price, ROUND(mktcap, 2) AS mktcap, gap, {ELIGIBLE} AS in_universe FROM snapshot", **UNIVERSE)
def universe_snapshot(spark, d):
    return snapshot(spark, d).select("as_of", "sec", "price", F.round("mktcap", 2).alias("mktcap"), F.col("gap").cast("long").alias("gap"), universe.eligible(**BARS).alias("in_universe"))


@query("""SELECT COALESCE(CASE WHEN mktcap IS NULL THEN 'mktcap-missing' WHEN adv IS NULL THEN 'adv-warmup' WHEN mktcap < 3e9
  THEN 'cap' WHEN price < 1200 THEN 'price' WHEN adv < 3e4 OR gap > 12
  THEN 'adv/staleness' END, 'member') AS reason, COUNT(*) AS n FROM snapshot GROUP BY 1""", **UNIVERSE)
def exclusion_reasons(spark, d):
    return snapshot(spark, d).groupBy(F.coalesce(universe.exclusion_reason(**BARS), F.lit("member")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"SELECT as_of, sec, ntile(3) OVER (PARTITION BY as_of ORDER BY mktcap, sec) AS size_bucket FROM snapshot WHERE {ELIGIBLE}", **UNIVERSE)
def size_terciles(spark, d):
    return universe.size_buckets(snapshot(spark, d).filter(universe.eligible(**BARS))).select("as_of", "sec", F.col("size_bucket").cast("long").alias("size_bucket"))


@query(f"SELECT as_of, n, jump FROM (SELECT as_of, n, n - lag(n) OVER (ORDER BY as_of) AS jump FROM (SELECT as_of, COUNT(*) AS n FROM snapshot WHERE {ELIGIBLE} GROUP BY 1)) ORDER BY abs(jump) DESC NULLS LAST, as_of LIMIT 5", **UNIVERSE)
def universe_mom_jumps(spark, d):
    n = snapshot(spark, d).filter(universe.eligible(**BARS)).groupBy("as_of").agg(F.count("*").alias("n"))
    rows = n.withColumn("jump", F.col("n") - F.lag("n").over(Window.orderBy("as_of")))
    return rows.orderBy(F.abs("jump").desc_nulls_last(), "as_of").limit(5)  # a top-k report


@query(f"SELECT as_of, COUNT(*) AS n, MIN(size_bucket) AS lo, MAX(size_bucket) AS hi, ROUND(avg(mktcap), 2) AS mean_cap FROM (SELECT as_of, mktcap, ntile(3) OVER (PARTITION BY as_of ORDER BY mktcap, sec) AS size_bucket FROM snapshot WHERE {ELIGIBLE}) WHERE month(as_of) = 6 GROUP BY 1", **UNIVERSE)
def june_report(spark, d):
    rows = universe.size_buckets(snapshot(spark, d).filter(universe.eligible(**BARS))).filter("month(as_of) = 6")
    return rows.groupBy("as_of").agg(F.count("*").alias("n"), F.min("size_bucket").cast("long").alias("lo"), F.max("size_bucket").cast("long").alias("hi"), F.round(F.avg("mktcap"), 2).alias("mean_cap"))


# month grid: every security by every month, so that lags count months
GRID = """SELECT s.sec, c.as_of, c.ai, NULLIF(m.tr, 0) AS tr FROM (SELECT DISTINCT sec FROM month_end) s CROSS JOIN calendar c LEFT
  JOIN month_end m ON m.sec = s.sec AND m.as_of = c.as_of"""
LAGS = """SELECT sec, as_of, ai, tr, lag(tr, 1) OVER w AS tr1, lag(tr, 12) OVER w AS tr12, lead(tr) OVER w AS nxt,
  lead(as_of) OVER w AS nxt_asof FROM grid WINDOW w AS (PARTITION BY sec ORDER BY ai)"""
MONTHLY = dict(grid=GRID, lags=LAGS)


@query("SELECT sec, as_of, ROUND(tr1 / tr12 - 1, 8) AS value FROM lags WHERE tr1 / tr12 IS NOT NULL", **MONTHLY)
def momentum_12_1(spark, d):
    return returns.momentum(X.month_end(spark, d), X.calendar(spark, d)).filter("value IS NOT NULL").select("sec", "as_of", F.round("value", 8).alias("value"))


@query("SELECT sec, as_of, ROUND(tr / tr1 - 1, 8) AS value FROM lags WHERE tr / tr1 IS NOT NULL", **MONTHLY)
def month_return(spark, d):
    return factors.monthly_return(X.month_end(spark, d), X.calendar(spark, d)).filter("value IS NOT NULL").select("sec", "as_of", F.round("value", 8).alias("value"))


VOLS = """SELECT sec, as_of, CASE WHEN COUNT(r) OVER w = 12 THEN stddev_samp(r) OVER w * sqrt(12) END AS value
  FROM (SELECT *, tr / tr1 - 1 AS r FROM lags) WINDOW w AS (PARTITION BY sec ORDER BY ai ROWS 11 PRECEDING)"""


@query("SELECT sec, as_of, ROUND(value, 6) AS value FROM vols WHERE value IS NOT NULL", **MONTHLY, vols=VOLS)
def vol_12m(spark, d):
    return factors.volatility(X.month_end(spark, d), X.calendar(spark, d)).filter("value IS NOT NULL").select("sec", "as_of", F.round("value", 6).alias("value"))


BENCH = "SELECT as_of, v / lag(v) OVER (ORDER BY ai) - 1 AS bench FROM (SELECT as_of, ai, avg(tr) AS v FROM month_end GROUP BY 1, 2)"


def benchmark(spark, d):
    b = X.month_end(spark, d).groupBy("as_of", "ai").agg(F.avg("tr").alias("v"))
    return b.select("as_of", (F.col("v") / F.lag("v").over(Window.orderBy("ai")) - 1).alias("bench"))  # a row a month


BETAS = """SELECT sec, as_of, b AS value FROM (
    SELECT sec, as_of, CASE WHEN COUNT(y) OVER w >= 24 AND var_pop(y) OVER w > 1e-10::DOUBLE
    THEN covar_samp(x, y) OVER w / var_pop(y) OVER w END AS b FROM (
      SELECT sec, l.as_of, ai, CASE WHEN bench IS NOT NULL THEN tr / tr1 - 1 END AS x, CASE WHEN tr / tr1 IS NOT NULL THEN bench END AS y
      FROM lags l LEFT JOIN bench b ON b.as_of = l.as_of) WINDOW w AS (PARTITION BY sec ORDER BY ai ROWS 35 PRECEDING)) o
  WHERE as_of <= (SELECT MAX(c.as_of) FROM calendar c WHERE c.ai <= (SELECT MAX(m.ai) FROM month_end m WHERE m.sec = o.sec) + 12)"""


@query("SELECT sec, as_of, ROUND(value, 6) AS value FROM betas WHERE value IS NOT NULL", **MONTHLY, bench=BENCH, betas=BETAS)
def beta_36m(spark, d):
    return factors.market_beta(X.month_end(spark, d), X.calendar(spark, d), benchmark(spark, d)).filter("value IS NOT NULL").select("sec", "as_of", F.round("value", 6).alias("value"))


# forward returns of securities that stop trading at their delisting
ALIVE = "SELECT b.sec, b.d, b.close FROM bars b LEFT JOIN delistings x ON x.sec = b.sec WHERE x.sec IS NULL OR b.d <= x.delist_date"
ALIVE_END = "SELECT l.sec, c.as_of, c.ai, l.tr FROM (SELECT sec, date_trunc('month', d) AS m, max_by(close, d) AS tr, MAX(d) AS last_in FROM alive GROUP BY 1, 2) l JOIN calendar c ON date_trunc('month', c.as_of) = l.m WHERE date_diff('day', last_in, c.as_of) <= 20"
ALIVE_GRID = "SELECT s.sec, c.as_of, c.ai, NULLIF(m.tr, 0) AS tr FROM (SELECT DISTINCT sec FROM alive_end) s CROSS JOIN calendar c LEFT JOIN alive_end m ON m.sec = s.sec AND m.as_of = c.as_of"
ALIVE_LAGS = "SELECT sec, as_of, ai, tr, lead(tr) OVER w AS nxt, lead(as_of) OVER w AS nxt_asof FROM alive_grid WINDOW w AS (PARTITION BY sec ORDER BY ai)"


@query("""SELECT l.sec, l.as_of, ROUND(COALESCE(nxt / tr - 1, CASE WHEN e.last_d > l.as_of AND e.last_d <= nxt_asof
  THEN CASE WHEN x.delist_date > l.as_of AND x.delist_date <= nxt_asof AND x.method = 'deal'
  THEN (e.last_tr / tr) * (1 + x.terminal_return) - 1 ELSE e.last_tr / tr - 1 END END), 8) AS fwd
  FROM alive_lags l JOIN (SELECT sec, MAX(d) AS last_d, max_by(close, d) AS last_tr FROM alive GROUP BY 1) e ON e.sec = l.sec LEFT
  JOIN delistings x ON x.sec = l.sec
  WHERE COALESCE(nxt / tr - 1, CASE WHEN e.last_d > l.as_of AND e.last_d <= nxt_asof THEN e.last_tr / tr END) IS NOT NULL""", alive=ALIVE, alive_end=ALIVE_END, alive_grid=ALIVE_GRID, alive_lags=ALIVE_LAGS)
def forward_returns_delisted(spark, d):
    ends, grid = X.delistings(spark, d), X.calendar(spark, d)
    alive = X.bars(spark, d).join(ends.select("sec", "delist_date"), "sec", "left").filter("delist_date IS NULL OR d <= delist_date")
    m = alive.groupBy("sec", F.trunc("d", "MM").alias("m")).agg(F.max_by("close", "d").alias("tr"), F.max("d").alias("last_in"))
    cells = m.join(F.broadcast(grid.withColumn("m", F.trunc("as_of", "MM"))), "m").filter("datediff(as_of, last_in) <= 20").select("sec", "as_of", "ai", "tr")
    last = alive.groupBy("sec").agg(F.max(F.struct("d", "close")).alias("x")).select("sec", F.col("x.d").alias("last_d"), F.col("x.close").alias("last_tr"))
    return returns.forward_returns(cells, grid, ends, last).filter("fwd IS NOT NULL").select("sec", "as_of", F.round("fwd", 8).alias("fwd"))


@query("""SELECT as_of, n, ROUND(avg(CASE WHEN r > n - k THEN fwd END), 8) AS top, ROUND(avg(CASE WHEN r <= k
  THEN fwd END), 8) AS bottom, ROUND(avg(CASE WHEN r > n - k THEN fwd END) - avg(CASE WHEN r <= k THEN fwd END), 8) AS ls FROM (
  SELECT as_of, fwd, ROW_NUMBER() OVER (PARTITION BY as_of
  ORDER BY mom, sec) AS r, COUNT(*) OVER (PARTITION BY as_of) AS n, greatest(COUNT(*) OVER (PARTITION BY as_of) // 10, 1) AS k FROM (
    SELECT sec, as_of, tr1 / tr12 - 1 AS mom, nxt / tr - 1 AS fwd FROM lags) WHERE mom IS NOT NULL AND fwd IS NOT NULL) GROUP BY as_of, n, k
    HAVING n >= 5""", **MONTHLY)
def mom_decile_ls(spark, d):
    cells, grid = X.month_end(spark, d), X.calendar(spark, d)
    pairs = returns.momentum(cells, grid).withColumnRenamed("value", "mom").join(returns.forward_returns(cells, grid).drop("ai"), ["sec", "as_of"])
    g = counted_spread(pairs, ["as_of"], "mom", "fwd", minimum=5)
    return g.select("as_of", "n", *[F.round(c, 8).alias(c) for c in ("top", "bottom", "ls")])


SUE = """SELECT sec, report_date, CASE WHEN n >= 4 AND sd > 1e-9::DOUBLE THEN ROUND(diff / sd, 4) END AS sue FROM (
  SELECT sec, report_date, diff, COUNT(diff) OVER w AS n, stddev_pop(diff) OVER w AS sd
  FROM (SELECT sec, report_date, actual - estimate AS diff FROM surprises WHERE estimate IS NOT NULL)
  WINDOW w AS (PARTITION BY sec ORDER BY report_date ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING))"""


@query("SELECT sec, report_date, sue FROM sue", sue=SUE)
def sue(spark, d):
    return factors.standardised_surprise(X.surprises(spark, d)).select("sec", "report_date", "sue")
