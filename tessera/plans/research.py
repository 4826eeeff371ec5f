"""Queries of research practice beyond the board's evaluation: several tests at
once, a risk model, trading cost, and how long a signal's content lasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import stats
from tessera.operators import crosssection as C
from tessera.operators import returns, risk
from tessera.plans import panel
from tessera.plans.registry import query
from tessera.sources import fixtures as X
from tessera.sources.stored import stored

ALPHA = 0.1
_T_STATS = f"""SELECT 'slope' AS family, factor AS term, ROUND(t, 5) AS t FROM ({panel._newey_west_sql(3, "SELECT term AS factor, as_of, beta AS v FROM fm WHERE term <> 'intercept'")})
  UNION ALL SELECT 'ic', factor, ROUND(t, 5) FROM ({panel._newey_west_sql(0, "SELECT factor, as_of, ic AS v FROM ics")})
  UNION ALL SELECT 'spread', factor, ROUND(t, 5) FROM ({panel._newey_west_sql(0, "SELECT factor, as_of, top - bottom AS v FROM lsq")})"""


@query(f"""SELECT family, term, t, ROUND(p, 9) AS p, ROUND(q, 9) AS q, q <= {ALPHA}::DOUBLE AS kept FROM (
  SELECT *, least(1, MIN(p * m / r) OVER (PARTITION BY family ORDER BY r DESC ROWS UNBOUNDED PRECEDING)) AS q FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY family ORDER BY p, term) AS r, COUNT(*) OVER (PARTITION BY family) AS m FROM (
      SELECT *, {stats.two_sided_p_sql('t')} AS p FROM tests WHERE t IS NOT NULL)))""", **panel.REGRESSION, tests=_T_STATS)
def multiple_testing(spark, d):
    """Which factors hold at a false discovery rate of a tenth, by each of three statistics."""
    slopes = stats.newey_west(panel.fm_betas(spark, d).filter("term <> 'intercept'"), "beta", "as_of", ["term"], 3).select(F.lit("slope").alias("family"), "term", "t")
    of = lambda rows, v, name: stats.newey_west(rows, v, "as_of", ["factor"], 0).select(F.lit(name).alias("family"), F.col("factor").alias("term"), "t")
    rows = slopes.unionByName(of(panel.ics(spark, d), "ic", "ic")).unionByName(of(panel.spreads(spark, d), "ls", "spread"))
    rows = rows.filter("t IS NOT NULL").withColumn("t", F.round("t", 5)).withColumn("p", stats.two_sided_p(F.col("t")))
    out = stats.benjamini_hochberg(rows, "family", "p", "term")
    return out.select("family", "term", "t", F.round("p", 9).alias("p"), F.round("q", 9).alias("q"), (F.col("q") <= ALPHA).alias("kept"))


# slopes in hundredths of a per cent, so that squares keep their digits
_PAIRS = """SELECT x.as_of, x.term AS a, y.term AS b, x.beta * 10000 AS u, y.beta * 10000 AS v FROM fm x JOIN fm y ON y.as_of = x.as_of AND x.term <= y.term"""
_WINDOWS = """SELECT p.as_of, p.a, p.b, COUNT(*) AS n, covar_pop(q.u, q.v) AS cov, avg(q.u) AS mu, avg(q.v) AS mv FROM pairs p
  JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY a, b ORDER BY as_of) AS k FROM pairs) me ON me.as_of = p.as_of AND me.a = p.a AND me.b = p.b
  JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY a, b ORDER BY as_of) AS k FROM pairs) q ON q.a = p.a AND q.b = p.b AND q.k BETWEEN me.k - 35 AND me.k GROUP BY 1, 2, 3 HAVING COUNT(*) >= 12"""
_NOISE = """SELECT w.as_of, w.a, w.b, ANY_VALUE(w.n) AS n, ANY_VALUE(w.cov) AS cov, avg(((q.u - w.mu) * (q.v - w.mv) - w.cov) * ((q.u - w.mu) * (q.v - w.mv) - w.cov)) / ANY_VALUE(w.n) AS noise FROM windows w
  JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY a, b ORDER BY as_of) AS k FROM pairs) me ON me.as_of = w.as_of AND me.a = w.a AND me.b = w.b
  JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY a, b ORDER BY as_of) AS k FROM pairs) q ON q.a = w.a AND q.b = w.b AND q.k BETWEEN me.k - 35 AND me.k GROUP BY 1, 2, 3"""


@query("""SELECT as_of, a, b, n, ROUND(cov, 4) AS cov, ROUND(intensity, 6) AS intensity, ROUND(CASE WHEN a < b THEN cov * (1 - intensity) ELSE cov END, 4) AS shrunk FROM (
  SELECT *, least(1, COALESCE(SUM(CASE WHEN a < b THEN noise END) OVER m / SUM(CASE WHEN a < b THEN cov * cov END) OVER m, 1)) AS intensity FROM noise
  WINDOW m AS (PARTITION BY as_of))""", **panel.REGRESSION, pairs=_PAIRS, windows=_WINDOWS, noise=_NOISE)
def shrunk_covariance(spark, d):
    """The factors' covariance at each month, drawn towards a diagonal."""
    series = panel.fm_betas(spark, d).select("as_of", "term", (F.col("beta") * 10000).alias("value"))
    rows = risk.shrunk_covariance(series)
    return rows.select("as_of", "a", "b", "n", F.round("cov", 4).alias("cov"), F.round("intensity", 6).alias("intensity"), F.round("shrunk", 4).alias("shrunk"))


_RESIDUALS = f"""SELECT z.sec, z.as_of, c.ai, MAX(z.fwd) - MAX(i.beta) - SUM(b.beta * z.u) AS residual FROM (
    SELECT *, CASE WHEN stddev_pop(z) OVER g > 1e-9::DOUBLE THEN (z - avg(z) OVER g) / stddev_pop(z) OVER g ELSE z - avg(z) OVER g END AS u
    FROM full_ WINDOW g AS (PARTITION BY as_of, factor)) z
  JOIN fm b ON b.as_of = z.as_of AND b.term = z.factor JOIN fm i ON i.as_of = z.as_of AND i.term = 'intercept' JOIN calendar c ON c.as_of = z.as_of GROUP BY 1, 2, 3"""


@query("""SELECT sec, as_of, n, ROUND(v, 6) AS variance FROM (
  SELECT a.sec, a.as_of, COUNT(*) AS n, SUM(power(2::DOUBLE, (b.ai - a.ai) / 12::DOUBLE) * b.residual * b.residual) / SUM(power(2::DOUBLE, (b.ai - a.ai) / 12::DOUBLE)) AS v
  FROM residuals a JOIN residuals b ON b.sec = a.sec AND b.ai BETWEEN a.ai - 35 AND a.ai GROUP BY 1, 2) WHERE n >= 6""", **panel.REGRESSION, full_=panel.FULL, residuals=_RESIDUALS)
def specific_risk(spark, d):
    """What the factors leave of each name's returns, the latest the heaviest."""
    by = ["as_of", "factor"]
    z = panel.full(spark, d).withColumn("u", stats.standardised(F.col("z"), by))
    betas = panel.fm_betas(spark, d).select("as_of", "term", "beta")
    # a row a month and factor of the registry is broadcast, as is one a month
    own = z.join(F.broadcast(betas), (z["as_of"] == betas["as_of"]) & (z["factor"] == betas["term"])).select(z["as_of"], "sec", "fwd", (F.col("beta") * F.col("u")).alias("part"))
    g = own.groupBy("sec", "as_of").agg(F.max("fwd").alias("fwd"), F.sum("part").alias("explained"))
    level = betas.filter("term = 'intercept'").select("as_of", F.col("beta").alias("level"))
    rows = g.join(F.broadcast(level), "as_of").join(F.broadcast(X.calendar(spark, d)), "as_of")
    rows = rows.select("sec", "as_of", F.col("ai").cast("long").alias("ai"), (F.col("fwd") - F.col("level") - F.col("explained")).alias("residual"))
    return risk.specific_variance(rows).withColumn("variance", F.round("variance", 6))


@stored("sec")
def ranges(spark, d):
    """(sec, d, high, low, close): trades reduced to days."""
    li = X.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("sec"), F.col("l_shipdate").cast("date").alias("d"), (X.cents("l_extendedprice").cast("double") / F.col("l_quantity").cast("double") / 100).alias("p"))
    return li.groupBy("sec", "d").agg(F.max("p").alias("high"), F.min("p").alias("low")).join(X.bars(spark, d).select("sec", "d", "close"), ["sec", "d"])


_RANGES = """SELECT l_suppkey AS sec, CAST(l_shipdate AS DATE) AS d, MAX(p) AS high, MIN(p) AS low FROM (
  SELECT *, CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS DOUBLE) / CAST(l_quantity AS DOUBLE) / 100 AS p FROM lineitem) GROUP BY 1, 2"""
_MOVED = """SELECT sec, d, close, ph, pl, pc, high - gap AS hi, low - gap AS lo FROM (
  SELECT *, CASE WHEN low > pc THEN low - pc WHEN high < pc THEN high - pc ELSE 0 END AS gap FROM (
    SELECT r.*, b.close, lag(r.high) OVER w AS ph, lag(r.low) OVER w AS pl, lag(b.close) OVER w AS pc FROM ranges r JOIN bars b ON b.sec = r.sec AND b.d = r.d
    WINDOW w AS (PARTITION BY r.sec ORDER BY r.d)))"""
_ALPHA = f"""SELECT sec, d, ln(close / pc) AS r, ph, lo, (sqrt(2 * beta) - sqrt(beta)) / {risk.ROOT!r}::DOUBLE - sqrt(gamma / {risk.ROOT!r}::DOUBLE) AS alpha FROM (
  SELECT *, CASE WHEN lo > 0 THEN power(ln(hi / lo), 2) + power(ln(ph / pl), 2) END AS beta, CASE WHEN lo > 0 THEN power(ln(greatest(hi, ph) / least(lo, pl)), 2) END AS gamma FROM moved)"""


@query("""SELECT sec, m, days, ROUND(spread, 8) AS spread, ROUND(vol, 8) AS volatility, ROUND(spread / 2 + vol * 0.1::DOUBLE, 8) AS cost FROM (
  SELECT sec, date_trunc('month', d)::DATE AS m, COUNT(s) AS days, avg(s) AS spread, stddev_pop(r) AS vol FROM (
    SELECT *, CASE WHEN ph IS NOT NULL AND lo > 0 THEN greatest(2 * (exp(alpha) - 1) / (1 + exp(alpha)), 0) END AS s FROM alphas) GROUP BY 1, 2) WHERE days > 0""", ranges=_RANGES, moved=_MOVED, alphas=_ALPHA)
def trading_cost(spark, d):
    """Spread by highs and lows and the square root law, a security and month."""
    rows = risk.trading_cost(ranges(spark, d))
    return rows.select("sec", "m", "days", *[F.round(c, 8).alias(c) for c in ("spread", "volatility", "cost")])


HORIZONS = [21, 63, 126, 252]
_POSITIONS = f"""SELECT l.sec, l.d, {", ".join(f"CASE WHEN pos + {h} <= days THEN last_value(level) OVER (PARTITION BY sec ORDER BY pos RANGE BETWEEN 1 FOLLOWING AND {h} FOLLOWING) / NULLIF(level, 0) - 1 END AS r_{h}" for h in HORIZONS)}
  FROM levels l JOIN (SELECT d, ROW_NUMBER() OVER (ORDER BY d) AS pos, COUNT(*) OVER () AS days FROM (SELECT DISTINCT d FROM levels)) t ON t.d = l.d"""
_AHEAD = f"""SELECT m.sec, m.as_of, h.horizon, CASE h.horizon {" ".join(f"WHEN {h} THEN ROUND(p.r_{h}, 9)" for h in HORIZONS)} END AS fwd FROM (
    SELECT l.sec, c.as_of, MAX(l.d) AS d FROM levels l JOIN calendar c ON date_trunc('month', c.as_of) = date_trunc('month', l.d) GROUP BY 1, 2) m
  JOIN positions p ON p.sec = m.sec AND p.d = m.d CROSS JOIN (SELECT unnest({HORIZONS}) AS horizon) h"""
_DECAY = f"""SELECT factor, horizon, as_of, corr(ra, rb) AS ic FROM (
  SELECT c.factor, a.horizon, c.as_of, CAST(ROW_NUMBER() OVER (PARTITION BY c.factor, a.horizon, c.as_of ORDER BY ROUND(c.z, 9), c.sec) AS DOUBLE) AS ra,
    CAST(ROW_NUMBER() OVER (PARTITION BY c.factor, a.horizon, c.as_of ORDER BY a.fwd, c.sec) AS DOUBLE) AS rb
  FROM cells c JOIN ahead a ON a.sec = c.sec AND a.as_of = c.as_of WHERE a.fwd IS NOT NULL AND c.z IS NOT NULL) GROUP BY 1, 2, 3 HAVING COUNT(*) >= {panel.NAMES}"""


@query(f"""SELECT factor, horizon, months, ROUND(mean_ic, 6) AS mean_ic, ROUND(CASE WHEN abs(first_ic) > 1e-9::DOUBLE THEN mean_ic / first_ic END, 4) AS kept FROM (
  SELECT *, MAX(CASE WHEN horizon = {HORIZONS[0]} THEN mean_ic END) OVER (PARTITION BY factor) AS first_ic FROM (
    SELECT factor, horizon, COUNT(ic) AS months, ROUND(avg(ic), 9) AS mean_ic FROM decay GROUP BY 1, 2))""", **panel.BOARD, positions=_POSITIONS, ahead=_AHEAD, decay=_DECAY)
def ic_decay(spark, d):
    """The mean rank correlation of each factor with the return over 21 to 252
    trading days, and what of the first horizon's is left."""
    rows = returns.horizon_returns(X.levels(spark, d).select("sec", "d", "level"), HORIZONS)
    last = rows.groupBy("sec", F.trunc("d", "MM").alias("m")).agg(F.max(F.struct("d", *[f"r_{h}" for h in HORIZONS])).alias("x"))
    grid = X.calendar(spark, d).withColumn("m", F.trunc("as_of", "MM"))
    each = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.round(F.col(f"x.r_{h}"), 9).alias("fwd")) for h in HORIZONS]))
    ahead = last.join(F.broadcast(grid), "m").select("sec", "as_of", each.alias("y")).select("sec", "as_of", "y.*").filter("fwd IS NOT NULL")  # a grid row a month
    pairs = panel.board(spark, d).select("sec", "as_of", "factor", F.round("z", 9).alias("z")).join(ahead, ["sec", "as_of"])
    ic = C.rank_ic(pairs, ["factor", "horizon", "as_of"], "z", "fwd", panel.NAMES)
    return C.decay(ic, HORIZONS[0]).select("factor", "horizon", "months", F.round("mean_ic", 6).alias("mean_ic"), F.round("kept", 4).alias("kept"))
