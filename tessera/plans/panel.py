"""Queries over the factor board: signals, standardising, evaluation, composites.

The board is stored, as are the cells paired with the return that follows and
the monthly statistics: a query reads what it evaluates and derives no more.
"""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import stats
from tessera.operators import crosssection as C
from tessera.operators import factors, returns, temporal, universe
from tessera.plans import history as H
from tessera.plans import temporal as T
from tessera.plans.registry import query
from tessera.sources import fixtures as X
from tessera.sources.stored import stored

#: Members with looser bars than the universe report, so that small tables have cross-sections.
LOOSE = dict(min_mktcap=1e8, min_adv=1e3, min_price=1000.0, max_gap=40)
#: Fewest names of a cross-section, names of a regression, months of a summary and of a track record, at the tables' scale.
NAMES, REGRESSED, MONTHS, BURN_IN = 10, 30, 12, 12
FACTORS = sorted(factors.REGISTRY)
WITHOUT_FINANCIALS = [f for f in FACTORS if factors.REGISTRY[f][2]]
MAX_AGE = 140  # days that a surprise counts


def _in(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


MEMBERS = """SELECT s.as_of, s.sec, s.mktcap, x.sector, x.is_fin FROM snapshot s JOIN securities x ON x.sec = s.sec
  WHERE COALESCE(s.mktcap >= 1e8 AND s.adv >= 1e3 AND s.price >= 1000 AND s.gap <= 40, FALSE)"""
TTM = """SELECT * FROM (
  SELECT *, COUNT(*) OVER w AS q, date_diff('day', MIN(period_end) OVER w, period_end) AS days,
    CASE WHEN COUNT(ebit) OVER w = 4 THEN SUM(ebit) OVER w END AS t_ebit, CASE WHEN COUNT(gp) OVER w = 4 THEN SUM(gp) OVER w END AS t_gp,
    CASE WHEN COUNT(ni) OVER w = 4 THEN SUM(ni) OVER w END AS t_ni, CASE WHEN COUNT(cfo) OVER w = 4 THEN SUM(cfo) OVER w END AS t_cfo
  FROM (SELECT * FROM visible_ WHERE nth <= 6) WINDOW w AS (PARTITION BY sec, as_of ORDER BY period_end ROWS 3 PRECEDING)) WHERE nth = 1"""
AGO = """SELECT v.sec, v.as_of, max_by(v.period_end, v.period_end) AS ago_end, max_by(COALESCE(v.assets, -1), v.period_end) AS ago_assets0,
    max_by(v.shares, v.period_end) AS ago_shares
  FROM visible_ v JOIN (SELECT sec, as_of, period_end FROM visible_ WHERE nth = 1) l ON l.sec = v.sec AND l.as_of = v.as_of
  WHERE v.nth <= 6 AND date_diff('day', v.period_end, l.period_end) BETWEEN 300 AND 430 GROUP BY 1, 2"""
STATEMENT_VALUES = """SELECT sec, as_of, f.factor, CASE f.factor
    WHEN 'ebit_ev' THEN CASE WHEN ev > greatest(1e8, 0.05::DOUBLE * mktcap) AND whole AND ta IS NOT NULL THEN t_ebit / ev END
    WHEN 'gp_a' THEN CASE WHEN whole THEN t_gp / ta END
    WHEN 'accruals' THEN CASE WHEN whole THEN (t_ni - t_cfo) / CASE WHEN ago_ta IS NOT NULL THEN (ta + ago_ta) / 2 ELSE ta END END
    WHEN 'asset_growth' THEN CASE WHEN whole THEN ta / ago_ta - 1 END
    WHEN 'bp' THEN CASE WHEN equity > 0 THEN equity / mktcap END
    WHEN 'net_issuance' THEN shares_ / CASE WHEN ago_shares > 0 THEN ago_shares END - 1 END AS value
  FROM (SELECT m.sec, m.as_of, m.mktcap, m.mktcap + t.debt - t.cash AS ev, NULLIF(t.assets, 0) AS ta,
      NULLIF(NULLIF(a.ago_assets0, -1), 0) AS ago_ta, NULLIF(t.shares, 0) AS shares_, a.ago_shares, t.equity, t_ebit, t_gp, t_ni, t_cfo,
      q = 4 AND days BETWEEN 240 AND 390 AND NOT m.is_fin AS whole
    FROM members m JOIN ttm t ON t.sec = m.sec AND t.as_of = m.as_of LEFT JOIN ago a ON a.sec = m.sec AND a.as_of = m.as_of)
  CROSS JOIN (VALUES ('ebit_ev'), ('gp_a'), ('accruals'), ('asset_growth'), ('bp'), ('net_issuance')) f(factor)"""
#: Of each member the last surprise that has a score, unless it is older than MAX_AGE days.
SUE_VALUES = f"""SELECT m.sec, m.as_of, CASE WHEN date_diff('day', r.report_date, m.as_of) <= {MAX_AGE} THEN r.sue END AS value
  FROM members m ASOF JOIN (SELECT * FROM sue WHERE sue IS NOT NULL) r ON r.sec = m.sec AND m.as_of >= r.report_date"""
VALS = """SELECT v.as_of, v.sec, v.factor, v.value, m.sector, m.mktcap, m.is_fin FROM (
    SELECT sec, as_of, factor, value FROM svals
    UNION ALL SELECT sec, as_of, 'mom_12_1', tr1 / tr12 - 1 FROM lags UNION ALL SELECT sec, as_of, 'trk_core_1m', tr / tr1 - 1 FROM lags
    UNION ALL SELECT sec, as_of, 'sue', value FROM sue_values UNION ALL SELECT sec, as_of, 'vol_12m', value FROM vols
    UNION ALL SELECT sec, as_of, 'beta_36m', value FROM betas) v
  JOIN members m ON m.sec = v.sec AND m.as_of = v.as_of WHERE v.value IS NOT NULL"""
COVERED = f"""SELECT v.* FROM (SELECT *, COUNT(*) OVER (PARTITION BY as_of, factor) AS n FROM vals) v
  JOIN (SELECT as_of, COUNT(*) AS n_all, COUNT(CASE WHEN NOT is_fin THEN 1 END) AS n_non FROM members GROUP BY 1) s ON s.as_of = v.as_of
  WHERE n >= 0.6::DOUBLE * CASE WHEN factor IN ({_in(WITHOUT_FINANCIALS)}) THEN n_non ELSE n_all END"""
RANKED = f"""SELECT *, {stats.probit_sql('(rk / (n + 1))')} AS rank_norm FROM (
  SELECT *, rank() OVER (PARTITION BY as_of, factor ORDER BY w) + (COUNT(*) OVER (PARTITION BY as_of, factor, w) - 1) / 2::DOUBLE AS rk FROM (
    SELECT as_of, sec, factor, sector, mktcap, n, value, greatest(quantile_cont(value, 0.01) OVER g, least(quantile_cont(value, 0.99) OVER g,
    value)) AS w
    FROM covered WINDOW g AS (PARTITION BY as_of, factor)))"""
SECTORED = """SELECT *, CASE WHEN stddev_pop(dz) OVER g > 1e-9::DOUBLE THEN dz / stddev_pop(dz) OVER g ELSE dz END AS z_sector FROM (
  SELECT *, rank_norm - avg(rank_norm) OVER s AS dz, ln(mktcap) - avg(ln(mktcap)) OVER s AS x FROM ranked
  WINDOW s AS (PARTITION BY as_of, factor, sector))
  WINDOW g AS (PARTITION BY as_of, factor)"""
CELLS = """SELECT as_of, sec, factor, sector, mktcap, rank_norm, z_sector,
    CASE WHEN stddev_pop(rz) OVER g > 1e-9::DOUBLE THEN (rz - avg(rz) OVER g) / stddev_pop(rz) OVER g ELSE rz - avg(rz) OVER g END AS z
  FROM (SELECT *, z_sector - SUM(z_sector * x) OVER g / greatest(SUM(x * x) OVER g, 1e-12::DOUBLE) * x AS rz FROM sectored
  WINDOW g AS (PARTITION BY as_of, factor))
  WINDOW g AS (PARTITION BY as_of, factor)"""
BASE = dict(**H.UNIVERSE, visible_=T.VISIBLE, members=MEMBERS, ttm=TTM, ago=AGO)
SIGNALS = dict(svals=STATEMENT_VALUES, bench=H.BENCH, vols=H.VOLS, betas=H.BETAS, sue=H.SUE, sue_values=SUE_VALUES, vals=VALS)
BOARD = dict(**BASE, **H.MONTHLY, **SIGNALS, covered=COVERED, ranked=RANKED, sectored=SECTORED, cells=CELLS)
#: The return that follows: to the next month, or of a name that stops trading in between to its last trade, with a deal's terminal return; plain: only the former.
FORWARD = """SELECT l.sec, l.as_of, l.nxt / l.tr - 1 AS plain, COALESCE(l.nxt / l.tr - 1, CASE WHEN e.last_d > l.as_of AND e.last_d <= l.nxt_asof
    THEN CASE WHEN x.delist_date > l.as_of AND x.delist_date <= l.nxt_asof AND x.method = 'deal' THEN e.last_tr / l.tr * (1 + x.terminal_return) - 1 ELSE e.last_tr / l.tr - 1 END END) AS fwd
  FROM lags l JOIN (SELECT sec, MAX(d) AS last_d, max_by(level, d) AS last_tr FROM levels GROUP BY 1) e ON e.sec = l.sec LEFT JOIN delistings x ON x.sec = l.sec"""
#: Evaluated on what no rounding can reorder: signals as ranks are rounded first.
PAIRED = """SELECT c.as_of, c.sec, c.factor, ROUND(c.z, 9) AS z, f.fwd, f.plain
  FROM cells c JOIN forward f ON f.sec = c.sec AND f.as_of = c.as_of WHERE f.fwd IS NOT NULL"""
ICS = f"""SELECT factor, as_of, corr(ra, rb) AS ic, COUNT(*) AS n FROM (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY factor, as_of ORDER BY z, sec) AS DOUBLE) AS ra,
    CAST(ROW_NUMBER() OVER (PARTITION BY factor, as_of ORDER BY fwd, sec) AS DOUBLE) AS rb FROM paired) GROUP BY 1, 2 HAVING COUNT(*) >= {NAMES}"""
LS = f"""SELECT factor, as_of, COUNT(*) AS n, avg(CASE WHEN z >= hi THEN fwd END) AS top, avg(CASE WHEN z <= lo THEN fwd END) AS bottom FROM (
  SELECT *, quantile_cont(z, 0.9) OVER g AS hi, quantile_cont(z, 0.1) OVER g AS lo FROM paired WINDOW g AS (PARTITION BY factor, as_of))
  GROUP BY 1, 2 HAVING COUNT(*) >= {NAMES}"""
EVAL = dict(**BOARD, forward=FORWARD, paired=PAIRED, ics=ICS, lsq=LS)


@stored("as_of")
def members(spark, d):
    x = X.securities(spark, d).select("sec", "sector", "is_fin")
    return H.snapshot(spark, d).filter(universe.eligible(**LOOSE)).join(x, "sec").select("as_of", "sec", "mktcap", "sector", "is_fin")


def sue_values(spark, d):
    """Of each member the last surprise with a score by then, if recent enough."""
    reports = factors.standardised_surprise(X.surprises(spark, d)).filter("sue IS NOT NULL").select("sec", "report_date", "sue")
    rows = temporal.asof_backward(members(spark, d).select("sec", "as_of"), reports, "sec", "as_of", "report_date", ["sue"], MAX_AGE)
    return rows.select("sec", "as_of", F.lit("sue").alias("factor"), F.col("sue").alias("value"))


@stored("as_of", "factor")
def board_values(spark, d):
    """Every signal of the registry, as far as members have it."""
    m, cells, grid = members(spark, d), X.month_end(spark, d), X.calendar(spark, d)
    values = factors.statement_factors(T.visible(spark, d), m.select("sec", "as_of", "mktcap", "is_fin")).unionByName(sue_values(spark, d))
    for name, rows in (
        ("mom_12_1", returns.momentum(cells, grid)), ("trk_core_1m", factors.monthly_return(cells, grid)),
        ("vol_12m", factors.volatility(cells, grid)), ("beta_36m", factors.market_beta(cells, grid, H.benchmark(spark, d))),
    ):
        values = values.unionByName(rows.select("sec", "as_of", F.lit(name).alias("factor"), "value"))
    return values.filter("value IS NOT NULL").join(m, ["sec", "as_of"])


def covered(spark, d):
    return C.covered(board_values(spark, d), members(spark, d), 0.6, WITHOUT_FINANCIALS)


@stored("as_of", "factor")
def board(spark, d):
    return C.standardise(covered(spark, d)).withColumnRenamed("z_sector_size", "z")


def forward(spark, d):
    """(sec, as_of, fwd, plain): the return that follows, with the fallback of a
    name that stops trading in between and without."""
    cells, grid = X.month_end(spark, d), X.calendar(spark, d)
    last = X.levels(spark, d).groupBy("sec").agg(F.max(F.struct("d", "level")).alias("x")).select("sec", F.col("x.d").alias("last_d"), F.col("x.level").alias("last_tr"))
    return returns.forward_returns(cells, grid, X.delistings(spark, d), last).select("sec", "as_of", "fwd", "plain")


@stored("as_of", "factor")
def paired(spark, d):
    """The board's cells of complete months with the return that follows. A name
    delisted within the month counts with what its last trade and its terminal
    return make; composites take the plain return, as they are registered."""
    cells = universe.complete_months(board(spark, d), F.current_date())
    return cells.select("as_of", "sec", "factor", F.round("z", 9).alias("z")).join(forward(spark, d).filter("fwd IS NOT NULL"), ["sec", "as_of"])


@stored()
def ics(spark, d):
    return C.rank_ic(paired(spark, d), ["factor", "as_of"], "z", "fwd", NAMES)


@stored()
def spreads(spark, d):
    return C.quantile_spread(paired(spark, d), ["factor", "as_of"], "z", "fwd", NAMES)


def _rounded(df, *cols, to=6):
    return df.withColumns({c: F.round(c, to) for c in cols})


@query("SELECT sec, as_of, CASE WHEN q = 4 AND days BETWEEN 240 AND 390 THEN ROUND(t_gp, 4) END AS ttm_gp, CASE WHEN q = 4 AND days BETWEEN 240 AND 390 THEN ROUND(t_cfo, 4) END AS ttm_cfo FROM ttm", **BASE)
def pit_ttm(spark, d):
    rows = factors.trailing_year(T.visible(spark, d), ["gp", "cfo"])
    return _rounded(rows.select("sec", "as_of", "ttm_gp", "ttm_cfo"), "ttm_gp", "ttm_cfo", to=4)


@query("SELECT sec, as_of, ROUND(NULLIF(ago_assets0, -1), 2) AS ago_assets, ROUND(ago_shares, 2) AS ago_shares FROM ago", **BASE)
def yoy_base(spark, d):
    rows = factors.year_ago(T.visible(spark, d), ["assets", "shares"])
    return _rounded(rows, "ago_assets", "ago_shares", to=2)


@query("SELECT sec, as_of, factor, ROUND(value, 8) AS value FROM svals WHERE value IS NOT NULL", **BASE, svals=STATEMENT_VALUES)
def statement_factors(spark, d):
    return _rounded(factors.statement_factors(T.visible(spark, d), members(spark, d).select("sec", "as_of", "mktcap", "is_fin")), "value", to=8)


@query("SELECT factor, as_of, COUNT(*) AS n FROM covered GROUP BY 1, 2", **BOARD)
def coverage_filter(spark, d):
    return covered(spark, d).groupBy("factor", "as_of").agg(F.count("*").alias("n"))


@query("""SELECT as_of, ROUND(ratio, 6) AS ratio, ratio BETWEEN 0.55::DOUBLE AND 0.65::DOUBLE AS knife_edge
  FROM (SELECT m.as_of, COUNT(v.value) / CAST(COUNT(*) AS DOUBLE) AS ratio FROM members m LEFT JOIN (SELECT * FROM svals
  WHERE factor = 'gp_a') v ON v.sec = m.sec AND v.as_of = m.as_of GROUP BY 1)""", **BASE, svals=STATEMENT_VALUES)
def coverage_ratio(spark, d):
    m = members(spark, d)
    v = factors.statement_factors(T.visible(spark, d), m.select("sec", "as_of", "mktcap", "is_fin")).filter("factor = 'gp_a'").select("sec", "as_of", "value")
    g = m.join(v, ["sec", "as_of"], "left").groupBy("as_of").agg((F.count("value") / F.count("*")).alias("ratio"))
    return g.select("as_of", F.round("ratio", 6).alias("ratio"), F.col("ratio").between(0.55, 0.65).alias("knife_edge"))


@query("SELECT as_of, sec, factor, ROUND(w, 8) AS w FROM ranked", **BOARD)
def winsorize(spark, d):
    rows = covered(spark, d)
    return rows.select("as_of", "sec", "factor", F.round(stats.winsorized(F.col("value"), ["as_of", "factor"]), 8).alias("w"))


@query("SELECT as_of, sec, factor, ROUND(rank_norm, 6) AS rank_norm FROM ranked", **BOARD)
def rank_normal(spark, d):
    return _rounded(board(spark, d).select("as_of", "sec", "factor", "rank_norm"), "rank_norm")


@query("SELECT as_of, sec, factor, ROUND(z_sector, 6) AS z_sector, ROUND(z, 6) AS z_sector_size FROM cells", **BOARD)
def sector_size_neutral(spark, d):
    return _rounded(board(spark, d).select("as_of", "sec", "factor", "z_sector", F.col("z").alias("z_sector_size")), "z_sector", "z_sector_size")


@query("SELECT factor, as_of, ROUND(ic, 6) AS ic, n FROM ics", **EVAL)
def ic_monthly(spark, d):
    return _rounded(ics(spark, d), "ic")


@query("SELECT factor, as_of, n, ROUND(top, 6) AS top, ROUND(bottom, 6) AS bottom, ROUND(top - bottom, 6) AS ls FROM lsq", **EVAL)
def ls_quantile(spark, d):
    return _rounded(spreads(spark, d), "top", "bottom", "ls")


def _newey_west_sql(lags: int, source: str) -> str:
    parts = " + ".join(f"COALESCE(SUM(e * l{j}), 0) * {2 * (1 - j / (lags + 1))!r}::DOUBLE" for j in range(1, lags + 1)) or "0"
    cols = "".join(f", lag(e, {j}) OVER (PARTITION BY factor ORDER BY as_of) AS l{j}" for j in range(1, lags + 1))
    return f"SELECT factor, n, mean, CASE WHEN sqrt(greatest(s, 0)) / n > 1e-15::DOUBLE THEN mean / (sqrt(greatest(s, 0)) / n) END AS t FROM (SELECT factor, COUNT(*) AS n, avg(v) AS mean, SUM(e * e) + {parts} AS s FROM (SELECT *{cols} FROM (SELECT factor, as_of, v, v - avg(v) OVER (PARTITION BY factor) AS e FROM ({source}))) GROUP BY 1)"


@query(f"SELECT factor, n, ROUND(mean, 6) AS mean, ROUND(t, 5) AS t FROM ({_newey_west_sql(3, 'SELECT factor, as_of, ic AS v FROM ics')})", **EVAL)
def ic_newey_west(spark, d):
    return stats.newey_west(ics(spark, d), "ic", "as_of", ["factor"], 3).select("factor", "n", F.round("mean", 6).alias("mean"), F.round("t", 5).alias("t"))


@query(f"""SELECT g.factor, months, ROUND(mean_ic, 6) AS mean_ic, ROUND(mean_ic / sd, 5) AS icir, ROUND(a.t, 5) AS ic_t, ROUND(12 * m, 6) AS ls_ann,
  ROUND(b.t, 5) AS ls_t FROM (
  SELECT i.factor, COUNT(ic) AS months, avg(ic) AS mean_ic, stddev_pop(ic) AS sd, avg(top - bottom) AS m FROM ics i
  JOIN lsq USING (factor, as_of) GROUP BY 1 HAVING COUNT(ic) >= 12) g
  JOIN ({_newey_west_sql(0, 'SELECT factor, as_of, ic AS v FROM ics')}) a ON a.factor = g.factor
  JOIN ({_newey_west_sql(0, 'SELECT factor, as_of, top - bottom AS v FROM lsq')}) b ON b.factor = g.factor""", **EVAL)
def factor_summary(spark, d):
    monthly = ics(spark, d).drop("n").join(spreads(spark, d).select("factor", "as_of", "ls"), ["factor", "as_of"])
    s = C.summary(monthly, "factor", 12)
    return s.select("factor", "months", F.round("mean_ic", 6).alias("mean_ic"), F.round("icir", 5).alias("icir"), F.round("ic_t", 5).alias("ic_t"), F.round("ls_ann", 6).alias("ls_ann"), F.round("ls_t", 5).alias("ls_t"))


@query("""SELECT as_of, n, ROUND(b, 8) AS beta FROM (SELECT as_of, COUNT(*) AS n, covar_pop(z, fwd) / stddev_pop(z) AS b FROM paired
  WHERE factor = 'mom_12_1' GROUP BY 1 HAVING COUNT(*) >= 10 AND stddev_pop(z) > 1e-9::DOUBLE)""", **EVAL)
def fm_univariate(spark, d):
    g = paired(spark, d).filter("factor = 'mom_12_1'").groupBy("as_of").agg(F.count("*").alias("n"), F.covar_pop("z", "fwd").alias("c"), F.stddev_pop("z").alias("s"))
    return g.filter("n >= 10 AND s > 1e-9").select("as_of", "n", F.round(F.col("c") / F.col("s"), 8).alias("beta"))


@query("""SELECT as_of, n, ROUND((c1 / s1 - r * c2 / s2) / (1 - r * r), 7) AS beta_mom, ROUND((c2 / s2 - r * c1 / s1) / (1 - r * r),
  7) AS beta_bp FROM (
  SELECT as_of, COUNT(*) AS n, covar_pop(a, y) AS c1, covar_pop(b, y) AS c2, stddev_pop(a) AS s1, stddev_pop(b) AS s2, corr(a, b) AS r FROM (
    SELECT m.as_of, m.sec, m.z AS a, p.z AS b, m.fwd AS y FROM paired m JOIN paired p ON p.sec = m.sec AND p.as_of = m.as_of
    WHERE m.factor = 'mom_12_1' AND p.factor = 'bp') GROUP BY 1 HAVING COUNT(*) >= 10) WHERE 1 - r * r > 1e-6""", **EVAL)
def fm_two_factor(spark, d):
    p = paired(spark, d)
    wide = p.filter(F.col("factor").isin("mom_12_1", "bp")).groupBy("as_of", "sec").agg(F.max(F.when(F.col("factor") == "mom_12_1", F.col("z"))).alias("a"), F.max(F.when(F.col("factor") == "bp", F.col("z"))).alias("b"), F.first("fwd").alias("y")).dropna()
    g = wide.groupBy("as_of").agg(F.count("*").alias("n"), F.covar_pop("a", "y").alias("c1"), F.covar_pop("b", "y").alias("c2"), F.stddev_pop("a").alias("s1"), F.stddev_pop("b").alias("s2"), stats.correlation("a", "b").alias("r")).filter("n >= 10 AND 1 - r * r > 1e-6")
    det = 1 - F.col("r") * F.col("r")
    u, v = F.col("c1") / F.col("s1"), F.col("c2") / F.col("s2")
    return g.select("as_of", "n", F.round((u - F.col("r") * v) / det, 7).alias("beta_mom"), F.round((v - F.col("r") * u) / det, 7).alias("beta_bp"))


def _least_squares_sql() -> dict[str, str]:
    """Least squares of the return on all factors by Gauss and Jordan, a step a
    factor, on the correlations of the complete cases of each month."""
    k = len(FACTORS)
    out = {
        "complete": f"SELECT * FROM paired QUALIFY COUNT(*) OVER (PARTITION BY as_of, sec) = {k}",
        "columns_": f"""SELECT as_of, sec, list_position([{_in(FACTORS)}], factor) AS k, z AS v FROM complete
    UNION ALL SELECT as_of, sec, {k + 1}, MAX(fwd) FROM complete GROUP BY 1, 2""",
        "system0": f"""SELECT a.as_of, a.k AS i, b.k AS j, COUNT(*) AS n, CASE WHEN stddev_pop(a.v) > 1e-9::DOUBLE
        AND (b.k > {k} OR stddev_pop(b.v) > 1e-9::DOUBLE)
      THEN covar_pop(a.v, b.v) / stddev_pop(a.v) / CASE WHEN b.k > {k} THEN 1 ELSE stddev_pop(b.v) END ELSE 0 END AS v
    FROM columns_ a JOIN columns_ b ON b.as_of = a.as_of AND b.sec = a.sec WHERE a.k <= {k} GROUP BY 1, 2, 3 HAVING COUNT(*) >= {REGRESSED}""",
    }
    for s in range(1, k + 1):
        out[f"system{s}"] = f"""SELECT a.as_of, a.i, a.j, a.n, CASE WHEN p.v <= 1e-9::DOUBLE THEN CASE WHEN a.i = {s} THEN 0 ELSE a.v END
      WHEN a.i = {s} THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END AS v
    FROM system{s - 1} a JOIN system{s - 1} p ON p.as_of = a.as_of AND p.i = {s} AND p.j = {s}
    JOIN system{s - 1} r ON r.as_of = a.as_of AND r.i = {s} AND r.j = a.j JOIN system{s - 1} c ON c.as_of = a.as_of AND c.i = a.i AND c.j = {s}"""
    out["fm"] = f"""SELECT as_of, [{_in(FACTORS)}][i] AS term, v AS beta, n FROM system{k} WHERE j = {k + 1}
    UNION ALL SELECT as_of, 'intercept', avg(v), COUNT(*) FROM columns_ WHERE k = {k + 1} GROUP BY 1 HAVING COUNT(*) >= {REGRESSED}"""
    return out


REGRESSION = dict(**EVAL, **_least_squares_sql())


@stored("as_of")
def complete(spark, d):
    """The names of each month that have every factor of the registry and a
    return, one column a factor; months with at least REGRESSED of them."""
    wide = paired(spark, d).groupBy("as_of", "sec").pivot("factor", FACTORS).agg(F.first("z").alias("z"), F.first("fwd").alias("fwd"))
    names = [F.col(f"{f}_z").alias(f) for f in FACTORS]
    rows = wide.select("as_of", "sec", *names, F.col(f"{FACTORS[0]}_fwd").alias("fwd")).dropna()
    return rows.withColumn("n", F.count("*").over(Window.partitionBy("as_of"))).filter(F.col("n") >= REGRESSED)


@stored()
def fm_betas(spark, d):
    """Each month's slopes on all factors of the registry, over complete cases."""
    return stats.grouped_ols(complete(spark, d), "fwd", FACTORS, "as_of", REGRESSED)


@query("SELECT as_of, term, ROUND(beta, 6) AS beta, n FROM fm", **REGRESSION)
def fm_multi(spark, d):
    return fm_betas(spark, d).select("as_of", "term", F.round("beta", 6).alias("beta"), "n")


@query(f"SELECT factor AS term, n, ROUND(mean, 6) AS mean, ROUND(t, 4) AS t FROM ({_newey_west_sql(3, 'SELECT term AS factor, as_of, beta AS v FROM fm')})", **REGRESSION)
def fm_multi_newey_west(spark, d):
    rows = stats.newey_west(fm_betas(spark, d), "beta", "as_of", ["term"], 3)
    return rows.select("term", "n", F.round("mean", 6).alias("mean"), F.round("t", 4).alias("t"))


_DRAWS = """SELECT factor, draw, ANY_VALUE(n) AS n, SUM(list_sum(list_transform(range(start, start + least(6, n - 6 * j)), lambda i: v[1 + i % n]))) / ANY_VALUE(n) AS mean FROM (
  SELECT *, CAST('0x' || substr(md5('20260726:' || factor || ':' || draw || ':' || j), 1, 13) AS BIGINT) % n AS start FROM (
    SELECT *, unnest(range(0, n // 6 + 1)) AS j FROM (SELECT *, unnest(range(1, 2001)) AS draw FROM (
      SELECT factor, list(top - bottom ORDER BY as_of) AS v, COUNT(*) AS n FROM lsq GROUP BY 1)))) GROUP BY 1, 2"""


@query("SELECT factor, n, ROUND(quantile_cont(mean, 0.025), 6) AS low, ROUND(quantile_cont(mean, 0.975), 6) AS high FROM draws GROUP BY 1, 2", **EVAL, draws=_DRAWS)
def bootstrap_ci(spark, d):
    ls = spreads(spark, d)
    return _rounded(stats.block_bootstrap(ls, "ls", "as_of", "factor"), "low", "high")


#: Complete cases, a row a factor, in months with enough of them.
FULL = f"SELECT * FROM complete QUALIFY COUNT(*) OVER (PARTITION BY as_of) >= {REGRESSED} * {len(FACTORS)}"
REDUNDANCY = """SELECT a, b, avg(abs(r)) AS rho, COUNT(*) AS months FROM (
    SELECT x.factor AS a, y.factor AS b, x.as_of, CASE WHEN stddev_pop(x.z) > 1e-9::DOUBLE AND stddev_pop(y.z) > 1e-9::DOUBLE
    THEN covar_pop(x.z, y.z) / (stddev_pop(x.z) * stddev_pop(y.z)) END AS r
    FROM full_ x JOIN full_ y ON x.as_of = y.as_of AND x.sec = y.sec AND x.factor < y.factor GROUP BY 1, 2, 3) WHERE r IS NOT NULL GROUP BY 1, 2"""


def full(spark, d):
    """Complete cases, a row a factor."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f).alias("z")) for f in FACTORS]))
    return complete(spark, d).select("as_of", "sec", "fwd", each.alias("x")).select("as_of", "sec", "fwd", "x.*")


@query(f"""SELECT factor, as_of, ROUND(corr(ra, rb), 6) AS ic, COUNT(*) AS n FROM (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY factor, as_of ORDER BY z, sec) AS DOUBLE) AS ra,
    CAST(ROW_NUMBER() OVER (PARTITION BY factor, as_of ORDER BY fwd, sec) AS DOUBLE) AS rb FROM full_) GROUP BY 1, 2""", **REGRESSION, full_=FULL)
def univariate_ic(spark, d):
    """Each factor's rank correlation with the return over complete cases."""
    return _rounded(C.rank_ic(full(spark, d), ["factor", "as_of"], "z", "fwd", REGRESSED), "ic")


@query("SELECT a, b, ROUND(rho, 6) AS rho, months FROM red", **REGRESSION, full_=FULL, red=REDUNDANCY)
def redundancy_matrix(spark, d):
    return _rounded(C.redundancy(full(spark, d), "z"), "rho")


CUTS = (0.5, 0.7)
# by the definition: the mean distance between the members of two clusters, all anew at each step
_NAMES = "SELECT f, ROW_NUMBER() OVER (ORDER BY f) - 1 AS i FROM (SELECT a AS f FROM red UNION SELECT b FROM red)"
_MATRIX = "SELECT list(d ORDER BY i, j) AS d, (SELECT COUNT(*) FROM names_) AS k FROM (SELECT x.i, y.i AS j, CASE WHEN x.i = y.i THEN 0 ELSE 1 - COALESCE(r.rho, 0) END AS d FROM names_ x CROSS JOIN names_ y LEFT JOIN red r ON r.a = least(x.f, y.f) AND r.b = greatest(x.f, y.f))"
_MERGES = f"""WITH RECURSIVE walk(cut, step, to_) AS (SELECT unnest({list(CUTS)}::DOUBLE[]), 0, range(k) FROM matrix
  UNION ALL SELECT cut, step + 1, list_transform(to_, lambda t: CASE WHEN t = best.p % k THEN best.p // k ELSE t END) FROM (
    SELECT w.*, m.k, list_sort(list_transform(list_filter(range(k * k), lambda p: p // k < p % k AND list_contains(to_, p // k) AND list_contains(to_, p % k)),
      lambda p: {{'v': list_avg(list_transform(list_filter(range(k * k), lambda q: to_[1 + q // k] = p // k AND to_[1 + q % k] = p % k), lambda q: d[1 + q])), 'p': p}}))[1] AS best
    FROM walk w CROSS JOIN matrix m) WHERE best.v <= cut)
  SELECT cut, arg_max(to_, step) AS to_ FROM walk GROUP BY 1"""


@query(f"""SELECT CAST(cut AS DOUBLE) AS cut, CAST(ROW_NUMBER() OVER (PARTITION BY cut ORDER BY members) - 1 AS INTEGER) AS cluster, members FROM (
  SELECT cut, string_agg(f, ',' ORDER BY f) AS members FROM merges, names_ GROUP BY cut, to_[1 + i])""", **REGRESSION, full_=FULL, red=REDUNDANCY, names_=_NAMES, matrix=_MATRIX, merges=_MERGES)
def clusters(spark, d):
    """Groups of alike factors at two cuts."""
    rows = C.redundancy(full(spark, d), "z")
    return stats.average_linkage(rows.select("a", "b", (1 - F.col("rho")).alias("distance")), list(CUTS))


#: The registered composites a and b, and one of price and balance sheet only:
#: their members, and how many of them a name needs.
COMPOSITES = {
    "a": (["mom_12_1", "gp_a", "sue", "net_issuance"], 3), "b": (["mom_12_1", "gp_a", "sue", "net_issuance", "ebit_ev", "bp"], 4),
    "c": (["mom_12_1", "bp", "asset_growth", "accruals"], 3),
}
REGISTERED = ("a", "b")
SIGNS = {f: factors.REGISTRY[f][1] for f in FACTORS}
SIGN_SQL = f"CASE WHEN factor IN ({_in(f for f in FACTORS if SIGNS[f] < 0)}) THEN -1 ELSE 1 END"


def _composite_sql(which: str, weighted: bool) -> dict[str, str]:
    names, least = COMPOSITES[which]
    signed = f"SELECT as_of, sec, factor, plain AS fwd, {SIGN_SQL} * z AS z FROM paired WHERE factor IN ({_in(names)}) AND plain IS NOT NULL"
    # every member has a weight at every month: that of the months before it
    weights = f"""SELECT as_of, factor, CASE WHEN MIN(n) OVER g < {BURN_IN} OR SUM(m) OVER g <= 1e-9::DOUBLE
    THEN 1::DOUBLE / COUNT(*) OVER g ELSE m / SUM(m) OVER g END AS weight FROM (
    SELECT c.as_of, f.factor, greatest(COALESCE(avg(i.ic) OVER w, 0), 0) AS m, COUNT(i.ic) OVER w AS n
    FROM calendar c CROSS JOIN (SELECT unnest([{_in(names)}]) AS factor) f LEFT
    JOIN (SELECT factor, as_of, {SIGN_SQL} * ic AS ic FROM ics) i ON i.as_of = c.as_of AND i.factor = f.factor
    WINDOW w AS (PARTITION BY f.factor ORDER BY c.as_of ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WINDOW g AS (PARTITION BY as_of)"""
    equal = f"SELECT as_of, factor, 1::DOUBLE AS weight FROM calendar CROSS JOIN (SELECT unnest([{_in(names)}]) AS factor)"
    scored = f"""SELECT s.as_of, s.sec, MAX(fwd) AS fwd, ROUND(SUM(z * weight) / CASE WHEN SUM(weight) > 1e-9::DOUBLE
    THEN SUM(weight) ELSE 1 END, 9) AS score
    FROM signed s JOIN weights_ w ON w.as_of = s.as_of AND w.factor = s.factor GROUP BY 1, 2 HAVING COUNT(*) >= {least}"""
    counted = f"""SELECT as_of, n, avg(CASE WHEN r > n - k THEN fwd END) - avg(CASE WHEN r <= k THEN fwd END) AS ls FROM (
    SELECT as_of, fwd, ROW_NUMBER() OVER (PARTITION BY as_of
    ORDER BY score, sec) AS r, COUNT(*) OVER (PARTITION BY as_of) AS n, greatest(COUNT(*) OVER (PARTITION BY as_of) // 10, 1) AS k FROM scored)
    WHERE n >= {NAMES} GROUP BY as_of, n"""
    return dict(signed=signed, weights_=weights if weighted else equal, scored=scored, counted=counted)


def weights(spark, d, which):
    names = COMPOSITES[which][0]
    return C.walk_forward_weights(ics(spark, d), X.calendar(spark, d).select("as_of"), {f: SIGNS[f] for f in names}, BURN_IN)


def scored(spark, d, which, weighted):
    names, least = COMPOSITES[which]
    plain = paired(spark, d).filter("plain IS NOT NULL").withColumn("fwd", F.col("plain"))
    rows = C.composite(plain, {f: SIGNS[f] for f in names}, "z", least, weights(spark, d, which) if weighted else None, keep="fwd")
    return rows.withColumn("score", F.round("score", 9))


def _spread(spark, d, which, weighted):
    return C.counted_spread(scored(spark, d, which, weighted), ["as_of"], "score", "fwd", NAMES).select("as_of", "n", "ls")


def _composite(name: str, which: str, weighted: bool):
    def run(spark, d):
        return _rounded(_spread(spark, d, which, weighted), "ls")

    run.__name__, run.__module__ = name, __name__
    return query("SELECT as_of, n, ROUND(ls, 6) AS ls FROM counted", **EVAL, **_composite_sql(which, weighted))(run)


composite_a_ew = _composite("composite_a_ew", "a", False)
composite_a_icw = _composite("composite_a_icw", "a", True)
composite_b_ew = _composite("composite_b_ew", "b", False)
composite_b_icw = _composite("composite_b_icw", "b", True)
composite_ew = _composite("composite_ew", "c", False)
composite_icw = _composite("composite_icw", "c", True)


@query("SELECT as_of, factor, ROUND(weight, 7) AS weight FROM weights_", **EVAL, **_composite_sql("b", True))
def walk_forward_weights(spark, d):
    return _rounded(weights(spark, d, "b"), "weight", to=7)


HOLDOUT = datetime.date(2000, 7, 31)


@query("""SELECT as_of > DATE '2000-07-31' AS holdout, COUNT(*) AS months, ROUND(12 * avg(ls), 6) AS ann, ROUND(stddev_pop(ls) * sqrt(12), 6) AS vol,
  ROUND(MIN(ls), 6) AS worst FROM counted GROUP BY 1""", **EVAL, **_composite_sql("a", False))
def masked_holdout(spark, d):
    g = _spread(spark, d, "a", False).groupBy((F.col("as_of") > F.lit(HOLDOUT)).alias("holdout"))
    vol = F.round(F.stddev_pop("ls") * F.sqrt(F.lit(12.0)), 6).alias("vol")
    return g.agg(F.count("*").alias("months"), F.round(12 * F.avg("ls"), 6).alias("ann"), vol, F.round(F.min("ls"), 6).alias("worst"))


@query("""SELECT factor, as_of, ROUND(product(1 + ls) OVER (PARTITION BY factor ORDER BY as_of ROWS UNBOUNDED PRECEDING), 4) AS curve FROM (
  SELECT factor, as_of, ROUND(top - bottom, 6) AS ls FROM lsq)""", **EVAL)
def equity_curve(spark, d):
    return C.equity_curve(spreads(spark, d).withColumn("ls", F.round("ls", 6)), "factor", "ls").select("factor", "as_of", "curve")


_CURVE = "SELECT as_of, ROUND(product(1 + ROUND(ls, 6)) OVER (ORDER BY as_of ROWS UNBOUNDED PRECEDING), 4) AS curve, as_of > DATE '2000-07-31' AS holdout FROM counted"


def _all_composites_sql() -> tuple[str, dict[str, str]]:
    """One statement for the four: their parts under names of their own."""
    parts, ctes = [], {}
    for which in REGISTERED:
        for weighted in (False, True):
            tag = f"{which}_{'icw' if weighted else 'ew'}"
            own = _composite_sql(which, weighted)
            for name, sql in own.items():
                for other in own:
                    sql = re.sub(rf"(FROM|JOIN) {other}\b", rf"\1 {other}_{tag}", sql)
                ctes[f"{name}_{tag}"] = sql
            parts.append(f"SELECT '{tag}' AS composite, * FROM ({_CURVE.replace('FROM counted', f'FROM counted_{tag}')})")
    return " UNION ALL ".join(parts), ctes


_CURVES_SQL, _CURVES_CTES = _all_composites_sql()


@query(_CURVES_SQL, **EVAL, **_CURVES_CTES)
def composite_curves(spark, d):
    """The curves of the four composites and where their holdout begins."""
    out = None
    for which in REGISTERED:
        for weighted in (False, True):
            tag = f"{which}_{'icw' if weighted else 'ew'}"
            one = _rounded(_spread(spark, d, which, weighted), "ls").withColumn("composite", F.lit(tag))
            out = one if out is None else out.unionByName(one)
    return C.equity_curve(out, "composite", "ls").select("composite", "as_of", "curve", (F.col("as_of") > F.lit(HOLDOUT)).alias("holdout"))


@query("""SELECT p.as_of, p.sec, side, m.symbol, x.sector, ROUND(score, 6) AS score
  FROM (SELECT *, CASE WHEN r > n - k THEN 'long' WHEN r <= k THEN 'short' END AS side FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY as_of
  ORDER BY score, sec) AS r, COUNT(*) OVER (PARTITION BY as_of) AS n, least(greatest(COUNT(*) OVER (PARTITION BY as_of) // 10, 1), 25) AS k
  FROM scored WHERE as_of = (SELECT MAX(as_of) FROM scored))) p
  LEFT JOIN (SELECT sec, arg_max(symbol, (valid_from, symbol)) AS symbol FROM symbol_map GROUP BY 1) m ON m.sec = p.sec
  JOIN securities x ON x.sec = p.sec
  WHERE side IS NOT NULL""", **EVAL, **_composite_sql("a", False))
def portfolio_top_bottom(spark, d):
    rows = scored(spark, d, "a", False)
    last = rows.agg(F.max("as_of").alias("as_of"))
    w = Window.partitionBy("as_of")
    rows = rows.join(F.broadcast(last), "as_of")  # one row is broadcast
    rows = rows.withColumn("r", F.row_number().over(w.orderBy("score", "sec"))).withColumn("n", F.count("*").over(w))
    k = F.least(F.greatest(F.floor(F.col("n") / 10), F.lit(1)), F.lit(25))
    rows = rows.withColumn("side", F.when(F.col("r") > F.col("n") - k, "long").when(F.col("r") <= k, "short")).filter("side IS NOT NULL")
    sym = X.symbol_map(spark, d).groupBy("sec").agg(F.max(F.struct("valid_from", "symbol"))["symbol"].alias("symbol"))
    named = rows.join(sym, "sec", "left").join(X.securities(spark, d).select("sec", "sector"), "sec")
    return named.select("as_of", "sec", "side", "symbol", "sector", F.round("score", 6).alias("score"))


@query("""SELECT factor, as_of, ROUND(ls, 6) AS ls
  FROM (SELECT factor, as_of, top - bottom AS ls, ROW_NUMBER() OVER (PARTITION BY factor ORDER BY top - bottom, as_of) AS r FROM lsq) WHERE r <= 5""", **EVAL)
def worst_months(spark, d):
    rows = spreads(spark, d).withColumn("r", F.row_number().over(Window.partitionBy("factor").orderBy("ls", "as_of"))).filter("r <= 5")
    return _rounded(rows.select("factor", "as_of", "ls"), "ls")


EXTERNAL = "SELECT date_trunc('month', d) AS m, avg(close) / 1000 - 1 AS v FROM bars WHERE sec % 2 = 0 GROUP BY 1"
OUTSIDE = """SELECT factor, COUNT(*) AS months, corr(ls, v) AS rho FROM (
  SELECT l.factor, l.top - l.bottom AS ls, e.v FROM lsq l JOIN external e ON e.m = date_trunc('month', l.as_of) + INTERVAL 1 MONTH) GROUP BY 1
  HAVING COUNT(*) >= 24"""


def outside(spark, d):
    """Correlation of each factor's spread with an outside series, by the month
    that returns accrue in."""
    e = X.bars(spark, d).filter("sec % 2 = 0").groupBy(F.trunc("d", "MM").alias("m")).agg((F.avg("close") / 1000 - 1).alias("v"))
    ls = spreads(spark, d).withColumn("m", F.add_months(F.trunc("as_of", "MM"), 1))
    return ls.join(e, "m").groupBy("factor").agg(F.count("*").alias("months"), stats.correlation("ls", "v").alias("rho")).filter("months >= 24")


@query("SELECT factor, months, ROUND(rho, 6) AS rho FROM outside", **EVAL, external=EXTERNAL, outside=OUTSIDE)
def external_correlation(spark, d):
    return _rounded(outside(spark, d), "rho")


REPLICATION = f"SELECT factor, avg(top - bottom) AS m, avg(top - bottom) * {SIGN_SQL} > 0 AS ok FROM lsq GROUP BY 1"


def _signs(spark, d):
    prior = F.when(F.col("factor").isin([f for f in FACTORS if SIGNS[f] < 0]), -1).otherwise(1)
    return spreads(spark, d).groupBy("factor").agg(F.avg("ls").alias("m")).withColumn("ok", F.col("m") * prior > 0)


@query("SELECT factor, ROUND(12 * m, 6) AS ann, ok AS sign_ok FROM rep", **EVAL, rep=REPLICATION)
def replication_gate(spark, d):
    return _signs(spark, d).select("factor", F.round(12 * F.col("m"), 6).alias("ann"), F.col("ok").alias("sign_ok"))


#: Whose signs the verdict rests on, with the outside correlation of momentum (fixed values).
CANONICAL = ["ebit_ev", "gp_a", "accruals", "asset_growth", "mom_12_1"]
LEAST_RHO = 0.6


@query(f"""SELECT passed, checks, CASE WHEN passed = checks THEN 'PASS' ELSE 'REVIEW' END AS verdict FROM (
  SELECT COUNT(CASE WHEN ok THEN 1 END) AS passed, COUNT(*) AS checks FROM (
    SELECT COALESCE(ok, FALSE) AS ok FROM (SELECT unnest([{_in(CANONICAL)}]) AS factor) c LEFT JOIN rep USING (factor)
    UNION ALL SELECT rho >= {LEAST_RHO}::DOUBLE FROM outside WHERE factor = 'mom_12_1'))""", **EVAL, rep=REPLICATION, external=EXTERNAL, outside=OUTSIDE)
def replication_verdict(spark, d):
    """The signs expected beforehand, a factor without data failing, and the
    outside correlation of momentum where months overlap enough."""
    asked = spark.range(1).select(F.explode(F.array(*[F.lit(f) for f in CANONICAL])).alias("factor"))
    signs = asked.join(_signs(spark, d), "factor", "left").select(F.coalesce("ok", F.lit(False)).alias("ok"))
    rows = signs.unionByName(outside(spark, d).filter("factor = 'mom_12_1'").select((F.col("rho") >= LEAST_RHO).alias("ok")))
    g = rows.agg(F.count_if("ok").alias("passed"), F.count("*").alias("checks"))
    return g.withColumn("verdict", F.when(F.col("passed") == F.col("checks"), "PASS").otherwise("REVIEW"))


# hand audit: momentum ranked raw over members, beside the stored spread
HAND = f"""SELECT as_of, next_of, n, avg(CASE WHEN r > n - k THEN fwd END) - avg(CASE WHEN r <= k THEN fwd END) AS ls FROM (
  SELECT as_of, next_of, fwd, ROW_NUMBER() OVER (PARTITION BY as_of
  ORDER BY mom, sec) AS r, COUNT(*) OVER (PARTITION BY as_of) AS n, greatest(COUNT(*) OVER (PARTITION BY as_of) // 10, 1) AS k FROM (
    SELECT m.sec, m.as_of, l.nxt_asof AS next_of, l.tr1 / l.tr12 - 1 AS mom, l.nxt / l.tr - 1 AS fwd FROM members m
    JOIN lags l ON l.sec = m.sec AND l.as_of = m.as_of)
  WHERE mom IS NOT NULL AND fwd IS NOT NULL) WHERE n >= {NAMES} GROUP BY as_of, next_of, n"""


def hand_series(spark, d):
    """(as_of, next_of, n, ls) of momentum by the raw signal over members."""
    cells, grid = X.month_end(spark, d), X.calendar(spark, d)
    pairs = returns.momentum(cells, grid).withColumnRenamed("value", "mom").join(returns.forward_returns(cells, grid).drop("ai"), ["sec", "as_of"])
    hand = C.counted_spread(pairs.join(members(spark, d).select("sec", "as_of"), ["sec", "as_of"]), ["as_of"], "mom", "fwd", NAMES).select("as_of", "n", "ls")
    after = grid.select("as_of", F.lead("as_of").over(Window.orderBy("as_of")).alias("next_of"))  # a row a month
    return hand.join(F.broadcast(after), "as_of")


@query("""SELECT keyed, COUNT(*) AS months, ROUND(corr(ls, v), 6) AS rho FROM (
    SELECT 'return month' AS keyed, h.ls, e.v FROM hand h JOIN external e ON e.m = date_trunc('month', next_of)
    UNION ALL SELECT 'signal month', h.ls, e.v FROM hand h JOIN external e ON e.m = date_trunc('month', as_of)
    UNION ALL SELECT 'stored', h.ls, l.top - l.bottom FROM hand h JOIN lsq l ON l.as_of = h.as_of AND l.factor = 'mom_12_1') GROUP BY 1
    HAVING COUNT(*) >= 24""", **EVAL, external=EXTERNAL, hand=HAND)
def hand_audit(spark, d):
    """The hand series against the outside one, keyed by the month returns accrue
    in and by that of the signal, and against the stored spread."""
    hand = hand_series(spark, d)
    e = X.bars(spark, d).filter("sec % 2 = 0").groupBy(F.trunc("d", "MM").alias("m")).agg((F.avg("close") / 1000 - 1).alias("v"))
    keys = F.explode(F.array(F.struct(F.lit("return month").alias("keyed"), F.trunc("next_of", "MM").alias("m")), F.struct(F.lit("signal month").alias("keyed"), F.trunc("as_of", "MM").alias("m"))))
    outer = hand.select("ls", keys.alias("k")).select("ls", "k.*").join(e, "m").select("keyed", "ls", "v")
    kept = spreads(spark, d).filter("factor = 'mom_12_1'").select("as_of", F.col("ls").alias("v"))
    rows = outer.unionByName(hand.join(kept, "as_of").select(F.lit("stored").alias("keyed"), "ls", "v"))
    g = rows.groupBy("keyed").agg(F.count("*").alias("months"), F.round(stats.correlation("ls", "v"), 6).alias("rho"))
    return g.filter("months >= 24")


@query("""SELECT as_of, COUNT(*) AS members, date_trunc('month', as_of) = (SELECT date_trunc('month',
  MAX(d)) FROM bars) AS running FROM members GROUP BY 1
  HAVING date_trunc('month', as_of) < (SELECT date_trunc('month', MAX(d)) FROM bars)""", **BASE)
def complete_months(spark, d):
    """Months evaluated when today is the day of the last bar."""
    today = X.bars(spark, d).agg(F.max("d")).first()[0]
    rows = universe.complete_months(members(spark, d), F.lit(today)).groupBy("as_of").agg(F.count("*").alias("members"))
    return rows.withColumn("running", F.trunc("as_of", "MM") == F.trunc(F.lit(today), "MM"))
