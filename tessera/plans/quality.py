"""Queries of the quality gates, audits, adjudication and the summary page."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import predicates as P
from tessera.operators import quality as Q
from tessera.operators import factors, returns, selection
from tessera.operators import temporal as TJ
from tessera.plans import history as H
from tessera.plans import panel
from tessera.plans import temporal as T
from tessera.plans.registry import query
from tessera.sources import fixtures as X
from tessera.streaming.recompute import required


@query("""SELECT COUNT(*) AS rows_, COUNT(CASE WHEN NOT COALESCE(accepted <= CAST(as_of AS TIMESTAMP) + INTERVAL 16 HOUR AND timing_pit
  AND period_end <= as_of, FALSE) THEN 1 END) AS violations FROM visible_ WHERE nth <= 6""", visible_=T.VISIBLE)
def gate_point_in_time(spark, d):
    return Q.violations(T.visible(spark, d), ~(P.visible("accepted", "as_of") & F.col("timing_pit") & (F.col("period_end") <= F.col("as_of"))))


OVERLAPS = """SELECT a.symbol, a.sec AS sa, b.sec AS sb, a.valid_from AS fa, b.valid_from AS fb,
  date_diff('day', greatest(a.valid_from, b.valid_from), least(COALESCE(a.valid_to, DATE '9999-12-31'), COALESCE(b.valid_to, DATE '9999-12-31'))) + 1 AS days
  FROM symbol_map a JOIN symbol_map b ON a.symbol = b.symbol AND a.sec < b.sec AND a.valid_from <= COALESCE(b.valid_to, DATE '9999-12-31')
  AND b.valid_from <= COALESCE(a.valid_to, DATE '9999-12-31')"""


def _overlaps(spark, d):
    end = lambda c: F.coalesce(F.col(c), F.lit(TJ.FOREVER).cast("date"))
    days = F.datediff(F.least(end("a_to"), end("b_to")), F.greatest("a_from", "b_from")) + 1
    return TJ.overlaps(X.symbol_map(spark, d), "symbol", "sec").withColumn("days", days)


@query("""SELECT COUNT(*) AS rows_, COUNT(CASE WHEN q.symbol IS NULL THEN 1 END) AS violations FROM overlaps_ o LEFT
  JOIN (SELECT DISTINCT symbol FROM symbol_map WHERE sec % 3 = 0) q ON q.symbol = o.symbol""", overlaps_=OVERLAPS)
def gate_identity(spark, d):
    quarantined = X.symbol_map(spark, d).filter("sec % 3 = 0").select("symbol", F.lit(True).alias("known")).distinct()
    return Q.violations(_overlaps(spark, d).join(quarantined, "symbol", "left"), F.col("known").isNull())


RECON = """SELECT sec, CASE WHEN n > 0 AND bad <= greatest(10::DOUBLE, 0.02::DOUBLE * n) THEN ROUND(100 * (1 - mism / n::DOUBLE), 2) END AS pct
  FROM (SELECT sec, COUNT(CASE WHEN NOT insane THEN 1 END) AS n, COUNT(CASE WHEN insane THEN 1 END) AS bad,
  COUNT(CASE WHEN NOT insane AND mismatch THEN 1 END) AS mism FROM pairs GROUP BY 1)"""


@query("""SELECT COUNT(*) AS rows_, ROUND(COUNT(CASE WHEN pct IS NULL OR pct >= 95
  THEN 1 END) / CAST(COUNT(*) AS DOUBLE), 6) AS share, COUNT(CASE WHEN pct IS NULL OR pct >= 95
  THEN 1 END) / CAST(COUNT(*) AS DOUBLE) >= 0.99::DOUBLE AS passed
  FROM members m LEFT JOIN recon r ON r.sec = m.sec""", **H.UNIVERSE, members=panel.MEMBERS, daily=H.DAILY, pairs=H.PAIRS, recon=RECON)
def gate_reconciled_members(spark, d):
    pct = returns.match_score(H._pairs(spark, d)).select("sec", "pct")
    return Q.share(panel.members(spark, d).join(pct, "sec", "left"), F.col("pct").isNull() | (F.col("pct") >= 95), 0.99)


@query("""SELECT COUNT(*) AS rows_, COUNT(CASE WHEN c_custkey % 40 = 7 THEN 1 END) AS violations FROM customer""")
def gate_embedded_issuer(spark, d):
    k = F.col("c_custkey")
    told = F.when(k % 40 == 7, k + 1).otherwise(k)
    raw = F.concat(F.lit('{"income": {"cik": "'), P.padded_id(told.cast("string")), F.lit('"}}'))
    rows = X.table(spark, d, "customer").select(k.cast("string").alias("cik"), raw.alias("raw"))
    return Q.violations(rows, ~P.same_issuer("cik", F.get_json_object("raw", "$.income.cik")))


@query("""SELECT COUNT(*) AS rows_, COUNT(CASE WHEN timing_pit AND date_diff('day', period_end, CAST(accepted AS DATE)) <= 10
  THEN 1 END) AS violations FROM statements""")
def gate_timing_flag(spark, d):
    return Q.violations(X.statements(spark, d), F.col("timing_pit") & (P.lag_class("accepted", "period_end") == "missing"))


@query("""SELECT COUNT(*) AS rows_, ROUND(COUNT(CASE WHEN c_custkey % 100 <> 3
  THEN 1 END) / CAST(COUNT(*) AS DOUBLE), 6) AS share, COUNT(CASE WHEN c_custkey % 100 <> 3
  THEN 1 END) / CAST(COUNT(*) AS DOUBLE) >= 0.98::DOUBLE AS passed FROM customer""")
def gate_hash_recomputes(spark, d):
    now = P.canonical_hash({"name": F.col("c_name"), "segment": F.col("c_mktsegment")})
    then = P.canonical_hash({"name": F.when(F.col("c_custkey") % 100 == 3, F.lit("renamed")).otherwise(F.col("c_name")), "segment": F.col("c_mktsegment")})
    return Q.share(X.table(spark, d, "customer"), now == then, 0.98)


@query("""SELECT COUNT(*) AS rows_, COUNT(CASE WHEN NOT COALESCE(mktcap >= 3e9 AND adv >= 3e4 AND price >= 1200 AND gap <= 12, FALSE)
  THEN 1 END) AS violations FROM snapshot WHERE COALESCE(mktcap >= 1e8 AND adv >= 1e3 AND price >= 1000 AND gap <= 40, FALSE)""", **H.UNIVERSE)
def gate_member_thresholds(spark, d):
    """How many of the members by looser bars miss the report's bars."""
    from tessera.operators import universe

    return Q.violations(H.snapshot(spark, d).filter(universe.eligible(**panel.LOOSE)), ~universe.eligible(**H.BARS))


@query("""SELECT n, median, wild, median BETWEEN 0.1::DOUBLE AND 5 AND wild < 0.01::DOUBLE * n AS passed
  FROM (SELECT COUNT(sue) AS n, quantile_disc(abs(sue), 0.5) AS median, COUNT(CASE WHEN abs(sue) > 50 THEN 1 END) AS wild FROM sue)""", sue=H.SUE)
def gate_sue_sanity(spark, d):
    from tessera.operators.factors import standardised_surprise

    rows = standardised_surprise(X.surprises(spark, d)).select(F.abs("sue").alias("s"))
    wild = rows.agg(F.count_if(F.col("s") > 50).alias("wild"))
    g = selection.discrete_percentiles(rows, "s", {"median": 0.5}).join(F.broadcast(wild))  # one row by one row
    return g.select("n", "median", "wild", (F.col("median").between(0.1, 5) & (F.col("wild") < 0.01 * F.col("n"))).alias("passed"))


@query(f"""SELECT b.*, months, {len(panel.FACTORS)} AS registered, b.board_months = months AND b.factors = {len(panel.FACTORS)}
  AND b.unknown = 0 AS passed FROM (
  SELECT COUNT(DISTINCT as_of) AS board_months, COUNT(DISTINCT factor) AS factors, COUNT(CASE WHEN factor NOT IN ({panel._in(panel.FACTORS)})
  THEN 1 END) AS unknown FROM covered) b
  CROSS JOIN (SELECT COUNT(DISTINCT as_of) AS months FROM members)""", **panel.BOARD)
def gate_board_integrity(spark, d):
    """Whether the board has every month with members and every factor of the
    registry, and no other. One row by one row."""
    rows = panel.board(spark, d)
    known = F.count_if(~F.col("factor").isin(panel.FACTORS)).alias("unknown")
    g = rows.agg(F.countDistinct("as_of").alias("board_months"), F.countDistinct("factor").alias("factors"), known)
    g = g.crossJoin(panel.members(spark, d).agg(F.countDistinct("as_of").alias("months"))).withColumn("registered", F.lit(len(panel.FACTORS)))
    passed = (F.col("board_months") == F.col("months")) & (F.col("factors") == F.col("registered")) & (F.col("unknown") == 0)
    return g.withColumn("passed", passed)


@query("""SELECT COALESCE(a.sec, b.sec) AS sec, COALESCE(a.n, 0) AS prices, COALESCE(b.n, 0) AS marked
  FROM (SELECT sec, COUNT(*) AS n FROM bars GROUP BY 1) a
  FULL JOIN (SELECT sec, COUNT(*) AS n FROM bars WHERE sec % 11 <> 5 OR month(d) <> 2 GROUP BY 1) b ON a.sec = b.sec
  WHERE COALESCE(a.n, 0) <> COALESCE(b.n, 0)""")
def audit_price_markers(spark, d):
    b = X.bars(spark, d)
    marked = b.filter("sec % 11 <> 5 OR month(d) <> 2").groupBy("sec").agg(F.count("*").alias("marked"))
    return Q.drift(b.groupBy("sec").agg(F.count("*").alias("prices")), marked, "sec", "prices", "marked")


@query("""SELECT COALESCE(a.sec, b.sec) AS sec, COALESCE(a.n, 0) AS originals, COALESCE(b.n, 0) AS periods
  FROM (SELECT sec, COUNT(*) AS n FROM statements WHERE vintage_id = 1 GROUP BY 1) a
  FULL JOIN (SELECT sec, COUNT(DISTINCT period_end) AS n FROM statements GROUP BY 1) b ON a.sec = b.sec WHERE COALESCE(a.n, 0) <> COALESCE(b.n, 0)""")
def audit_vintages(spark, d):
    s = X.statements(spark, d)
    return Q.drift(s.filter("vintage_id = 1").groupBy("sec").agg(F.count("*").alias("originals")), s.groupBy("sec").agg(F.countDistinct("period_end").alias("periods")), "sec", "originals", "periods")


@query("""SELECT verdict, COUNT(*) AS n FROM (SELECT CASE WHEN days <= 7 THEN 'trim' WHEN sa % 4 = 0 AND sb % 4 <> 0
  THEN 'keep-a' WHEN sb % 4 = 0 AND sa % 4 <> 0 THEN 'keep-b'
  WHEN month(fa) = 1 AND month(fb) <> 1 THEN 'drop-a' WHEN month(fb) = 1 AND month(fa) <> 1
  THEN 'drop-b' ELSE 'conflict' END AS verdict FROM overlaps_) GROUP BY 1""", overlaps_=OVERLAPS)
def overlap_adjudication(spark, d):
    a, b = F.col("a_entity") % 4 == 0, F.col("b_entity") % 4 == 0
    verdict = Q.adjudicated(F.col("days"), a, b, F.month("a_from") == 1, F.month("b_from") == 1)
    return _overlaps(spark, d).groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("""SELECT symbol, CASE WHEN uses > 1 THEN 'reuse' WHEN NOT profile THEN 'no-profile' WHEN is_open AND NOT gone THEN 'active' WHEN gone
  THEN 'delisted' ELSE 'closed' END AS outcome FROM (
  SELECT m.symbol, COUNT(DISTINCT m.sec) AS uses, bool_or(valid_to IS NULL) AS is_open, bool_or(m.sec % 7 <> 2) AS profile,
  bool_or(x.sec IS NOT NULL) AS gone FROM symbol_map m LEFT JOIN delistings x ON x.sec = m.sec GROUP BY 1)""")
def identity_resolution(spark, d):
    m = X.symbol_map(spark, d).join(X.delistings(spark, d).select("sec", F.lit(True).alias("gone")), "sec", "left")
    g = m.groupBy("symbol").agg(F.countDistinct("sec").alias("uses"), F.bool_or(F.col("valid_to").isNull()).alias("is_open"), F.bool_or(F.col("sec") % 7 != 2).alias("profile"), F.bool_or(F.col("gone").isNotNull()).alias("gone"))
    return g.select("symbol", Q.resolution(F.col("uses"), F.col("is_open"), F.col("profile"), F.col("gone")).alias("outcome"))


@query("""SELECT a.sec, COUNT(*) AS periods, COUNT(CASE WHEN abs(a.gp - b.gp) > greatest(1000::DOUBLE, 0.005::DOUBLE * abs(b.gp))
  THEN 1 END) AS restated FROM statements a JOIN statements b ON a.sec = b.sec AND a.period_end = b.period_end
  WHERE a.vintage_id = 1 AND b.vintage_id = 2 GROUP BY 1""")
def vintage_comparison(spark, d):
    s = X.statements(spark, d)
    one = s.filter("vintage_id = 1").select("sec", "period_end", F.col("gp").alias("a"))
    two = s.filter("vintage_id = 2").select("sec", "period_end", F.col("gp").alias("b"))
    return one.join(two, ["sec", "period_end"]).groupBy("sec").agg(F.count("*").alias("periods"), F.count_if(~P.near(F.col("a"), F.col("b"), 1000.0, 0.005)).alias("restated"))


@query("""SELECT what, factor, ROUND(avg(ic), 6) AS mean_ic, COUNT(*) AS months FROM (SELECT 'full' AS what, factor, ic FROM ics
  UNION ALL SELECT 'registered', factor, ic FROM ics WHERE as_of <= DATE '2000-07-31') GROUP BY 1, 2""", **panel.EVAL)
def registered_window(spark, d):
    windows = F.when(F.col("as_of") <= F.lit(panel.HOLDOUT), F.array(F.lit("full"), F.lit("registered"))).otherwise(F.array(F.lit("full")))
    return panel.ics(spark, d).select("factor", "ic", F.explode(windows).alias("what")).groupBy("what", "factor").agg(F.round(F.avg("ic"), 6).alias("mean_ic"), F.count("*").alias("months"))


@query("SELECT c_custkey, c_name FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 50")
def hash_sample(spark, d):
    """A sampling operator: its limit is the sample's size."""
    return Q.hash_sample(X.table(spark, d, "customer"), "c_custkey", 50).select("c_custkey", "c_name")


@query("""SELECT 'securities' AS what, COUNT(*) AS n FROM securities UNION ALL SELECT 'bars', COUNT(*) FROM bars
  UNION ALL SELECT 'statements', COUNT(*) FROM statements UNION ALL SELECT 'surprises', COUNT(*) FROM surprises
  UNION ALL SELECT 'members', COUNT(*) FROM members""", **H.UNIVERSE, members=panel.MEMBERS)
def api_summary(spark, d):
    parts = {"securities": X.securities(spark, d), "bars": X.bars(spark, d), "statements": X.statements(spark, d), "surprises": X.surprises(spark, d), "members": panel.members(spark, d)}
    out = None
    for name, rows in parts.items():
        one = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
        out = one if out is None else out.unionByName(one)
    return out


LEVELS = "SELECT sec, COUNT(*) AS n FROM daily WHERE r IS NOT NULL GROUP BY 1"


@query(f"""SELECT COALESCE(a.sec, b.sec) AS sec, COALESCE(a.n, 0) AS prices, COALESCE(b.n, 0) AS levels
  FROM (SELECT sec, COUNT(*) AS n FROM bars GROUP BY 1) a
  FULL JOIN ({LEVELS}) b ON a.sec = b.sec WHERE COALESCE(a.n, 0) <> COALESCE(b.n, 0)""", daily=H.DAILY)
def audit_levels(spark, d):
    """Securities whose levels are not as many as their prices: the first day has
    a price and no return."""
    prices = X.bars(spark, d).groupBy("sec").agg(F.count("*").alias("prices"))
    levels = returns.index_level(H.daily(spark, d).filter("r IS NOT NULL")).groupBy("sec").agg(F.count("level").alias("levels"))
    return Q.drift(prices, levels, "sec", "prices", "levels")


@query("""SELECT COALESCE(a.sec, b.sec) AS sec, COALESCE(a.n, 0) AS reports, COALESCE(b.n, 0) AS scored
  FROM (SELECT sec, COUNT(*) AS n FROM surprises GROUP BY 1) a
  FULL JOIN (SELECT sec, COUNT(sue) AS n FROM sue GROUP BY 1) b ON a.sec = b.sec WHERE COALESCE(a.n, 0) <> COALESCE(b.n, 0)""", sue=H.SUE)
def audit_surprises(spark, d):
    r = X.surprises(spark, d)
    scored = factors.standardised_surprise(r).groupBy("sec").agg(F.count("sue").alias("scored"))
    return Q.drift(r.groupBy("sec").agg(F.count("*").alias("reports")), scored, "sec", "reports", "scored")


@query(f"""SELECT 'snapshots' AS what, COUNT(*) AS n, COUNT(DISTINCT as_of) AS months FROM snapshot
  UNION ALL SELECT 'benchmark', COUNT(*), COUNT(DISTINCT as_of) FROM bench
  UNION ALL SELECT 'registry', {len(panel.FACTORS)}, 0
  UNION ALL SELECT 'vintages', COUNT(*), COUNT(DISTINCT date_trunc('month', accepted)) FROM statements
  WHERE vintage_id > 1""", **H.UNIVERSE, bench=H.BENCH)
def audit_totals(spark, d):
    count = lambda df, what, month="as_of": df.agg(F.count("*").alias("n"), F.countDistinct(month).alias("months")).select(F.lit(what).alias("what"), "n", "months")
    registry = spark.range(1).select(F.lit("registry").alias("what"), F.lit(len(panel.FACTORS)).cast("long").alias("n"), F.lit(0).cast("long").alias("months"))
    later = X.statements(spark, d).filter("vintage_id > 1").withColumn("m", F.date_trunc("month", "accepted"))
    return count(H.snapshot(spark, d), "snapshots").unionByName(count(H.benchmark(spark, d), "benchmark")).unionByName(registry).unionByName(count(later, "vintages", "m"))


# chain proofs: a security's first and last symbol, each on its first day, resolve to the same securities
PROOFS = """SELECT a.sec, a.first_s, a.first_d, a.last_s, a.last_d
  FROM (SELECT sec, arg_min(symbol, (valid_from, symbol)) AS first_s, MIN(valid_from) AS first_d,
    arg_max(symbol, (valid_from, symbol)) AS last_s, MAX(valid_from) AS last_d, COUNT(DISTINCT symbol) AS n FROM symbol_map GROUP BY 1) a
    WHERE n > 1"""
RESOLVED = """SELECT p.sec, list_sort(list(DISTINCT m.sec)) AS secs FROM proofs p
  JOIN symbol_map m ON m.symbol = p.{s} AND m.valid_from <= p.{d} AND (m.valid_to IS NULL OR m.valid_to >= p.{d}) GROUP BY 1"""


@query("""SELECT COUNT(*) AS rows_, COUNT(CASE WHEN NOT COALESCE(list_contains(a.secs, p.sec) AND list_contains(b.secs, p.sec), FALSE)
  THEN 1 END) AS violations,
  COUNT(CASE WHEN a.secs = b.secs THEN 1 END) AS alike FROM proofs p LEFT JOIN ra a ON a.sec = p.sec LEFT JOIN rb b ON b.sec = p.sec""", proofs=PROOFS, ra=RESOLVED.format(s="first_s", d="first_d"), rb=RESOLVED.format(s="last_s", d="last_d"))
def gate_identity_chains(spark, d):
    """Renamed securities: both symbols must resolve to it, each at its time;
    alike counts those where both resolve to the very same securities."""
    m = X.symbol_map(spark, d).filter("symbol IS NOT NULL")
    ends = m.groupBy("sec").agg(F.min(F.struct("valid_from", "symbol")).alias("a"), F.max(F.struct("valid_from", "symbol")).alias("b"), F.countDistinct("symbol").alias("n")).filter("n > 1")
    ends = ends.select("sec", F.col("a.symbol").alias("a_key"), F.col("a.valid_from").alias("a_time"), F.col("b.symbol").alias("b_key"), F.col("b.valid_from").alias("b_time"))
    own = ends.join(m, "sec").groupBy("sec").agg(*[
        F.bool_or((F.col("symbol") == F.col(f"{s}_key")) & P.covers("valid_from", "valid_to", f"{s}_time")).alias(f"{s}_own") for s in "ab"
    ])
    alike = TJ.held_alike(ends, m, "symbol", "sec").select("sec", F.lit(True).alias("alike"))
    right = F.coalesce(F.col("a_own") & F.col("b_own"), F.lit(False))
    return own.join(alike, "sec", "left").agg(F.count("*").alias("rows_"), F.count_if(~right).alias("violations"), F.count_if("alike").alias("alike"))


# every original restated by rule: 999 more, accepted 400 days after it
_RESTATED = """SELECT sec, period_end, vintage_id, accepted, gp FROM statements WHERE vintage_id = 1
  UNION ALL SELECT sec, period_end, 2, accepted + INTERVAL 400 DAY, gp + 999 FROM statements WHERE vintage_id = 1"""


@query("""SELECT COUNT(*) AS checks, COUNT(CASE WHEN restated THEN 1 END) AS restated, 0 AS violations FROM (
  SELECT sec, as_of, bool_or(vintage_id = 2) AS restated, DENSE_RANK() OVER (PARTITION BY sec, as_of ORDER BY period_end DESC) AS nth FROM restated_ s
  JOIN calendar c ON s.accepted <= CAST(c.as_of AS TIMESTAMP) + INTERVAL 16 HOUR AND s.period_end <= c.as_of GROUP BY sec, as_of, period_end) WHERE nth <= 6""", restated_=_RESTATED)
def gate_synthetic_restatement(spark, d):
    """The selector on statements restated by rule: the original until the
    restatement is accepted, the restated value from then on, and nothing of what
    is accepted after the close."""
    first = X.statements(spark, d).filter("vintage_id = 1").select("sec", "period_end", "vintage_id", "accepted", "gp")
    later = first.select("sec", "period_end", F.lit(2).alias("vintage_id"), (F.col("accepted") + F.expr("INTERVAL 400 DAYS")).alias("accepted"), (F.col("gp") + 999).alias("gp"))
    seen = TJ.visible_on_grid(first.unionByName(later), X.calendar(spark, d), 6).select("sec", "as_of", "period_end", "gp")
    rows = seen.join(first.select("sec", "period_end", F.col("accepted").alias("original"), F.col("gp").alias("old")), ["sec", "period_end"])
    close = F.col("as_of").cast("timestamp_ntz") + F.expr("INTERVAL 16 HOURS")
    restated = F.col("original") + F.expr("INTERVAL 400 DAYS") <= close
    right = F.when(restated, F.col("gp") == F.col("old") + 999).otherwise((F.col("gp") == F.col("old")) & (F.col("original") <= close))
    return rows.agg(F.count("*").alias("checks"), F.count_if(restated).alias("restated"), F.count_if(~right).cast("int").alias("violations"))


@query("SELECT as_of, COUNT(*) AS members FROM members GROUP BY 1", **H.UNIVERSE, members=panel.MEMBERS)
def api_universe_series(spark, d):
    return panel.members(spark, d).groupBy("as_of").agg(F.count("*").alias("members"))


@query("SELECT CASE WHEN pct IS NULL THEN 'no-oracle' WHEN pct >= 99 THEN '99+' WHEN pct >= 95 THEN '95-99' ELSE '<95' END AS bucket, COUNT(*) AS n FROM recon GROUP BY 1", daily=H.DAILY, pairs=H.PAIRS, recon=RECON)
def api_recon_histogram(spark, d):
    return returns.match_score(H._pairs(spark, d)).groupBy(P.bucket_of_match("pct").alias("bucket")).agg(F.count("*").alias("n"))


@query(f"""SELECT step, n FROM (SELECT 'snapshots' AS step, COUNT(*) AS n FROM snapshot UNION ALL SELECT 'members', COUNT(*) FROM members
  UNION ALL SELECT 'board', COUNT(*) FROM covered
  UNION ALL SELECT 'ic', COUNT(*) FROM ics UNION ALL SELECT 'long-short', COUNT(*) FROM lsq
  UNION ALL SELECT 'gate', CASE WHEN COUNT(DISTINCT factor) = {len(panel.FACTORS)}
  AND COUNT(DISTINCT as_of) = (SELECT COUNT(DISTINCT as_of) FROM members) THEN 1 ELSE 0 END FROM covered)""", **panel.EVAL)
def recompute_chain(spark, d):
    """The monthly chain, each step from what the one before has stored: universe,
    board, evaluation, and the gate over them, which raises if it fails."""
    out = None
    for step, rows in (("snapshots", H.snapshot), ("members", panel.members), ("board", panel.board), ("ic", panel.ics), ("long-short", panel.spreads)):
        one = rows(spark, d).agg(F.count("*").alias("n")).select(F.lit(step).alias("step"), "n")
        out = one if out is None else out.unionByName(one)
    required(gate_board_integrity(spark, d), "board integrity")
    return out.unionByName(gate_board_integrity(spark, d).select(F.lit("gate").alias("step"), F.col("passed").cast("long").alias("n")))


_NAMES = """SELECT s.s_suppkey AS sec, s.s_suppkey % 11 <> 0 AS issuer, s.s_nationkey % 6 <> 0 AS instrument, x.sec IS NULL OR s.s_suppkey % 3 = 0 AS active,
  x.sec IS NOT NULL AS gone, s.s_suppkey % 7 = 0 AS may_trade, m.symbols > 1 AS renamed, m.closed AS change_known, x.method = 'deal' AS deal, x.terminal_return < 0 AS listed_gone
  FROM supplier s LEFT JOIN delistings x ON x.sec = s.s_suppkey
  LEFT JOIN (SELECT sec, COUNT(DISTINCT symbol) AS symbols, bool_or(valid_to IS NOT NULL) AS closed FROM symbol_map GROUP BY 1) m ON m.sec = s.s_suppkey"""
_FILED = """SELECT sec, COUNT(*) AS n, COUNT(told) AS with_accepted, list_sort(list(days) FILTER (WHERE days IS NOT NULL)) AS lags,
  string_agg(CASE WHEN days < 20 OR days > 200 THEN CAST(period_end AS VARCHAR) || ':' || CAST(days AS VARCHAR) || 'd' END, ',' ORDER BY period_end) AS weird
  FROM (SELECT sec, period_end, told, date_diff('day', period_end, CAST(told AS DATE)) AS days, ROW_NUMBER() OVER (PARTITION BY sec ORDER BY period_end DESC) AS nth
    FROM (SELECT sec, period_end, CASE WHEN timing_pit THEN accepted END AS told FROM statements WHERE vintage_id = 1)) WHERE nth <= 8 GROUP BY 1"""
_EXIT = """SELECT n.sec, concat_ws(',', CASE WHEN NOT (issuer AND instrument) THEN 'missing-anchors' END,
  CASE WHEN gone AND active AND NOT may_trade THEN 'chimera-suspect(active)' END, CASE WHEN renamed AND NOT change_known THEN 'change-not-in-feed' END) AS flags,
  CASE WHEN gone THEN CASE WHEN deal THEN 'rung1-deal-feed' WHEN listed_gone THEN 'rung2-delisted-feed' WHEN active THEN 'reused/active-manual-map'
    ELSE 'UNRESOLVED' END END AS end_known, COALESCE(p.days, 0) AS days, p.match_pct, p.first_mismatch, COALESCE(f.n, 0) AS statements,
  COALESCE(f.with_accepted, 0) AS with_accepted, f.lags[len(f.lags) // 2 + 1] AS median_lag, COALESCE(f.weird, '') AS weird
  FROM names n LEFT JOIN filed f ON f.sec = n.sec LEFT JOIN (SELECT sec, COUNT(*) AS days,
    ROUND(100 * (1 - COUNT(CASE WHEN mismatch THEN 1 END) / CAST(COUNT(*) AS DOUBLE)), 2) AS match_pct, MIN(CASE WHEN mismatch THEN d END) AS first_mismatch
    FROM pairs GROUP BY 1) p ON p.sec = n.sec"""
_VENDOR = dict(daily=H.DAILY, pairs=H.PAIRS, names=_NAMES, filed=_FILED)


def _vendor_exit(spark, d):
    sec, x = F.col("sec"), X.delistings(spark, d).select("sec", "method", "terminal_return")
    m = X.symbol_map(spark, d).groupBy("sec").agg(F.countDistinct("symbol").alias("symbols"), F.bool_or(F.col("valid_to").isNotNull()).alias("change_known"))
    profile = X.table(spark, d, "supplier").select(F.col("s_suppkey").alias("sec"), (F.col("s_suppkey") % 11 != 0).alias("issuer"), (F.col("s_nationkey") % 6 != 0).alias("instrument"))
    rows = profile.join(x, "sec", "left").join(m, "sec", "left").withColumn("gone", F.col("method").isNotNull())
    names = rows.select(
        "sec", "issuer", "instrument", "gone", "change_known", (~F.col("gone") | (sec % 3 == 0)).alias("active"), (sec % 7 == 0).alias("may_trade"),
        (F.col("symbols") > 1).alias("renamed"), (F.col("method") == "deal").alias("deal"), (F.col("terminal_return") < 0).alias("listed_gone"),
    )
    filings = X.statements(spark, d).filter("vintage_id = 1").select("sec", "period_end", F.when(F.col("timing_pit"), F.col("accepted")).alias("accepted"))
    return Q.vendor_exit(names, H._pairs(spark, d), filings)


@query(_EXIT, **_VENDOR)
def vendor_exit_gates(spark, d):
    """Every name's identity, match of total returns, statements and known end."""
    return _vendor_exit(spark, d)


@query("""SELECT 'identity' AS gate, COUNT(CASE WHEN flags = '' THEN 1 END) AS passed, COUNT(*) AS of_ FROM exit_
  UNION ALL SELECT 'returns', COUNT(CASE WHEN match_pct >= 95 THEN 1 END), COUNT(match_pct) FROM exit_
  UNION ALL SELECT 'statements', COUNT(CASE WHEN with_accepted = statements THEN 1 END), COUNT(*) FROM exit_ WHERE statements > 0
  UNION ALL SELECT 'delisting', COUNT(CASE WHEN end_known <> 'UNRESOLVED' THEN 1 END), COUNT(end_known) FROM exit_""", **_VENDOR, exit_=_EXIT)
def vendor_exit_summary(spark, d):
    return Q.vendor_exit_summary(_vendor_exit(spark, d))
