"""Queries over as-of, bitemporal and interval joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import temporal as T
from tessera.plans.registry import query
from tessera.sources import fixtures as X
from tessera.sources.stored import stored


@query("""SELECT t.sec, t.report_date, b.d AS found_at, b.close AS price FROM (SELECT sec % 100 AS sec, report_date FROM surprises
  GROUP BY 1, 2) t ASOF LEFT JOIN bars b ON t.sec = b.sec AND t.report_date >= b.d""")
def asof_price(spark, d):
    left = X.surprises(spark, d).select((F.col("sec") % 100).alias("sec"), "report_date").distinct()
    return T.asof_backward(left, X.bars(spark, d), "sec", "report_date", "d", ["close"]).select("sec", "report_date", "found_at", F.col("close").alias("price"))


SUE = """SELECT sec, report_date, diff, CASE WHEN n >= 4 AND sd > 1e-9::DOUBLE THEN ROUND(diff / sd, 4) END AS sue FROM (
  SELECT sec, report_date, diff, COUNT(diff) OVER w AS n, stddev_pop(diff) OVER w AS sd
  FROM (SELECT sec, report_date, actual - estimate AS diff FROM surprises WHERE estimate IS NOT NULL)
  WINDOW w AS (PARTITION BY sec ORDER BY report_date ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING))"""


@query("""SELECT s.sec, c.as_of, CASE WHEN date_diff('day', r.report_date, c.as_of) <= 40 THEN r.sue END AS sue
  FROM (SELECT DISTINCT sec FROM surprises) s CROSS JOIN calendar c ASOF LEFT JOIN sue r ON s.sec = r.sec AND c.as_of >= r.report_date""", sue=SUE)
def sue_asof_bounded(spark, d):
    from tessera.operators.factors import standardised_surprise

    reports = X.surprises(spark, d)
    asofs = [r.as_of for r in X.calendar(spark, d).select("as_of").orderBy("as_of").collect()]  # a row a month
    left = reports.select("sec").distinct().select("sec", F.explode(F.array(*[F.lit(a) for a in asofs])).alias("as_of"))
    out = T.asof_backward(left, standardised_surprise(reports).select("sec", "report_date", "sue"), "sec", "as_of", "report_date", ["sue"], max_age_days=40)
    return out.select("sec", "as_of", "sue")


@query("""SELECT as_of, b.d AS bench_d, b.tr AS tr FROM calendar ASOF LEFT JOIN (SELECT d, SUM(volume) AS tr FROM bars
  WHERE dayofweek(d) = 3 GROUP BY d) b ON as_of >= b.d""")
def asof_benchmark_grid(spark, d):
    bench = X.bars(spark, d).filter("dayofweek(d) = 4").groupBy("d").agg(F.sum("volume").alias("tr")).withColumn("k", F.lit(1))
    grid = X.calendar(spark, d).select("as_of", F.lit(1).alias("k"))
    return T.asof_backward(grid, bench, "k", "as_of", "d", ["tr"]).select("as_of", F.col("found_at").alias("bench_d"), "tr")


VISIBLE = """SELECT *, ROW_NUMBER() OVER (PARTITION BY sec, as_of ORDER BY period_end DESC) AS nth FROM (
  SELECT s.*, c.as_of, ROW_NUMBER() OVER (PARTITION BY s.sec, c.as_of, s.period_end ORDER BY s.vintage_id DESC) AS vn
  FROM statements s JOIN calendar c ON s.accepted <= CAST(c.as_of AS TIMESTAMP) + INTERVAL 16 HOUR AND s.period_end <= c.as_of
  WHERE s.timing_pit) WHERE vn = 1"""


@stored("sec")
def visible(spark, d):
    """The last six periods known at each month end, with the values known then."""
    return T.visible_on_grid(X.statements(spark, d).filter("timing_pit"), X.calendar(spark, d), 6)


@query("SELECT sec, as_of, period_end, vintage_id, accepted, nth, gp FROM visible_ WHERE nth <= 6", visible_=VISIBLE)
def pit_visible(spark, d):
    return visible(spark, d).select("sec", "as_of", "period_end", "vintage_id", "accepted", F.col("nth").cast("long").alias("nth"), "gp")


@query("""SELECT o.o_orderkey, s.symbol, m.sec AS found FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS t, o_custkey % 200 AS k FROM orders) o
  JOIN (SELECT DISTINCT symbol FROM symbol_map) s ON s.symbol = 'SYM' || CAST(o.k AS VARCHAR)
  LEFT JOIN (SELECT o_orderkey AS k, arg_max(sec, (valid_from, sec)) AS sec
  FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS t, 'SYM' || CAST(o_custkey % 200 AS VARCHAR) AS symbol FROM orders) q
    JOIN symbol_map USING (symbol) WHERE valid_from <= t AND (valid_to IS NULL OR valid_to >= t) GROUP BY 1) m ON m.k = o.o_orderkey""")
def symbol_resolution(spark, d):
    left = X.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("t"), F.concat(F.lit("SYM"), (F.col("o_custkey") % 200).cast("string")).alias("symbol"))
    m = X.symbol_map(spark, d)
    known = left.join(m.select("symbol").distinct(), "symbol")
    hits = T.resolve(known.select("symbol", "t").distinct(), m, "symbol", "t", "sec").withColumnRenamed("sec", "found")
    return known.join(hits, ["symbol", "t"]).select("o_orderkey", "symbol", "found")


@query("""SELECT a.symbol, a.sec AS a_entity, b.sec AS b_entity, a.valid_from AS a_from, b.valid_from AS b_from FROM symbol_map a
  JOIN symbol_map b ON a.symbol = b.symbol AND a.sec < b.sec
  AND a.valid_from <= COALESCE(b.valid_to, DATE '9999-12-31') AND b.valid_from <= COALESCE(a.valid_to, DATE '9999-12-31')""")
def interval_overlap(spark, d):
    return T.overlaps(X.symbol_map(spark, d), "symbol", "sec").select("symbol", "a_entity", "b_entity", "a_from", "b_from")


@query("""SELECT a.symbol, a.e AS entity, a.valid_from AS a_from, b.valid_from AS b_from, COUNT(*) AS n
  FROM (SELECT *, sec % 7 AS e FROM symbol_map) a
  JOIN (SELECT *, sec % 7 AS e FROM symbol_map) b ON a.symbol = b.symbol AND a.e = b.e AND a.valid_from < b.valid_from
  AND a.valid_from <= COALESCE(b.valid_to, DATE '9999-12-31') AND b.valid_from <= COALESCE(a.valid_to, DATE '9999-12-31') GROUP BY ALL""")
def interval_overlap_same_entity(spark, d):
    m = X.symbol_map(spark, d).withColumn("e", F.col("sec") % 7)
    return T.overlaps(m, "symbol", "e", across=False).groupBy("symbol", F.col("a_entity").alias("entity"), "a_from", "b_from").agg(F.count("*").alias("n"))


MERGED = """SELECT symbol, MIN(valid_from) AS valid_from, NULLIF(MAX(e), DATE '9999-12-31') AS valid_to, COUNT(*) AS n FROM (
  SELECT *, SUM(CASE WHEN reach >= valid_from THEN 0 ELSE 1 END) OVER (PARTITION BY symbol
  ORDER BY valid_from, e, sec ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT symbol, sec, valid_from, COALESCE(valid_to, DATE '9999-12-31') AS e, MAX(COALESCE(valid_to,
    DATE '9999-12-31')) OVER (PARTITION BY symbol
    ORDER BY valid_from, COALESCE(valid_to, DATE '9999-12-31'), sec ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM symbol_map))
  GROUP BY symbol, island"""


@query(MERGED)
def interval_merge(spark, d):
    return T.merged(X.symbol_map(spark, d), ["symbol"])


@query("""SELECT DISTINCT symbol, valid_from, valid_to FROM symbol_map a WHERE NOT EXISTS (SELECT 1 FROM symbol_map b
  WHERE a.symbol = b.symbol AND b.valid_from <= a.valid_from
  AND COALESCE(b.valid_to, DATE '9999-12-31') >= COALESCE(a.valid_to, DATE '9999-12-31') AND (b.valid_from <> a.valid_from OR COALESCE(b.valid_to, DATE '9999-12-31') <> COALESCE(a.valid_to, DATE '9999-12-31')))""")
def interval_containment(spark, d):
    return T.uncontained(X.symbol_map(spark, d), ["symbol"]).select("symbol", "valid_from", "valid_to")


# chains over part keys: most lead 97 further; multiples of 97 end in a cycle of ten
EDGES = """SELECT p_partkey AS old, CASE WHEN p_partkey % 97 <> 0 THEN p_partkey + 97 WHEN p_partkey < 970
  THEN p_partkey + 97 ELSE 97 END AS new FROM part"""


@query("""SELECT start, CASE WHEN steps <= (SELECT COUNT(*) FROM edges) THEN last END AS last, CASE WHEN steps <= (SELECT COUNT(*) FROM edges)
  THEN steps END AS steps FROM (SELECT start, arg_max(last, steps) AS last, MAX(steps) AS steps FROM (
  WITH RECURSIVE walk(start, last, steps) AS (SELECT old, new, CAST(1 AS BIGINT) FROM edges UNION ALL SELECT start, new, steps + 1 FROM walk
  JOIN edges ON old = last WHERE steps <= (SELECT COUNT(*) FROM edges)) SELECT * FROM walk) GROUP BY 1)""", edges=EDGES)
def rename_chain(spark, d):
    k = F.col("p_partkey")
    new = F.when(k % 97 != 0, k + 97).when(k < 970, k + 97).otherwise(97)
    return T.rename_chain(X.table(spark, d, "part").select(k.alias("old"), new.alias("new")))


@query("""SELECT sec, a, b FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sec, a ORDER BY abs(date_diff('day', b, a)), b) AS n FROM (
  SELECT x.sec, x.report_date AS a, y.period_end AS b FROM (SELECT DISTINCT sec % 100 AS sec, report_date FROM surprises) x
  JOIN (SELECT DISTINCT sec, period_end FROM statements) y ON x.sec = y.sec AND abs(date_diff('day', y.period_end, x.report_date)) <= 6))
  WHERE n = 1""")
def fuzzy_period_match(spark, d):
    left = X.surprises(spark, d).select((F.col("sec") % 100).alias("sec"), F.col("report_date").alias("a")).distinct()
    right = X.statements(spark, d).select("sec", F.col("period_end").alias("b")).distinct()
    return T.fuzzy_match(left, right, ["sec"], "a", "b", 6).select("sec", "a", "b")


@query("""SELECT i.sec, i.period_end, i.ebit, b.assets, c.cfo FROM (SELECT sec, period_end, ebit FROM statements WHERE vintage_id = 2) i LEFT
  JOIN (SELECT sec, period_end, assets FROM statements WHERE vintage_id = 1 AND sec % 3 <> 0) b USING (sec, period_end)
  LEFT JOIN (SELECT sec, period_end, cfo FROM statements WHERE vintage_id = 2 AND month(period_end) <> 12) c USING (sec, period_end)
  WHERE period_end >= DATE '1996-06-01'""")
def three_way_period_merge(spark, d):
    s = X.statements(spark, d).filter("period_end >= DATE'1996-06-01'")
    key = ["sec", "period_end"]
    i = s.filter("vintage_id = 2").select(*key, "ebit")
    b = s.filter("vintage_id = 1 AND sec % 3 <> 0").select(*key, "assets")
    c = s.filter("vintage_id = 2 AND month(period_end) <> 12").select(*key, "cfo")
    return i.join(b, key, "left").join(c, key, "left")


@query("""SELECT a.sec, COUNT(*) AS pairs, bool_or(e.x IS NOT NULL) AS linked FROM symbol_map a
  JOIN symbol_map b ON a.sec = b.sec AND a.symbol < b.symbol
  LEFT JOIN (SELECT 'SYM' || CAST(p_partkey % 200 AS VARCHAR) AS x,
  'SYM' || CAST(p_size % 200 AS VARCHAR) AS y FROM part UNION SELECT 'SYM' || CAST(p_size % 200 AS VARCHAR),
  'SYM' || CAST(p_partkey % 200 AS VARCHAR) FROM part) e ON e.x = a.symbol AND e.y = b.symbol GROUP BY 1""")
def linked_symbol_pairs(spark, d):
    sym = lambda c: F.concat(F.lit("SYM"), (F.col(c) % 200).cast("string"))
    e = X.table(spark, d, "part").select(sym("p_partkey").alias("x"), sym("p_size").alias("y"))
    edges = e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
    m = X.symbol_map(spark, d).select("sec", "symbol")
    pairs = m.alias("a").join(m.alias("b"), "sec").filter("a.symbol < b.symbol").select("sec", F.col("a.symbol").alias("x"), F.col("b.symbol").alias("y"))
    return pairs.join(edges.withColumn("hit", F.lit(True)), ["x", "y"], "left").groupBy("sec").agg(F.count("*").alias("pairs"), F.bool_or(F.col("hit").isNotNull()).alias("linked"))


@query("""SELECT s.sec, arg_max(m.symbol, (m.valid_from, m.symbol)) AS symbol, COUNT(*) AS uses FROM securities s
  JOIN symbol_map m ON m.sec = s.sec GROUP BY 1""")
def current_symbol(spark, d):
    m = X.symbol_map(spark, d).join(X.securities(spark, d).select("sec"), "sec")
    return m.groupBy("sec").agg(F.max(F.struct("valid_from", "symbol"))["symbol"].alias("symbol"), F.count("*").alias("uses"))


@query("""SELECT delist.sec, b.close AS last_price, a.close AS acquirer_price, ROUND((0.5 * b.close + 0.25::DOUBLE * a.close) / b.close - 1,
  4) AS terminal FROM delistings delist
  ASOF JOIN bars b ON b.sec = delist.sec AND delist.delist_date >= b.d ASOF
  JOIN (SELECT sec + 1 AS k, d, close FROM bars) a ON a.k = delist.sec AND delist.delist_date >= a.d""")
def merger_terminal_return(spark, d):
    b = X.bars(spark, d)
    own = T.asof_backward(X.delistings(spark, d).select("sec", "delist_date"), b, "sec", "delist_date", "d", ["close"]).select("sec", "delist_date", F.col("close").alias("last_price"))
    other = b.select((F.col("sec") + 1).alias("sec"), "d", F.col("close").alias("acquirer_price"))
    out = T.asof_backward(own, other, "sec", "delist_date", "d", ["acquirer_price"]).filter("last_price IS NOT NULL AND acquirer_price IS NOT NULL")
    return out.select("sec", "last_price", "acquirer_price", F.round((0.5 * F.col("last_price") + 0.25 * F.col("acquirer_price")) / F.col("last_price") - 1, 4).alias("terminal"))


@query("""SELECT sec, symbol, valid_from, COALESCE(valid_to, CASE WHEN closed THEN last_d END) AS valid_to
  FROM (SELECT m.*, b.last_d, b.last_d < (SELECT MAX(d) FROM bars) - 30 AS closed FROM symbol_map m
  JOIN (SELECT sec, MAX(d) AS last_d FROM bars GROUP BY 1) b USING (sec))""")
def close_open_intervals(spark, d):
    b = X.bars(spark, d)
    newest = b.agg(F.max("d")).first()[0]
    last = b.groupBy("sec").agg(F.max("d").alias("last_d"))
    m = X.symbol_map(spark, d).join(last, "sec")
    end = F.coalesce("valid_to", F.when(F.col("last_d") < F.date_sub(F.lit(newest), 30), F.col("last_d")))
    return m.select("sec", "symbol", "valid_from", end.alias("valid_to"))


@query("""SELECT sec, symbol, valid_from, LEAD(valid_from) OVER w AS next_from, CASE WHEN LEAD(valid_from) OVER w <= COALESCE(valid_to,
  DATE '9999-12-31') AND date_diff('day', LEAD(valid_from) OVER w, COALESCE(valid_to, DATE '9999-12-31')) <= 400
  THEN LEAD(valid_from) OVER w - 1 ELSE valid_to END AS trimmed
  FROM symbol_map WINDOW w AS (PARTITION BY symbol ORDER BY valid_from, sec)""")
def boundary_trim(spark, d):
    w = Window.partitionBy("symbol").orderBy("valid_from", "sec")
    end, nxt = F.coalesce("valid_to", F.lit(T.FOREVER).cast("date")), F.lead("valid_from").over(w)
    cut = F.when((nxt <= end) & (F.datediff(end, nxt) <= 400), F.date_sub(nxt, 1)).otherwise(F.col("valid_to"))
    return X.symbol_map(spark, d).select("sec", "symbol", "valid_from", nxt.alias("next_from"), cut.alias("trimmed"))
