"""Queries over sources, keyed writes and the incremental loop."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions import predicates as P
from tessera.operators.temporal import by_priority, visible_on_grid
from tessera.plans.registry import query
from tessera.sources import files, keyed_table, tables
from tessera.sources import fixtures as X
from tessera.sources.scratch import scratch_path
from tessera.streaming import incremental, keyed, recompute


@query("""SELECT part, COUNT(*) AS n, SUM(volume) AS volume
  FROM (SELECT CASE WHEN d < DATE '1997-01-01' THEN 1 WHEN d < DATE '1999-01-01' THEN 2 ELSE 3 END AS part, volume FROM bars
  WHERE d BETWEEN DATE '1996-03-01' AND DATE '2000-06-30') GROUP BY 1""")
def date_chunk_scan(spark, d):
    edges = [("1996-03-01", "1996-12-31"), ("1997-01-01", "1998-12-31"), ("1999-01-01", "2000-06-30")]
    out = None
    for i, (low, high) in enumerate(edges, 1):
        one = files.scan_dates(X.bars(spark, d), "d", low, high).select(F.lit(i).alias("part"), "volume")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("part").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@query("""SELECT sec, COUNT(*) AS n, COUNT(CASE WHEN page = 'old' THEN 1 END) AS filled FROM (SELECT sec, d, 'new' AS page FROM bars
  WHERE d >= DATE '1999-01-01' UNION ALL SELECT sec, d, 'old' FROM bars WHERE d < DATE '1999-01-01') GROUP BY 1""")
def fill_back_scan(spark, d):
    """A capped page is filled up by an older one that overlaps it; what came
    first on a day counts."""
    b = X.bars(spark, d).select("sec", "d")
    new, old = b.filter("d >= DATE'1999-01-01'").withColumn("page", F.lit("new")), b.filter("d <= DATE'1999-06-30'").withColumn("page", F.lit("old"))
    return by_priority([new, old], ["sec", "d"]).groupBy("sec").agg(F.count("*").alias("n"), F.count_if(F.col("page") == "old").alias("filled"))


@query("SELECT s_suppkey AS sec, s_name AS name, s_nationkey AS nation FROM supplier")
def csv_scan(spark, d):
    path = scratch_path(spark, "csv")
    files.write_artifact(X.table(spark, d, "supplier").select(F.col("s_suppkey").alias("sec"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")), path, "csv")
    return files.scan_csv(spark, path, "sec long, name string, nation int")


@query("SELECT n_nationkey AS k, n_name AS name, n_regionkey AS region FROM nation")
def json_scan(spark, d):
    path = scratch_path(spark, "json")
    files.write_artifact(X.table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")), path)
    return files.scan_json(spark, path, "k long, name string, region int")


@query("""SELECT m AS month, COUNT(*) AS n, ROUND(SUM(v), 6) AS value
  FROM (SELECT strftime(o_orderdate, '%Y%m') AS m, (o_orderkey % 1000) / 100::DOUBLE AS v FROM orders WHERE o_orderkey % 3 <> 0) GROUP BY 1""")
def ragged_text_scan(spark, d):
    o = X.table(spark, d, "orders")
    m, v = F.date_format("o_orderdate", "yyyyMM"), (F.col("o_orderkey") % 1000).cast("string")
    line = F.when(F.col("o_orderkey") % 3 != 0, F.concat_ws(", ", m, v)).when(F.col("o_orderkey") % 2 == 0, F.concat_ws(",", m, v, v)).otherwise("Annual, 2.0")
    path = scratch_path(spark, "text")
    o.select(line.alias("value")).write.text(path)
    return files.scan_months(spark, path).groupBy("month").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("value"))


@query("SELECT o_custkey AS k, MIN(o_orderkey) AS first_order FROM orders WHERE o_custkey % 2 = 1 GROUP BY 1")
def insert_or_ignore(spark, d):
    have = X.table(spark, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"))
    new = X.table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("first_order"))
    return tables.only_new(have, new, ["k"], ["first_order"])


# of each customer the highest order put over the balance; every third under a key of its own
_PUT = """SELECT c_custkey AS k, COALESCE(o.v, c_acctbal) AS v FROM customer LEFT JOIN (SELECT o_custkey, MAX(o_totalprice) AS v FROM orders
  WHERE o_custkey % 3 <> 1 GROUP BY 1) o ON o.o_custkey = c_custkey
  UNION ALL SELECT -o_custkey, MAX(o_totalprice) FROM orders WHERE o_custkey % 3 = 1 GROUP BY 1"""


def _balances(spark, d):
    have = X.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    new = X.table(spark, d, "orders").select(F.when(F.col("o_custkey") % 3 == 1, -F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("k"), F.col("o_totalprice").alias("v"), "o_orderkey")
    return have, new


@query(_PUT)
def upsert(spark, d):
    have, new = _balances(spark, d)
    return tables.upserted(have, new.drop("o_orderkey"), ["k"], [F.desc("v")])


def _kept(spark, name, rows):
    """A keyed table of its own."""
    return keyed_table.KeyedTable(spark, f"tessera_{name}_{uuid.uuid4().hex}", "k").create(rows)


@query(_PUT)
def upsert_by_deltas(spark, d):
    """The same in three batches, of which each becomes a delta: what a later
    batch puts higher is put over, after a compaction too."""
    have, new = _balances(spark, d)
    table, last = _kept(spark, "balances", have), None
    for i in range(3):
        batch = new.filter(F.col("o_orderkey") % 3 == i).groupBy("k").agg(F.max("v").alias("v"))
        last = batch if last is None else last.unionByName(batch).groupBy("k").agg(F.max("v").alias("v"))
        table.upsert(last)
        if i == 1:
            table.compact()
    return table.read()


@query("""SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT o_custkey, MAX(o_totalprice) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) GROUP BY 1""")
def insert_new_by_deltas(spark, d):
    """Insert or ignore into every second customer, all orders twice over."""
    have, _ = _balances(spark, d)
    new = X.table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"))
    table = _kept(spark, "inserted", have.filter("k % 2 = 0"))
    for batch in (new, new.withColumn("v", F.col("v") + 1)):
        table.insert_new(batch, [F.desc("v")])
    return table.read()


@query("SELECT p_brand AS name, ROW_NUMBER() OVER (ORDER BY substr(md5(p_brand), 1, 3), p_brand) AS id FROM (SELECT DISTINCT p_brand FROM part)")
def surrogate_ids(spark, d):
    return tables.with_ids(X.table(spark, d, "part").select(F.col("p_brand").alias("name")).distinct(), "name")


@query("SELECT year(o_orderdate) AS y, COUNT(*) AS n, COUNT(CASE WHEN year(o_orderdate) = 1997 THEN 1 END) AS rebuilt FROM orders WHERE year(o_orderdate) <> 1997 OR o_orderkey % 2 = 0 GROUP BY 1")
def partition_rebuild(spark, d):
    path = scratch_path(spark, "orders")
    o = X.table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.lit(0).alias("rebuilt"))
    tables.replace_partitions(o, path, ["y"])
    tables.replace_partitions(o.filter("y = 1997 AND o_orderkey % 2 = 0").withColumn("rebuilt", F.lit(1)), path, ["y"])
    return spark.read.schema("o_orderkey long, rebuilt int, y int").parquet(path).groupBy("y").agg(F.count("*").alias("n"), F.sum("rebuilt").alias("rebuilt"))


NEXT = """SELECT sec, period_end, 2 AS vintage_id, h
  FROM (SELECT b.sec, b.period_end, substr(sha256('gp=' || CAST(CAST(ROUND(b.gp * 100) AS BIGINT) AS VARCHAR)), 1, 16) AS h,
  substr(sha256('gp=' || CAST(CAST(ROUND(a.gp * 100) AS BIGINT) AS VARCHAR)), 1, 16) AS old, a.sec AS known
  FROM (SELECT * FROM statements WHERE vintage_id = 2) b JOIN (SELECT * FROM statements
  WHERE vintage_id = 1) a ON a.sec = b.sec AND a.period_end = b.period_end) WHERE h <> old
  UNION ALL SELECT b.sec, b.period_end, 1, substr(sha256('gp=' || CAST(CAST(ROUND(b.gp * 100) AS BIGINT) AS VARCHAR)), 1, 16) FROM statements b
  WHERE vintage_id = 2 AND NOT EXISTS (SELECT 1 FROM statements a WHERE a.vintage_id = 1 AND a.sec = b.sec AND a.period_end = b.period_end)"""


@query(NEXT)
def restatement_capture(spark, d):
    """A feed row becomes a new vintage only if its hash differs from the latest."""
    s = X.statements(spark, d).withColumn("h", P.canonical_hash({"gp": X.cents("gp")}))
    have, feed = s.filter("vintage_id = 1").select("sec", "period_end", "vintage_id", "h"), s.filter("vintage_id = 2").select("sec", "period_end", "h")
    return incremental.new_vintages(have, feed, ["sec", "period_end"], "h").select("sec", "period_end", "vintage_id", "h")


@query("""SELECT CAST(ts AS DATE) AS d, event_type, COUNT(DISTINCT event_id) AS n, ROUND(SUM(value), 4) AS value FROM events GROUP BY 1, 2""")
def stream_daily_events(spark, d):
    """Events read as a stream, each once within five days, counted by day."""
    events = spark.readStream.schema("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").option("pathGlobFilter", "events.parquet").parquet(d)
    once = incremental.once_within(events.withColumn("at", F.col("ts").cast("timestamp")), "at", ["event_id"], "5 days")
    out = scratch_path(spark, "daily-events")

    def daily(rows, _batch):
        # counts of one batch; batches are summed when they are read
        rows.groupBy(F.col("ts").cast("date").alias("d"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).write.parquet(f"{out}/batch={_batch}", mode="overwrite")

    incremental.run_available(once, daily, scratch_path(spark, "daily-events-state"))
    parts = spark.read.schema("d date, event_type string, n long, value double").parquet(f"{out}/*")
    return parts.groupBy("d", "event_type").agg(F.sum("n").alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query("""SELECT sec, COUNT(*) AS days, MAX(d) AS last_d FROM (SELECT sec, d FROM bars WHERE d < DATE '1999-01-01'
  UNION ALL SELECT b.sec, b.d FROM bars b JOIN (SELECT sec, MAX(d) AS last_d FROM bars WHERE d < DATE '1999-01-01'
  GROUP BY 1) l ON l.sec = b.sec AND b.d > l.last_d) GROUP BY 1""")
def append_later_bars(spark, d):
    """Bars not later than the last stored one of their security are ignored."""
    b = X.bars(spark, d).select("sec", "d", "close")
    stored = b.filter("d < DATE'1999-01-01'")
    return stored.unionByName(incremental.later_rows(stored, b, "sec", "d")).groupBy("sec").agg(F.count("*").alias("days"), F.max("d").alias("last_d"))


# the loop's clock is the events' hours, its log what the first half of them left
_ASKED = """SELECT DISTINCT now, job, period FROM (SELECT now, unnest([
    CASE WHEN isodow(now) < 6 AND hour(now) >= 23 THEN {'job': 'daily', 'period': strftime(now, '%Y-%m-%d')} END, CASE WHEN isodow(now) = 6
    AND hour(now) >= 12 THEN {'job': 'weekly', 'period': strftime(now, '%G-W%V')} END,
    CASE WHEN day(now) >= 2 AND hour(now) >= 13 THEN {'job': 'monthly', 'period': strftime(now, '%Y-%m')} END], recursive := true)
    FROM (SELECT DISTINCT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS now FROM events)) WHERE job IS NOT NULL"""


def _asked(spark, d):
    return incremental.due(X.table(spark, d, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("now")).distinct())


@query("SELECT job, period, COUNT(*) AS times, MIN(now) AS first_now FROM asked GROUP BY 1, 2", asked=_ASKED)
def schedule_predicate(spark, d):
    return _asked(spark, d).groupBy("job", "period").agg(F.count("*").alias("times"), F.min("now").alias("first_now"))


_LOG = """SELECT job, period, CASE length(period) % 2 + ascii(right(period, 1)) % 2 WHEN 0 THEN 'ok' WHEN 1 THEN 'running' ELSE 'error' END AS status,
    MIN(now) - to_hours(CASE WHEN ascii(right(period, 1)) % 4 = 1 THEN 7 ELSE 5 END) AS ran_at FROM asked
    WHERE ascii(right(period, 1)) % 3 <> 0 GROUP BY 1, 2"""


def _log(spark, d):
    last = F.ascii(F.right("period", F.lit(1)))
    code = F.length("period") % 2 + last % 2
    rows = _asked(spark, d).groupBy("job", "period").agg(F.min("now").alias("now")).filter(last % 3 != 0)
    at = F.col("now") - F.make_dt_interval(F.lit(0), F.when(last % 4 == 1, 7).otherwise(5))
    return rows.select("job", "period", F.when(code == 0, "ok").when(code == 1, "running").otherwise("error").alias("status"), at.alias("ran_at"))


@query("""SELECT a.job, a.period, a.now FROM (SELECT job, period, MIN(now) AS now FROM asked GROUP BY 1, 2) a LEFT
  JOIN log_ l ON l.job = a.job AND l.period = a.period
  WHERE l.status IS NULL OR (l.status = 'running' AND l.ran_at < a.now - INTERVAL 6 HOUR)""", asked=_ASKED, log_=_LOG)
def claimable_periods(spark, d):
    return incremental.claimable(_asked(spark, d), _log(spark, d))


@query("""SELECT status, COUNT(*) AS n FROM (SELECT COALESCE(CASE WHEN c.job IS NOT NULL THEN 'ok' END, l.status) AS status FROM log_ l FULL
  JOIN (SELECT a.job, a.period FROM (SELECT job, period, MIN(now) AS now FROM asked GROUP BY 1, 2) a
  LEFT JOIN log_ l ON l.job = a.job AND l.period = a.period
  WHERE l.status IS NULL OR (l.status = 'running' AND l.ran_at < a.now - INTERVAL 6 HOUR)) c ON c.job = l.job AND c.period = l.period)
  GROUP BY 1""", asked=_ASKED, log_=_LOG)
def job_status_recording(spark, d):
    log = _log(spark, d).withColumn("detail", F.lit(""))
    after = incremental.recorded(log, incremental.claimable(_asked(spark, d), log), "ok", F.lit("done"))
    return after.groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT job, period, status, ran_at FROM log_ ORDER BY ran_at DESC, job, period LIMIT 8", asked=_ASKED, log_=_LOG)
def api_summary_jobs(spark, d):
    """The eight jobs that ran last; eight is what the page shows."""
    return _log(spark, d).orderBy(F.desc("ran_at"), "job", "period").limit(8)


_TODAY = "(SELECT MAX(d) FROM bars)"
_CAPS = """SELECT c.as_of, m.sec, m.close * x.shares AS mktcap FROM month_end m JOIN calendar c ON c.as_of = m.as_of
  JOIN securities x ON x.sec = m.sec WHERE m.sec % 7 <> 0"""
_LATE = f"""SELECT max_by(d, d) AS as_of, sec, max_by(v, d) AS mktcap FROM (SELECT b.sec, b.d, b.close * x.shares AS v FROM bars b
  JOIN securities x ON x.sec = b.sec WHERE b.d >= {_TODAY} - 45 AND b.close * x.shares > 0) GROUP BY sec, date_trunc('month', d)"""


@query("""SELECT COALESCE(n.as_of, o.as_of) AS as_of, COALESCE(n.sec, o.sec) AS sec, ROUND(COALESCE(n.mktcap, o.mktcap),
  2) AS mktcap FROM caps o FULL JOIN late n ON n.as_of = o.as_of AND n.sec = o.sec""", caps=_CAPS, late=_LATE)
def mktcap_topup(spark, d):
    """Stored month-end market caps with the last of each month put over them
    that the last 45 days of the daily feed have."""
    x = X.securities(spark, d).select("sec", "shares")
    stored = X.month_end(spark, d).join(x, "sec").filter("sec % 7 <> 0").select("as_of", "sec", (F.col("close") * F.col("shares")).alias("mktcap"))
    daily = X.bars(spark, d).join(x, "sec").select("sec", "d", (F.col("close") * F.col("shares")).alias("mktcap"))
    today = daily.agg(F.max("d")).first()[0]
    return incremental.topped_up(stored, daily, F.lit(today)).withColumn("mktcap", F.round("mktcap", 2))


def _in_two(spark, rows, by_time, name):
    """rows written as two folders of a feed, the earlier half first."""
    path = scratch_path(spark, name)
    middle = rows.agg(F.percentile_approx(by_time, 0.5).alias("mid"))  # one row
    halves = rows.join(F.broadcast(middle)).withColumn("half", (F.col(by_time) > F.col("mid")).cast("int")).drop("mid")
    for half in (0, 1):
        halves.filter(F.col("half") == half).drop("half").write.parquet(f"{path}/half-{half}")
    return path


def _in_two_runs(spark, path, schema, work, out_schema):
    """A stream over the first half, and one started anew over both from where
    the first had come to; what they wrote."""
    out, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    with keyed.keyed_store(spark):
        for halves in ("half-[0]", "half-[01]"):
            rows = spark.readStream.schema(schema).parquet(f"{path}/{halves}")
            work(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out_schema).parquet(out)


_ENDED = "ascii(right(period, 1)) % 2 = 0"
_CLAIMED = f"""SELECT job, period, now FROM (WITH RECURSIVE c(job, period, now) AS (SELECT job, period, MIN(now) FROM asked GROUP BY 1, 2
  UNION ALL SELECT c.job, c.period, MIN(a.now) FROM c JOIN asked a ON a.job = c.job AND a.period = c.period AND a.now > c.now + INTERVAL 6 HOUR
  WHERE NOT ({_ENDED.replace("period", "c.period")}) GROUP BY c.job, c.period, c.now) SELECT * FROM c)"""


@query(_CLAIMED, asked=_ASKED)
def stream_claims(spark, d):
    """Two feeds ask for periods; every second period's run ends two hours after
    its first asking, the others never do and are given again when stale."""
    asked = _asked(spark, d)
    both = asked.withColumn("feed", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("what", F.lit("ask"))
    first = asked.groupBy("job", "period").agg(F.min("now").alias("now")).filter(F.ascii(F.right("period", F.lit(1))) % 2 == 0)
    ends = first.select("job", "period", (F.col("now") + F.expr("INTERVAL 2 HOURS")).alias("now"), F.lit("end").alias("what"), F.lit(0).alias("feed"))
    path = _in_two(spark, both.unionByName(ends), "now", "asked")
    schema = "now timestamp_ntz, job string, period string, feed int, what string"
    out = _in_two_runs(spark, path, schema, keyed.claims, "job string, period string, ms long, feed int")
    return out.select("job", "period", F.timestamp_millis("ms").cast("timestamp_ntz").alias("now"))


@query("""SELECT sec, period_end, CAST(ROW_NUMBER() OVER (PARTITION BY sec, period_end ORDER BY accepted, h) AS INTEGER) AS vintage, accepted, h FROM (
  SELECT *, lag(h) OVER (PARTITION BY sec, period_end ORDER BY accepted, h) AS before FROM (
    SELECT sec, period_end, accepted, substr(sha256('gp=' || CAST(CAST(ROUND(gp * 100) AS BIGINT) AS VARCHAR)), 1, 16) AS h FROM statements)) WHERE before IS NULL OR before <> h""")
def stream_vintages(spark, d):
    """Statements as a feed by acceptance: each changed hash is one vintage."""
    s = X.statements(spark, d).select("sec", "period_end", "accepted", P.canonical_hash({"gp": X.cents("gp")}).alias("h"))
    path = _in_two(spark, s, "accepted", "accepted")
    work = lambda rows: keyed.vintages(rows.withColumn("ms", keyed.millis(F.col("accepted"))), F.concat_ws(":", "sec", "period_end"))
    out = _in_two_runs(spark, path, "sec long, period_end date, accepted timestamp_ntz, h string", work, "key string, vintage int, ms long, h string")
    part = F.split("key", ":")
    return out.select(part[0].cast("long").alias("sec"), part[1].cast("date").alias("period_end"), "vintage", F.timestamp_millis("ms").cast("timestamp_ntz").alias("accepted"), "h")


_QUARTER = "(SELECT DISTINCT period_end FROM statements ORDER BY period_end DESC LIMIT 1 OFFSET 9)"
_SEEN = """SELECT sec, as_of, period_end, gp, ebit FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sec, as_of ORDER BY period_end DESC) AS nth FROM (
  SELECT s.*, c.as_of, ROW_NUMBER() OVER (PARTITION BY s.sec, c.as_of, s.period_end ORDER BY s.vintage_id DESC) AS vn
  FROM {of} s JOIN calendar c ON s.accepted <= CAST(c.as_of AS TIMESTAMP) + INTERVAL 16 HOUR AND s.period_end <= c.as_of) WHERE vn = 1) WHERE nth <= 4"""


@query("""SELECT a.as_of, COUNT(*) AS names, CAST(SUM(a.cents) AS BIGINT) AS gp_cents, r.as_of IS NOT NULL AS rebuilt FROM (
    SELECT as_of, sec, SUM(CAST(ROUND(gp * 100) AS BIGINT)) AS cents FROM seen GROUP BY 1, 2) a
  LEFT JOIN (SELECT DISTINCT as_of FROM ((SELECT * FROM seen EXCEPT SELECT * FROM seen0) UNION ALL (SELECT * FROM seen0 EXCEPT SELECT * FROM seen))) r ON r.as_of = a.as_of GROUP BY ALL""",
    earlier=f"SELECT * FROM statements WHERE NOT (vintage_id = 2 AND period_end = {_QUARTER})", seen0=_SEEN.format(of="earlier"), seen=_SEEN.format(of="statements"))
def recompute_changed_months(spark, d):
    """A table of each month's sums over what was visible, made before one
    quarter's restatements were known and refreshed with them: the months that
    they change are built anew, and the table is what a full build gives."""
    s, grid = X.statements(spark, d), X.calendar(spark, d)
    quarter = s.select("period_end").distinct().orderBy(F.desc("period_end")).offset(9).limit(1)  # one row
    late = s.join(F.broadcast(quarter), "period_end", "left_semi").filter("vintage_id = 2")
    table = recompute.MonthlyTable(spark, scratch_path(spark, "monthly"), "as_of", "sec long, cents long")
    rebuilt = []
    for rows in (s.join(late.select("sec", "period_end", "vintage_id"), ["sec", "period_end", "vintage_id"], "left_anti"), s):
        seen = visible_on_grid(rows, grid, 4).select("sec", "as_of", "period_end", "gp", "ebit")

        def build(months, seen=seen):
            own = seen.join(F.broadcast(months), "as_of")  # a row a month
            return own.groupBy("as_of", "sec").agg(F.sum(X.cents("gp")).alias("cents"))

        rebuilt = table.refresh(seen, build)
    again = F.col("as_of").isin(rebuilt) if rebuilt else F.lit(False)
    return table.read().groupBy("as_of").agg(F.count("*").alias("names"), F.sum("cents").alias("gp_cents")).withColumn("rebuilt", again)
