"""Queries over predicates, classifications and plain aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import predicates as P
from tessera.operators import selection
from tessera.operators.temporal import by_priority
from tessera.plans.registry import query
from tessera.sources import fixtures as X


@query("""SELECT COALESCE(CASE WHEN l_discount <> 0 THEN l_discount END, l_tax) AS truthy, COUNT(*) AS n,
  COUNT(CASE WHEN l_tax <> 0 THEN 1 END) AS taxed FROM lineitem GROUP BY 1""")
def first_truthy(spark, d):
    li = X.table(spark, d, "lineitem")
    return li.groupBy(P.first_truthy("l_discount", "l_tax").alias("truthy")).agg(F.count("*").alias("n"), F.count(P.zero_as_null("l_tax")).alias("taxed"))


LAGS = """SELECT l_orderkey, l_linenumber, CASE WHEN days IS NULL OR days <= 10 THEN 'missing' WHEN days <= 25 THEN 'release'
  WHEN days <= 200 THEN 'filing' ELSE 'delinquent' END AS lag_class FROM (
  SELECT l_orderkey, l_linenumber, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query("SELECT lag_class, COUNT(*) AS n, COUNT(DISTINCT l_orderkey) AS orders FROM lags GROUP BY 1", lags=LAGS)
def lag_class(spark, d):
    rows = X.table(spark, d, "lineitem").join(X.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy(P.lag_class("l_shipdate", "o_orderdate").alias("lag_class")).agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("orders"))


LABELS = """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size END AS num, CASE WHEN p_partkey % 5 <> 0 THEN p_partkey % 4 END AS den,
  CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) || ':2' WHEN 1 THEN '3/' || CAST(p_size % 3 AS VARCHAR) WHEN 2
  THEN 'x-2' ELSE CAST(p_size AS VARCHAR) END AS label FROM part"""


@query("""SELECT p_partkey, COALESCE(CAST(NULLIF(num, 0) AS DOUBLE) / NULLIF(den, 0),
  TRY_CAST(trim(string_split_regex(label, '[:/-]')[1]) AS DOUBLE) / NULLIF(TRY_CAST(trim(string_split_regex(label, '[:/-]')[2]) AS DOUBLE),
  0)) AS ratio FROM labels_""", labels_=LABELS)
def split_ratio_parse(spark, d):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    label = F.when(k % 4 == 0, F.concat(size, F.lit(":2"))).when(k % 4 == 1, F.concat(F.lit("3/"), (F.col("p_size") % 3).cast("string"))).when(k % 4 == 2, F.lit("x-2")).otherwise(size)
    rows = X.table(spark, d, "part").select("p_partkey", F.when(k % 3 == 0, F.col("p_size")).alias("num"), F.when(k % 5 != 0, k % 4).alias("den"), label.alias("label"))
    return rows.select("p_partkey", P.split_ratio("num", "den", "label").alias("ratio"))


SYMBOLS = """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'ABC-P' || substr('ABC', 1 + CAST(p_size % 3 AS INTEGER), 1) WHEN 1
  THEN 'ABC-UN' WHEN 2 THEN 'WXYZ' || substr('UWRA', 1 + CAST(p_size % 4 AS INTEGER), 1)
  WHEN 3 THEN 'AB-W' WHEN 4 THEN 'AB-WS' WHEN 5 THEN upper(substr(p_name, 1, 3)) WHEN 6 THEN 'BRK-R' ELSE 'T-PX1' END AS symbol, p_size FROM part"""


def _symbols(spark, d):
    k, z = F.col("p_partkey") % 8, F.col("p_size")
    s = (
        F.when(k == 0, F.concat(F.lit("ABC-P"), F.substring(F.lit("ABC"), z % 3 + 1, F.lit(1)))).when(k == 1, "ABC-UN").when(k == 2, F.concat(F.lit("WXYZ"), F.substring(F.lit("UWRA"), z % 4 + 1, F.lit(1))))
        .when(k == 3, "AB-W").when(k == 4, "AB-WS").when(k == 5, F.upper(F.substring("p_name", 1, 3))).when(k == 6, "BRK-R").otherwise("T-PX1")
    )
    return X.table(spark, d, "part").select("p_partkey", s.alias("symbol"), "p_size")


@query("""SELECT symbol, regexp_matches(symbol, '-(P[A-Z]?|UN|WS|WT|R|U)$') OR (length(symbol) = 5
  AND substr(symbol, 5, 1) IN ('U', 'W', 'R')) AS excluded,
  CASE WHEN regexp_matches(symbol, '-(P[A-Z]?|UN|WS|WT|R|U)$') THEN 'suffix' WHEN length(symbol) = 5 AND substr(symbol, 5, 1) = 'U' THEN '5U'
  WHEN length(symbol) = 5 AND substr(symbol, 5, 1) = 'W' THEN '5W' WHEN length(symbol) = 5 AND substr(symbol, 5, 1) = 'R' THEN '5R' ELSE 'common?' END AS class, COUNT(*) AS n
  FROM symbols_ GROUP BY ALL""", symbols_=SYMBOLS)
def instrument_class(spark, d):
    return _symbols(spark, d).groupBy("symbol", P.not_common("symbol").alias("excluded"), P.instrument_class("symbol").alias("class")).agg(F.count("*").alias("n"))


@query("""SELECT p_size, MIN(class) AS label, bool_or(class <> 'common?') AS excluded
  FROM (SELECT p_size, CASE WHEN regexp_matches(symbol, '-(P[A-Z]?|UN|WS|WT|R|U)$') THEN 'suffix'
  WHEN length(symbol) = 5 AND substr(symbol, 5, 1) IN ('U', 'W', 'R')
  THEN '5' || substr(symbol, 5, 1) ELSE 'common?' END AS class FROM symbols_) GROUP BY 1""", symbols_=SYMBOLS)
def instrument_label_per_entity(spark, d):
    rows = _symbols(spark, d).withColumn("class", P.instrument_class("symbol"))
    return rows.groupBy("p_size").agg(F.array_min(F.collect_set("class")).alias("label"), F.bool_or(F.col("class") != "common?").alias("excluded"))


@query("""SELECT c_custkey, lpad(ltrim(CAST(c_custkey AS VARCHAR), '0'), 10, '0') AS padded,
  COALESCE(NULLIF(ltrim('00' || CAST(c_custkey AS VARCHAR), '0'), '') =
  NULLIF(ltrim(CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(c_custkey + CAST(c_custkey % 3 = 0 AS INTEGER) AS VARCHAR) END, '0'), ''), TRUE) AS same,
  upper(c_mktsegment) LIKE '%MACH%' OR upper(c_mktsegment) LIKE '%AUTO%' AS segment FROM customer""")
def issuer_gate(spark, d):
    k = F.col("c_custkey")
    other = F.when(k % 4 == 0, "").otherwise((k + (k % 3 == 0).cast("int")).cast("string"))
    seg = F.upper("c_mktsegment").rlike("MACH|AUTO")
    return X.table(spark, d, "customer").select("c_custkey", P.padded_id(k.cast("string")).alias("padded"), P.same_issuer(F.concat(F.lit("00"), k.cast("string")), other).alias("same"), seg.alias("segment"))


@query("SELECT CASE WHEN p IS NULL THEN 'no-oracle' WHEN p >= 99 THEN '99+' WHEN p >= 95 THEN '95-99' ELSE '<95' END AS bucket, COUNT(*) AS n FROM (SELECT CASE WHEN c_custkey % 9 <> 0 THEN 90 + c_custkey % 11 END AS p FROM customer) GROUP BY 1")
def recon_buckets(spark, d):
    k = F.col("c_custkey")
    rows = X.table(spark, d, "customer").select(F.when(k % 9 != 0, 90 + k % 11).alias("p"))
    return rows.groupBy(P.bucket_of_match("p").alias("bucket")).agg(F.count("*").alias("n"))


@query("""SELECT tag, COUNT(*) AS n FROM (SELECT CASE WHEN NOT r AND abs(v - b) <= greatest(50, 0.005::DOUBLE * abs(b)) THEN 'unrestated' WHEN r
  AND abs(v - a) <= greatest(50, 0.005::DOUBLE * abs(a)) THEN 'original'
  WHEN r AND abs(v - b) <= greatest(50, 0.005::DOUBLE * abs(b)) THEN 'restated' ELSE 'neither' END AS tag FROM (
  SELECT a, b, v, NOT abs(a - b) <= greatest(50, 0.005::DOUBLE * abs(b)) AS r
  FROM (SELECT o_totalprice AS a, o_totalprice + o_custkey % 3 * 2000 AS b, o_totalprice + o_orderkey % 4 * 1000 AS v FROM orders))) GROUP BY 1""")
def restatement_tags(spark, d):
    a, b, v = F.col("o_totalprice"), F.col("o_totalprice") + F.col("o_custkey") % 3 * 2000, F.col("o_totalprice") + F.col("o_orderkey") % 4 * 1000
    return X.table(spark, d, "orders").groupBy(P.restatement_tag(v, a, b, 50.0, 0.005).alias("tag")).agg(F.count("*").alias("n"))


@query("""SELECT strftime(o_orderdate, '%G-W%V') AS week, COUNT(*) AS n, COUNT(CASE WHEN o_orderpriority = '5-LOW'
  THEN 1 END) AS low, COUNT(DISTINCT o_custkey) AS customers,
  ROUND(100 * COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END) / CAST(COUNT(*) AS DOUBLE), 2) AS pct_open FROM orders GROUP BY 1""")
def filtered_counts_by_week(spark, d):
    g = X.table(spark, d, "orders").groupBy(P.iso_week("o_orderdate").alias("week"))
    return g.agg(F.count("*").alias("n"), F.count_if(F.col("o_orderpriority") == "5-LOW").alias("low"), F.countDistinct("o_custkey").alias("customers"), F.round(100 * F.count_if(F.col("o_orderstatus") == "P") / F.count("*"), 2).alias("pct_open"))


@query("""SELECT o_orderpriority AS p, quantile_disc(o_totalprice, 0.25) AS q25, quantile_disc(o_totalprice, 0.5) AS q50, quantile_disc(o_totalprice,
  0.75) AS q75, COUNT(*) AS n FROM orders GROUP BY 1""")
def disc_percentiles(spark, d):
    rows = X.table(spark, d, "orders").select(F.col("o_orderpriority").alias("p"), "o_totalprice")
    return selection.discrete_percentiles(rows, "o_totalprice", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["p"])


@query("""SELECT p_brand, string_agg(DISTINCT p_type, ','
  ORDER BY p_type) AS types, len(list(DISTINCT p_size)) AS sizes, arg_max(p_name, p_partkey) AS newest,
  ROUND(stddev_samp(p_retailprice), 6) AS sd, ROUND(avg(p_retailprice) / (stddev_samp(p_retailprice) / sqrt(COUNT(*))), 6) AS t FROM part
  GROUP BY 1 HAVING COUNT(*) >= 3""")
def ordered_aggregates(spark, d):
    g = X.table(spark, d, "part").groupBy("p_brand").agg(
        F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("types"), F.size(F.collect_set("p_size")).cast("long").alias("sizes"), F.max_by("p_name", "p_partkey").alias("newest"),
        F.round(F.stddev_samp("p_retailprice"), 6).alias("sd"), F.round(F.avg("p_retailprice") / (F.stddev_samp("p_retailprice") / F.sqrt(F.count("*"))), 6).alias("t"), F.count("*").alias("n"),
    )
    return g.filter("n >= 3").drop("n")


@query("""SELECT c_custkey, substr(sha256('acctbal=' || CASE WHEN c_custkey % 6 = 0
  THEN 'null' ELSE CAST(CAST(ROUND(c_acctbal * 100) AS BIGINT) AS VARCHAR) END || '|name=' || c_name || '|segment=' || c_mktsegment), 1,
  16) AS hash FROM customer""")
def curated_hash(spark, d):
    bal = F.when(F.col("c_custkey") % 6 != 0, X.cents("c_acctbal"))
    return X.table(spark, d, "customer").select("c_custkey", P.canonical_hash({"name": F.col("c_name"), "segment": F.col("c_mktsegment"), "acctbal": bal}).alias("hash"))


@query("""SELECT event_type, CAST(props->>'$.k' AS INTEGER) AS k, COUNT(*) AS n FROM events GROUP BY ALL""")
def json_path_extract(spark, d):
    rows = X.table(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return rows.groupBy("event_type", "k").agg(F.count("*").alias("n"))


@query("""SELECT sec, MIN(v) AS first_v, MAX(v) AS last_v, COUNT(*) AS n
  FROM (SELECT user_id AS sec, value AS v, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
  WHERE p IS NULL OR v <> p GROUP BY 1""")
def collapsed_facts(spark, d):
    from pyspark.sql import Window

    rows = X.table(spark, d, "events").withColumn("p", F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return rows.filter("p IS NULL OR value <> p").groupBy(F.col("user_id").alias("sec")).agg(F.min("value").alias("first_v"), F.max("value").alias("last_v"), F.count("*").alias("n"))


@query("""SELECT sec, m, v, d FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sec, m ORDER BY d DESC, v DESC) AS n
  FROM (SELECT o_custkey AS sec, strftime(o_orderdate, '%Y-%m') AS m, o_totalprice AS v, CAST(o_orderdate AS DATE) AS d FROM orders)) WHERE n = 1""")
def month_end_reduction(spark, d):
    rows = X.table(spark, d, "orders").select(F.col("o_custkey").alias("sec"), F.date_format("o_orderdate", "yyyy-MM").alias("m"), F.col("o_totalprice").alias("v"), F.col("o_orderdate").cast("date").alias("d"))
    return rows.groupBy("sec", "m").agg(F.max(F.struct("d", "v")).alias("x")).select("sec", "m", "x.v", "x.d")


@query("""SELECT a.sec, a.d, COALESCE(mx, 0) AS by_max, COALESCE(sm, 0) AS by_sum
  FROM (SELECT l_suppkey AS sec, CAST(l_shipdate AS DATE) AS d, MAX(CAST(ROUND(l_tax * 100) AS BIGINT)) AS mx,
  CAST(SUM(CAST(ROUND(l_tax * 100) AS BIGINT)) AS BIGINT) AS sm FROM lineitem GROUP BY 1, 2) a""")
def same_day_combination(spark, d):
    g = X.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("sec"), F.col("l_shipdate").cast("date").alias("d"))
    return g.agg(F.max(X.cents("l_tax")).alias("by_max"), F.sum(X.cents("l_tax")).alias("by_sum"))


@query("""SELECT src, k FROM (SELECT 'supplier' AS src, s_suppkey AS k FROM supplier WHERE s_suppkey % 2 = 0
  UNION ALL SELECT 'customer', c_custkey FROM customer
  WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0))""")
def priority_merge(spark, d):
    s = X.table(spark, d, "supplier").filter("s_suppkey % 2 = 0").select(F.lit("supplier").alias("src"), F.col("s_suppkey").alias("k"))
    c = X.table(spark, d, "customer").select(F.lit("customer").alias("src"), F.col("c_custkey").alias("k"))
    return by_priority([s, c], ["k"])


@query("""SELECT k, COUNT(*) AS parts FROM (SELECT DISTINCT k, src FROM (SELECT o_custkey AS k, 'o' AS src FROM orders
  UNION ALL SELECT l_suppkey, 'l' FROM lineitem UNION ALL SELECT c_custkey, 'c' FROM customer)) GROUP BY 1
  HAVING COUNT(*) < 3""")
def union_of_targets(spark, d):
    one = lambda t, c, s: X.table(spark, d, t).select(F.col(c).alias("k"), F.lit(s).alias("src"))
    rows = one("orders", "o_custkey", "o").unionByName(one("lineitem", "l_suppkey", "l")).unionByName(one("customer", "c_custkey", "c")).distinct()
    return rows.groupBy("k").agg(F.count("*").alias("parts")).filter("parts < 3")


@query("""SELECT k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') UNION ALL SELECT k
  FROM (SELECT p_partkey AS k FROM part INTERSECT SELECT l_partkey FROM lineitem WHERE l_quantity > 49)""")
def difference_and_intersection(spark, d):
    c, o = X.table(spark, d, "customer").select(F.col("c_custkey").alias("k")), X.table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    p, li = X.table(spark, d, "part").select(F.col("p_partkey").alias("k")), X.table(spark, d, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("k"))
    return c.subtract(o).unionByName(p.intersect(li))


@query("""SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o
  WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000) AND c_custkey IN (SELECT DISTINCT o_custkey FROM orders
  WHERE o_orderdate >= DATE '1999-01-01')""")
def resume_targets(spark, d):
    c, o = X.table(spark, d, "customer"), X.table(spark, d, "orders")
    done = o.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    due = o.filter("o_orderdate >= DATE'1999-01-01'").select(F.col("o_custkey").alias("c_custkey"))
    return c.select("c_custkey").join(done, "c_custkey", "left_anti").join(due, "c_custkey", "left_semi")


@query(f"""SELECT COALESCE(a, b) AS present, COUNT(*) AS n
  FROM (SELECT CASE WHEN l_returnflag = 'R' THEN l_discount END AS a, CASE WHEN l_linestatus = 'F' THEN l_tax END AS b FROM lineitem) GROUP BY 1""")
def first_present(spark, d):
    """Zero is a value here, unlike in first_truthy."""
    li = X.table(spark, d, "lineitem")
    a, b = F.when(F.col("l_returnflag") == "R", F.col("l_discount")), F.when(F.col("l_linestatus") == "F", F.col("l_tax"))
    return li.groupBy(P.first_present(a, b).alias("present")).agg(F.count("*").alias("n"))


VENUES = """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'NYSE American' WHEN 1 THEN 'NASDAQ Global Select' WHEN 2 THEN 'OTC' WHEN 3
  THEN 'amex' END AS venue,
  CASE c_custkey % 4 WHEN 0 THEN 'Financial Services' WHEN 1 THEN 'financials' WHEN 2 THEN c_mktsegment END AS sector FROM customer"""


@query("""SELECT venue, sector, COALESCE(upper(venue) LIKE '%NYSE%' OR upper(venue) LIKE '%NASDAQ%' OR upper(venue) LIKE '%AMEX%', FALSE) AS listed,
  COALESCE(lower(sector) LIKE '%financ%', FALSE) AS financial, COUNT(*) AS n FROM venues GROUP BY ALL""", venues=VENUES)
def venue_and_sector_flags(spark, d):
    k = F.col("c_custkey")
    venue = F.when(k % 5 == 0, "NYSE American").when(k % 5 == 1, "NASDAQ Global Select").when(k % 5 == 2, "OTC").when(k % 5 == 3, "amex")
    sector = F.when(k % 4 == 0, "Financial Services").when(k % 4 == 1, "financials").when(k % 4 == 2, F.col("c_mktsegment"))
    rows = X.table(spark, d, "customer").select(venue.alias("venue"), sector.alias("sector"))
    return rows.groupBy("venue", "sector", P.listed("venue").alias("listed"), P.financial("sector").alias("financial")).agg(F.count("*").alias("n"))


@query("""SELECT o_custkey AS sec, CAST(o_orderdate AS DATE) AS fiscal_date, COUNT(*) AS n FROM orders
  WHERE CAST(o_orderdate AS DATE) >= date_trunc('year', (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)) GROUP BY 1, 2""")
def future_estimates(spark, d):
    """Estimates for the year of the last one or later; past years are left out."""
    o = X.table(spark, d, "orders").select(F.col("o_custkey").alias("sec"), F.col("o_orderdate").cast("date").alias("fiscal_date"))
    today = o.agg(F.max("fiscal_date")).first()[0]
    return o.filter(P.not_past("fiscal_date", F.lit(today))).groupBy("sec", "fiscal_date").agg(F.count("*").alias("n"))
