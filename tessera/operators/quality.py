"""Standing quality gates, audits and adjudication as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def violations(rows: DataFrame, bad: Column) -> DataFrame:
    """One row: rows_, violations. A condition that is null counts as bad."""
    return rows.agg(F.count("*").alias("rows_"), F.count_if(F.coalesce(bad, F.lit(True))).alias("violations"))


def share(rows: DataFrame, good: Column, least: float) -> DataFrame:
    """One row: rows_, share, passed. An empty table passes."""
    g = rows.agg(F.count("*").alias("rows_"), F.count_if(good).alias("n"))
    part = F.when(F.col("rows_") > 0, F.col("n") / F.col("rows_")).otherwise(1.0)
    return g.select("rows_", F.round(part, 6).alias("share"), (part >= least).alias("passed"))


def drift(left: DataFrame, right: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Keys whose two counts differ, a side without the key counting nil."""
    rows = left.join(right, key, "full_outer").select(key, F.coalesce(a, F.lit(0)).alias(a), F.coalesce(b, F.lit(0)).alias(b))
    return rows.filter(F.col(a) != F.col(b))


def adjudicated(days: Column, a_anchored: Column, b_anchored: Column, a_sentinel: Column, b_sentinel: Column, trim_up_to: int = 7) -> Column:
    """What becomes of two overlapping uses of one symbol: a short overlap is
    trimmed at the boundary; else the side with a registered issuer stays; else
    the side that begins at a placeholder date goes; else it is a conflict."""
    return (
        F.when(days <= trim_up_to, "trim").when(a_anchored & ~b_anchored, "keep-a").when(b_anchored & ~a_anchored, "keep-b")
        .when(a_sentinel & ~b_sentinel, "drop-a").when(b_sentinel & ~a_sentinel, "drop-b").otherwise("conflict")
    )


def resolution(uses: Column, is_open: Column, has_profile: Column, delisted: Column) -> Column:
    """How a symbol resolves to a security, or why it can't be."""
    return F.when(uses > 1, "reuse").when(~has_profile, "no-profile").when(is_open & ~delisted, "active").when(delisted, "delisted").otherwise("closed")


def hash_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """n rows by digest of their key: a random sample that reruns repeat."""
    return rows.orderBy(F.md5(F.encode(F.col(key).cast("string"), "UTF-8")), key).limit(n)


#: What a name is flagged with, and where its end is known from, best first (fixed values).
FLAGS = ("missing-anchors", "chimera-suspect(active)", "change-not-in-feed")
RUNGS = ("rung1-deal-feed", "rung2-delisted-feed", "reused/active-manual-map", "UNRESOLVED")


def identity_flags(rows: DataFrame) -> Column:
    """What is wrong with a name, comma-joined, empty if nothing: it lacks an
    issuer or instrument number; it is gone and yet active, where it may not be;
    it was renamed and no feed says so. A condition that is null is false."""
    is_ = lambda c: F.coalesce(rows[c], F.lit(False))
    wrong = (~(is_("issuer") & is_("instrument")), is_("gone") & is_("active") & ~is_("may_trade"), is_("renamed") & ~is_("change_known"))
    return F.concat_ws(",", *[F.when(bad, flag) for bad, flag in zip(wrong, FLAGS)])


def filing_lags(filings: DataFrame, latest: int = 8, shortest: int = 20, longest: int = 200) -> DataFrame:
    """sec, n, with_accepted, median_lag, weird from (sec, period_end, accepted?):
    over a name's latest statements how many say when they were accepted, the
    upper median of the days that took, and those that are too few or too many,
    as period:days, by period. Rows of one period are told apart by acceptance."""
    w = Window.partitionBy("sec").orderBy(F.desc("period_end"), F.desc_nulls_last("accepted"))
    rows = filings.select("sec", "period_end", "accepted").withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= latest)
    days = F.datediff("accepted", "period_end")
    weird = F.when((days < shortest) | (days > longest), F.concat(F.col("period_end").cast("string"), F.lit(":"), days.cast("string"), F.lit("d")))
    # lists of at most `latest` values
    g = rows.groupBy("sec").agg(F.count("*").alias("n"), F.count("accepted").alias("with_accepted"), F.sort_array(F.collect_list(days)).alias("lags"), F.sort_array(F.collect_list(weird)).alias("weird"))
    return g.select("sec", "n", "with_accepted", F.get("lags", F.floor(F.size("lags") / 2).cast("int")).alias("median_lag"), F.concat_ws(",", "weird").alias("weird"))


def end_known(rows: DataFrame) -> Column:
    """Where the end of a name that is gone is known from; null of one that isn't."""
    is_ = lambda c: F.coalesce(rows[c], F.lit(False))
    deal, feed, reused, none = RUNGS
    return F.when(is_("gone"), F.when(is_("deal"), deal).when(is_("listed_gone"), feed).when(is_("active"), reused).otherwise(none))


def vendor_exit(names: DataFrame, pairs: DataFrame, filings: DataFrame) -> DataFrame:
    """One row a name with its four exit gates: identity flags, total returns that
    match another series, statements with their acceptance, and an end that is
    known.

    names: sec, one row each, and issuer, instrument, active, gone, may_trade,
    renamed, change_known, deal, listed_gone (booleans); pairs: sec, d, mismatch;
    filings: sec, period_end, accepted. Match and lag are null where a name has
    none, its counts nil.
    """
    off = F.col("mismatch")
    match = pairs.groupBy("sec").agg(F.count("*").alias("days"), F.round(100 * (1 - F.count_if(off) / F.count("*")), 2).alias("match_pct"), F.min(F.when(off, F.col("d"))).alias("first_mismatch"))
    own = names.select("sec", identity_flags(names).alias("flags"), end_known(names).alias("end_known"))
    filed = filing_lags(filings).withColumnRenamed("n", "statements")
    nil = {"days": 0, "statements": 0, "with_accepted": 0, "weird": ""}
    return own.join(match, "sec", "left").join(filed, "sec", "left").fillna(nil)


def vendor_exit_summary(gates: DataFrame, least: float = 95.0) -> DataFrame:
    """gate, passed, of_ from the rows of `vendor_exit`: four rows, each gate over
    the names that it applies to."""
    some = F.col("statements") > 0
    sums = gates.agg(
        F.count_if(F.col("flags") == "").alias("p1"), F.count("*").alias("o1"),
        F.count_if(F.col("match_pct") >= least).alias("p2"), F.count("match_pct").alias("o2"),
        F.count_if(some & (F.col("with_accepted") == F.col("statements"))).alias("p3"), F.count_if(some).alias("o3"),
        F.count_if(F.col("end_known") != RUNGS[-1]).alias("p4"), F.count("end_known").alias("o4"),
    )
    each = zip(("identity", "returns", "statements", "delisting"), range(1, 5))
    return sums.select(F.inline(F.array(*[F.struct(F.lit(g).alias("gate"), F.col(f"p{i}").alias("passed"), F.col(f"o{i}").alias("of_")) for g, i in each])))
