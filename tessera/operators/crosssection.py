"""Standardising and evaluating signals on monthly cross-sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.stats import average_rank, correlation, newey_west, probit, standardised, winsorized


def covered(values: DataFrame, members: DataFrame, least: float = 0.6, without_financials: list[str] = ()) -> DataFrame:
    """values of those (as_of, factor) that enough of the eligible members have."""
    size = members.groupBy("as_of").agg(F.count("*").alias("n_all"), F.count_if(~F.col("is_fin")).alias("n_nonfin"))
    base = F.when(F.col("factor").isin(list(without_financials)), F.col("n_nonfin")).otherwise(F.col("n_all"))
    n = values.groupBy("as_of", "factor").agg(F.count("value").alias("n")).join(size, "as_of").filter(F.col("n") >= least * base)
    return values.join(F.broadcast(n.select("as_of", "factor")), ["as_of", "factor"], "left_semi")  # a row a month and factor of the registry


def standardise(values: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """values (as_of, factor, sec, value, sector, mktcap) + rank_norm, z_sector,
    z_sector_size: winsorised, ranked with mean ties, mapped to normal scores,
    freed of sector means and of log size. Windows only, and few of them: each
    holds rows of a large group in memory that it can't hand to the others of its
    task."""
    by = ["as_of", "factor"]
    group, sector = Window.partitionBy(*by), Window.partitionBy(*by, "sector")
    rows = values.withColumn("w", winsorized(F.col("value"), by, low, high))
    rows = rows.withColumns({"rank": average_rank(F.col("w"), by), "n": F.count("w").over(group.orderBy("w").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    rows = rows.withColumn("rank_norm", probit(F.col("rank") / (F.col("n") + 1)))
    size = F.ln("mktcap")
    rows = rows.withColumns({"dz": F.col("rank_norm") - F.avg("rank_norm").over(sector), "x": size - F.avg(size).over(sector)})
    rows = rows.withColumns({"sd": F.stddev_pop("dz").over(group), "dzx": F.sum(F.col("dz") * F.col("x")).over(group), "xx": F.sum(F.col("x") * F.col("x")).over(group)})
    unit = F.when(F.col("sd") > 1e-9, F.col("sd")).otherwise(1.0)
    rows = rows.withColumn("z_sector", F.col("dz") / unit)
    rows = rows.withColumn("rz", F.col("z_sector") - F.col("dzx") / unit / F.greatest("xx", F.lit(1e-12)) * F.col("x"))
    return rows.withColumn("z_sector_size", standardised(F.col("rz"), by)).drop("rz", "dz", "x", "rank", "w", "n", "sd", "dzx", "xx")


def ordinal(x: Column, by: list[str], tie: str = "sec") -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(x, tie))


def rank_ic(pairs: DataFrame, by: list[str], signal: str, outcome: str, minimum: int) -> DataFrame:
    """by, ic, n: rank correlation with ties in order of sec."""
    rows = pairs.dropna(subset=[signal, outcome])
    rows = rows.withColumn("ra", ordinal(F.col(signal), by)).withColumn("rb", ordinal(F.col(outcome), by))
    return rows.groupBy(*by).agg(correlation("ra", "rb").alias("ic"), F.count("*").alias("n")).filter(F.col("n") >= minimum)


def quantile_spread(pairs: DataFrame, by: list[str], signal: str, outcome: str, minimum: int, tail: float = 0.1) -> DataFrame:
    """by, top, bottom, ls, n: mean outcome beyond the signal's quantiles, both
    inclusive, so that ties widen a tail."""
    rows = pairs.dropna(subset=[signal, outcome])
    w = Window.partitionBy(*by)
    rows = rows.withColumn("hi", F.percentile(signal, F.lit(1 - tail)).over(w)).withColumn("lo", F.percentile(signal, F.lit(tail)).over(w))
    g = rows.groupBy(*by).agg(F.avg(F.when(F.col(signal) >= F.col("hi"), F.col(outcome))).alias("top"), F.avg(F.when(F.col(signal) <= F.col("lo"), F.col(outcome))).alias("bottom"), F.count("*").alias("n"))
    return g.filter(F.col("n") >= minimum).withColumn("ls", F.col("top") - F.col("bottom"))


def counted_spread(pairs: DataFrame, by: list[str], signal: str, outcome: str, minimum: int, parts: int = 10) -> DataFrame:
    """by, top, bottom, ls, n: mean outcome of the n // parts names at each end."""
    rows = pairs.dropna(subset=[signal, outcome])
    rows = rows.withColumn("nth", ordinal(F.col(signal), by)).withColumn("n", F.count("*").over(Window.partitionBy(*by)))
    k = F.greatest(F.floor(F.col("n") / parts), F.lit(1))
    g = rows.filter(F.col("n") >= minimum).groupBy(*by).agg(F.avg(F.when(F.col("nth") > F.col("n") - k, F.col(outcome))).alias("top"), F.avg(F.when(F.col("nth") <= k, F.col(outcome))).alias("bottom"), F.first("n").alias("n"))
    return g.withColumn("ls", F.col("top") - F.col("bottom"))


def summary(monthly: DataFrame, by: str, minimum: int = 24) -> DataFrame:
    """by, months, mean_ic, icir, ic_t, ls_ann, ls_t of monthly ic and ls."""
    g = monthly.groupBy(by).agg(F.count("ic").alias("months"), F.avg("ic").alias("mean_ic"), F.stddev_pop("ic").alias("sd"), F.avg("ls").alias("m"))
    t_ic = newey_west(monthly, "ic", "as_of", [by], 0).select(by, F.col("t").alias("ic_t"))
    t_ls = newey_west(monthly, "ls", "as_of", [by], 0).select(by, F.col("t").alias("ls_t"))
    out = g.filter(F.col("months") >= minimum).join(t_ic, by).join(t_ls, by)
    return out.select(by, "months", "mean_ic", F.when(F.col("sd") > 0, F.col("mean_ic") / F.col("sd")).alias("icir"), "ic_t", (12 * F.col("m")).alias("ls_ann"), "ls_t")


def redundancy(cells: DataFrame, signal: str) -> DataFrame:
    """(a, b, rho, months): mean absolute correlation of each pair of factors.
    Factors are pivoted to columns first, so that nothing is joined to itself."""
    names = [r[0] for r in cells.select("factor").distinct().orderBy("factor").collect()]  # the registry: a dozen
    if len(names) < 2:
        return cells.sparkSession.createDataFrame([], "a string, b string, rho double, months long")
    wide = cells.groupBy("as_of", "sec").pivot("factor", names).agg(F.first(signal))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    g = wide.groupBy("as_of").agg(*[correlation(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = g.select("as_of", F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.abs(F.col(f"`{a}|{b}`")).alias("r")) for a, b in pairs])).alias("x")).select("as_of", "x.*")
    return long.filter("r IS NOT NULL").groupBy("a", "b").agg(F.avg("r").alias("rho"), F.count("*").alias("months"))


def composite(cells: DataFrame, signs: dict[str, int], signal: str, least: int, weights: DataFrame | None = None, keep: str | None = None) -> DataFrame:
    """(as_of, sec, score, k): mean of the sign-aligned members a name has, by
    weight if given (as_of, factor, weight), where it has enough of them; nil
    where none of them has any weight. keep: a column that goes with a name."""
    sign = F.coalesce(*[F.when(F.col("factor") == f, F.lit(s)) for f, s in signs.items()])
    rows = cells.filter(F.col("factor").isin(list(signs)) & F.col(signal).isNotNull()).withColumn("z", sign * F.col(signal))
    # a row a month and factor of the registry is broadcast
    rows = rows.withColumn("weight", F.lit(1.0)) if weights is None else rows.join(F.broadcast(weights), ["as_of", "factor"])
    more = [F.first(keep).alias(keep)] if keep else []
    g = rows.groupBy("as_of", "sec").agg(F.sum(F.col("z") * F.col("weight")).alias("s"), F.sum("weight").alias("w"), F.count("*").alias("k"), *more)
    score = F.col("s") / F.when(F.col("w") > 1e-9, F.col("w")).otherwise(1.0)
    return g.filter(F.col("k") >= least).select("as_of", "sec", score.alias("score"), "k", *([keep] if keep else []))


def walk_forward_weights(ics: DataFrame, months: DataFrame, signs: dict[str, int], least: int = 36) -> DataFrame:
    """(as_of, factor, weight) of every member at every month: its mean
    sign-aligned IC over all months strictly before, floored at nil and scaled to
    one; equal weights as long as a member has too short a history, or if all
    are nil. months: as_of; a row a month."""
    members = F.explode(F.array(*[F.struct(F.lit(f).alias("factor"), F.lit(s).alias("sign")) for f, s in signs.items()]))
    every = months.select("as_of", members.alias("x")).select("as_of", "x.*")
    rows = every.join(ics.select("as_of", "factor", "ic"), ["as_of", "factor"], "left").withColumn("ic", F.col("sign") * F.col("ic"))
    w = Window.partitionBy("factor").orderBy("as_of").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("m", F.greatest(F.coalesce(F.avg("ic").over(w), F.lit(0.0)), F.lit(0.0))).withColumn("n", F.count("ic").over(w))
    g = Window.partitionBy("as_of")
    equal = (F.min("n").over(g) < least) | (F.sum("m").over(g) <= 1e-9)
    return rows.select("as_of", "factor", F.when(equal, F.lit(1.0) / len(signs)).otherwise(F.col("m") / F.sum("m").over(g)).alias("weight"))


def equity_curve(monthly: DataFrame, by: str, value: str, order: str = "as_of") -> DataFrame:
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return monthly.withColumn("curve", F.round(F.product(1 + F.col(value)).over(w), 4))


def decay(ics: DataFrame, first: int, floor: float = 1e-9) -> DataFrame:
    """(factor, horizon, months, mean_ic, kept) of monthly (factor, horizon, as_of,
    ic): the mean, and its ratio to that of the first horizon."""
    g = ics.groupBy("factor", "horizon").agg(F.count("ic").alias("months"), F.round(F.avg("ic"), 9).alias("mean_ic"))
    start = F.max(F.when(F.col("horizon") == first, F.col("mean_ic"))).over(Window.partitionBy("factor"))
    return g.withColumn("kept", F.when(F.abs(start) > floor, F.col("mean_ic") / start))
