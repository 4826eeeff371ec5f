"""Statistics as column expressions, and the few that need NumPy per group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Coefficients of Wichura's algorithm AS241, PPND16 (fixed values, published).
AS241 = {
    "centre": (
        (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
        (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
    ),
    "middle": (
        (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
        (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
    ),
    "tail": (
        (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
        (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
    ),
}


def _ratio(part: str, x: Column) -> Column:
    def horner(c: Sequence[float]) -> Column:
        out = F.lit(c[-1])
        for v in reversed(c[:-1]):
            out = out * x + F.lit(v)
        return out

    return horner(AS241[part][0]) / horner(AS241[part][1])


def probit(p: Column) -> Column:
    """The inverse of the normal distribution function, null outside (0, 1)."""
    q = p - 0.5
    r = F.sqrt(-F.ln(F.when(q < 0, p).otherwise(1 - p)))
    tail = F.when(r <= 5, _ratio("middle", r - 1.6)).otherwise(_ratio("tail", r - 5))
    x = F.when(F.abs(q) <= 0.425, q * _ratio("centre", 0.180625 - q * q)).otherwise(F.when(q < 0, -tail).otherwise(tail))
    return F.when((p > 0) & (p < 1), x)


def probit_sql(p: str) -> str:
    """The same in SQL over the expression p."""

    def ratio(part: str, x: str) -> str:
        def horner(c):
            out = f"{c[-1]!r}::DOUBLE"
            for v in reversed(c[:-1]):
                out = f"(({out}) * ({x}) + {v!r}::DOUBLE)"
            return out

        return f"({horner(AS241[part][0])} / {horner(AS241[part][1])})"

    q = f"(({p}) - 0.5::DOUBLE)"
    r = f"sqrt(-ln(CASE WHEN {q} < 0 THEN ({p}) ELSE 1 - ({p}) END))"
    tail = f"(CASE WHEN {r} <= 5 THEN {ratio('middle', f'({r} - 1.6::DOUBLE)')} ELSE {ratio('tail', f'({r} - 5)')} END)"
    return f"(CASE WHEN ({p}) > 0 AND ({p}) < 1 THEN CASE WHEN abs({q}) <= 0.425 THEN {q} * {ratio('centre', f'(0.180625::DOUBLE - {q} * {q})')} WHEN {q} < 0 THEN -{tail} ELSE {tail} END END)"


def winsorized(x: Column, by: list[str], low: float = 0.01, high: float = 0.99) -> Column:
    """x clipped to interpolated quantiles of its group."""
    w = Window.partitionBy(*by)
    return F.greatest(F.percentile(x, F.lit(low)).over(w), F.least(F.percentile(x, F.lit(high)).over(w), x))


def average_rank(x: Column, by: list[str]) -> Column:
    """Ranks from 1, ties sharing their mean; one window has both."""
    w = Window.partitionBy(*by).orderBy(x)
    ties = F.count(x).over(w.rangeBetween(Window.currentRow, Window.currentRow))
    return F.when(x.isNotNull(), F.rank().over(w) + (ties - 1).cast("double") / 2)


def standardised(x: Column, by: list[str], floor: float = 1e-9) -> Column:
    """x less its group's mean, over its population deviation where that is not nil."""
    w = Window.partitionBy(*by)
    centred = x - F.avg(x).over(w)
    sd = F.stddev_pop(x).over(w)
    return F.when(sd > floor, centred / sd).otherwise(centred)


def correlation(x: str | Column, y: str | Column, floor: float = 1e-9) -> Column:
    """Pearson correlation of the pairs that have both values; null where one of
    them doesn't vary, or by rounding only."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    sa, sb = F.stddev_pop(a), F.stddev_pop(b)
    return F.when((sa > floor) & (sb > floor), F.covar_pop(a, b) / (sa * sb))


def newey_west(df: DataFrame, value: str, order: str, by: list[str], lags: int = 3) -> DataFrame:
    """by, n, mean, t: the t statistic of a series' mean with Bartlett weights.

    Lag products are windows over each series; no series is gathered.
    """
    g = Window.partitionBy(*by)
    o = g.orderBy(order)
    rows = df.filter(F.col(value).isNotNull()).withColumn("e", F.col(value) - F.avg(value).over(g))
    products = [F.coalesce(F.sum(F.col("e") * F.col(f"l{j}")), F.lit(0.0)) * (2 * (1 - j / (lags + 1))) for j in range(1, lags + 1)]
    for j in range(1, lags + 1):
        rows = rows.withColumn(f"l{j}", F.lag("e", j).over(o))
    total = F.sum(F.col("e") * F.col("e"))
    for p in products:
        total = total + p
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), total.alias("s"))
    se = F.sqrt(F.greatest(F.col("s"), F.lit(0.0))) / F.col("n")
    return out.select(*by, "n", "mean", F.when(se > 1e-15, F.col("mean") / se).alias("t"))


def grouped_ols(df: DataFrame, y: str, xs: list[str], by: str, minimum: int, floor: float = 1e-9) -> DataFrame:
    """by, term, beta, n: least squares with an intercept in each group on
    regressors standardised there; rows without all values are left out. A
    regressor that doesn't vary, or that those before it explain, has slope nil.

    Groups are reduced to sums of products, which combine before the shuffle, so
    no group is gathered; what NumPy solves is one small system a group.
    """
    if by == "term":
        raise ValueError("the group column can't be called term")
    k, kind = len(xs), dict(df.dtypes)[by]
    rows = df.select(by, y, *xs).dropna()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    scaled = {x: F.stddev_pop(x) for x in xs}
    sums = [F.covar_pop(xs[i], xs[j]) for i, j in pairs] + [F.covar_pop(x, y) for x in xs]
    g = rows.groupBy(by).agg(F.count("*").alias("n"), F.avg(y).alias("mean"), F.array(*sums).alias("cov"), F.array(*scaled.values()).alias("sd"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, n, mean, cov, sd in pdf.itertuples(index=False):
                c, r, sd = np.zeros((k, k)), np.array(cov[len(pairs) :], float), np.array(sd, float)
                for (i, j), v in zip(pairs, cov):
                    c[i, j] = c[j, i] = v
                varies = sd > floor
                sd = np.where(varies, sd, 1.0)
                beta = eliminated(np.where(np.outer(varies, varies), c / np.outer(sd, sd), 0.0), np.where(varies, r / sd, 0.0), floor)
                out += [(key, t, b, n) for t, b in zip(["intercept", *xs], [mean, *beta])]
            yield pd.DataFrame(out, columns=[by, "term", "beta", "n"])

    few = g.filter(F.col("n") >= minimum)
    return few.select(by, "n", "mean", "cov", "sd").mapInPandas(solve, f"{by} {kind}, term string, beta double, n long")


def eliminated(a: np.ndarray, b: np.ndarray, floor: float) -> np.ndarray:
    """The solution of a x = b by elimination in the order of the rows; x is nil
    where nothing is left of a row."""
    m = np.column_stack([a, b]).astype(float)
    for s in range(len(a)):
        pivot = m[s, s]
        if pivot <= floor:
            m[s] = 0.0
            continue
        m[s] /= pivot
        others = np.arange(len(a)) != s
        m[others] -= np.outer(m[others, s], m[s])
    return m[:, -1]


def block_bootstrap(df: DataFrame, value: str, order: str, by: str, block: int = 6, draws: int = 2000, seed: int = 20260726, low: float = 0.025, high: float = 0.975) -> DataFrame:
    """by, n, low, high: circular block bootstrap interval of a series' mean.

    A draw takes n // block + 1 blocks and of the last one what is left to n
    values. Where block j of a draw starts is a digest of seed, series, draw and
    j, so draws don't depend on who makes them; a block's sum is the difference
    of two running sums. A series has a value a month: its row holds them all.
    """
    o = Window.partitionBy(by).orderBy(order)
    rows = df.select(by, order, value).dropna().withColumn("i", F.row_number().over(o) - 1).withColumn("n", F.count("*").over(Window.partitionBy(by)))
    # the series over and over, as far as a block reaches beyond its end
    again = rows.select(by, "n", value, F.explode(F.expr(f"transform(sequence(0, cast(ceil({block} / n) as int)), k -> i + k * n)")).alias("i"))
    before = F.coalesce(F.sum(value).over(Window.partitionBy(by).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    one = again.select(by, "n", F.struct("i", before.alias("p")).alias("x")).groupBy(by, "n").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["p"]).alias("p"))
    drawn = one.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))

    def part(j: Column) -> Column:
        name = F.concat_ws(":", F.lit(str(seed)), F.col(by).cast("string"), F.col("draw").cast("string"), j.cast("string"))
        start = (F.conv(F.substring(F.md5(F.encode(name, "UTF-8")), 1, 13), 16, 10).cast("long") % F.col("n")).cast("int")
        size = F.least(F.lit(block), F.col("n").cast("int") - j * block)
        return F.transform(F.array(start), lambda s: F.get("p", s + size) - F.get("p", s))[0]

    total = F.aggregate(F.sequence(F.lit(0), F.floor(F.col("n") / block).cast("int")), F.lit(0.0), lambda acc, j: acc + part(j))
    means = drawn.select(by, "n", (total / F.col("n")).alias("mean"))
    return means.groupBy(by, "n").agg(F.percentile("mean", F.lit(low)).alias("low"), F.percentile("mean", F.lit(high)).alias("high"))


def average_linkage(pairs: DataFrame, cuts: list[float]) -> DataFrame:
    """cut, cluster, members: clusters of the names in pairs (a, b, distance; a
    pair that is absent is 1 apart) by average linkage, merged while closer than
    each cut; of equally close ones those named first.

    The names are a few dozen signals, so the matrix is an array in one row. A
    fold over it merges two clusters a step: the distance to the merged one is
    the mean of those to its parts by their sizes (Lance and Williams).
    """
    cells = F.array_sort(F.collect_set(F.struct("a", "b", "distance")))
    row = pairs.agg(cells.alias("cells"), F.array_sort(F.array_union(F.collect_set("a"), F.collect_set("b"))).alias("names"))
    row = row.withColumn("k", F.size("names")).withColumn("of", F.map_from_entries(F.transform("cells", lambda c: F.struct(F.concat_ws("\n", c["a"], c["b"]), c["distance"]))))
    at = lambda x: F.get("names", x.cast("int"))
    known = lambda i, j: F.coalesce(F.try_element_at("of", F.concat_ws("\n", at(i), at(j))), F.try_element_at("of", F.concat_ws("\n", at(j), at(i))), F.lit(1.0))
    every = F.sequence(F.lit(0), F.col("k") * F.col("k") - 1)
    row_of, col_of = (lambda p: F.floor(p / F.col("k")).cast("int")), (lambda p: (p % F.col("k")).cast("int"))
    row = row.filter("k > 0").withColumn("d", F.transform(every, lambda p: F.when(row_of(p) == col_of(p), F.lit(float("inf"))).otherwise(known(row_of(p), col_of(p)))))
    row = row.withColumn("cut", F.explode(F.array(*[F.lit(c) for c in cuts])))
    once = lambda v, body: F.transform(F.array(v), body)[0]

    def merged(acc: Column, i: Column, j: Column) -> Column:
        ni, nj = F.get(acc["n"], i), F.get(acc["n"], j)

        def cell(v: Column, p: Column) -> Column:
            r, c = row_of(p), col_of(p)
            other = F.when(r == i, c).otherwise(r)
            mean = (F.get(acc["d"], i * F.col("k") + other) * ni + F.get(acc["d"], j * F.col("k") + other) * nj) / (ni + nj)
            return F.when((r == j) | (c == j) | (r == c), F.lit(float("inf"))).when((r == i) | (c == i), mean).otherwise(v)

        sizes = F.transform(acc["n"], lambda v, x: F.when(x == i, ni + nj).otherwise(v))
        labels = F.transform(acc["to"], lambda t: F.when(t == j, i).otherwise(t))
        return F.struct(F.transform(acc["d"], cell).alias("d"), sizes.alias("n"), labels.alias("to"))

    def step(acc: Column, _: Column) -> Column:
        least = F.array_min(F.transform(acc["d"], lambda v, p: F.struct(v.alias("v"), p.alias("p"))))
        return once(least, lambda m: F.when(m["v"] <= F.col("cut"), merged(acc, row_of(m["p"]), col_of(m["p"]))).otherwise(acc))

    ids = F.sequence(F.lit(0), F.col("k") - 1)
    start = F.struct(F.col("d").alias("d"), F.transform(ids, lambda _: F.lit(1)).alias("n"), ids.alias("to"))
    rows = row.select("cut", "names", F.aggregate(ids, start, step, lambda acc: acc["to"]).alias("to"))
    groups = F.array_sort(F.transform(F.array_distinct("to"), lambda g: F.array_join(F.filter("names", lambda _, i: F.get("to", i) == g), ",")))
    return rows.select("cut", F.posexplode(groups).alias("cluster", "members"))


#: Coefficients of Hart's algorithm 5666 for the upper tail of the normal distribution (fixed values, published).
HART = (
    (220.206867912376, 221.213596169931, 112.079291497871, 33.912866078383, 6.37396220353165, 0.700383064443688, 0.0352624965998911),
    (440.413735824752, 793.826512519948, 637.333633378831, 296.564248779674, 86.7807322029461, 16.064177579207, 1.75566716318264, 0.0883883476483184),
)


def two_sided_p(t: Column) -> Column:
    """The probability of a normal value at least as far from nil as t."""
    z = F.abs(t)

    def horner(c: Sequence[float]) -> Column:
        out = F.lit(c[-1])
        for v in reversed(c[:-1]):
            out = out * z + F.lit(v)
        return out

    far = z + 0.65
    for k in (4.0, 3.0, 2.0, 1.0):
        far = z + F.lit(k) / far
    near = horner(HART[0]) / horner(HART[1])
    return 2 * F.exp(-z * z / 2) * F.when(z < 7.07106781186547, near).otherwise(1 / (far * 2.506628274631))


def two_sided_p_sql(t: str) -> str:
    """The same in SQL over the expression t."""

    def horner(c):
        out = f"{c[-1]!r}::DOUBLE"
        for v in reversed(c[:-1]):
            out = f"(({out}) * abs({t}) + {v!r}::DOUBLE)"
        return out

    far = f"(abs({t}) + 0.65::DOUBLE)"
    for k in (4, 3, 2, 1):
        far = f"(abs({t}) + {k} / {far})"
    return f"(2 * exp(-({t}) * ({t}) / 2) * CASE WHEN abs({t}) < 7.07106781186547::DOUBLE THEN {horner(HART[0])} / {horner(HART[1])} ELSE 1 / ({far} * 2.506628274631::DOUBLE) END)"


def benjamini_hochberg(tests: DataFrame, family: str, p: str, tie: str) -> DataFrame:
    """tests + q: the least false discovery rate at which a test of its family is
    rejected, by the step-up rule. A test without p isn't counted and has no q."""
    w = Window.partitionBy(family, F.col(p).isNull())
    up = w.orderBy(p, tie)
    rows = tests.withColumn("_r", F.row_number().over(up)).withColumn("_m", F.count(p).over(w))
    rows = rows.withColumn("_x", F.col(p) * F.col("_m") / F.col("_r"))
    least = F.min("_x").over(w.orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("q", F.least(least, F.when(F.col(p).isNotNull(), 1.0))).drop("_r", "_m", "_x")
