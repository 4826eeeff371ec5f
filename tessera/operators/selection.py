"""Exact order statistics without an exact sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.scratch import checkpointed

BINS = 4096


def discrete_percentiles(rows: DataFrame, value: str, shares: dict[str, float], by: list[str] = (), bins: int = BINS) -> DataFrame:
    """by, n and a column a share: the least value that so large a share of the
    group's values doesn't exceed.

    By passes of selection: the values between a group's bounds fall into
    ``bins`` bins of one width, and the bin that holds the wanted rank gives the
    bounds of the next pass, until they are one value. A pass combines counts
    before the shuffle and moves ``bins`` rows a group and share at most, so no
    task holds or sorts a group's values, however many are different. Its number
    of passes is that of digits, base ``bins``, by which neighbours differ.

    Nulls aren't counted; a group of nothing else has n nil and no values; values
    must be finite. Without ``by`` there is one group, empty or not.
    """
    x = F.col(value).cast("double")
    data = rows.select(*by, x.alias("_x"))
    sizes = checkpointed(data.groupBy(*by).agg(F.count("_x").alias("n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("share"), F.lit(float(p)).alias("p")) for k, p in shares.items()]))
    wanted = sizes.filter("n > 0").select(*by, "n", "_lo", "_hi", each.alias("s"))
    wanted = wanted.select(*by, F.col("s.share").alias("share"), "_lo", "_hi", F.greatest(F.ceil(F.col("s.p") * F.col("n")), F.lit(1)).alias("_rank"))
    found = []
    while True:
        wanted = checkpointed(wanted)
        found.append(wanted.filter("_lo = _hi").select(*by, "share", F.col("_lo").alias("v")))
        wanted = wanted.filter("_lo < _hi")
        if wanted.isEmpty():
            break
        # halves, so that no difference of two doubles overflows; every step keeps the order of values
        place = F.floor((F.col("_x") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2) * (bins - 1))
        inside = _met(data, wanted, by)
        counted = inside.filter(F.col("_x").between(F.col("_lo"), F.col("_hi"))).groupBy(*by, "share", "_rank", place.alias("_bin"))
        counted = counted.agg(F.count("*").alias("_c"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        upto = F.sum("_c").over(Window.partitionBy(*by, "share").orderBy("_bin"))
        here = counted.withColumn("_upto", upto).filter((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_c") < F.col("_rank")))
        wanted = here.select(*by, "share", "_lo", "_hi", (F.col("_rank") - F.col("_upto") + F.col("_c")).alias("_rank"))
    values = found[0]
    for f in found[1:]:
        values = values.unionByName(f)
    wide = values.groupBy(*by).agg(*[F.max(F.when(F.col("share") == k, F.col("v"))).alias(k) for k in shares])
    return _met(sizes.select(*by, "n"), wide, by, "left").select(*by, "n", *shares)


def _met(rows: DataFrame, small: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """rows with those of small of the same group, null being one; without groups
    small is a row a share at most."""
    if not by:
        return rows.join(F.broadcast(small), how=how)
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return rows.join(small.withColumnsRenamed({c: f"_of_{c}" for c in by}), same, how).drop(*[f"_of_{c}" for c in by])
