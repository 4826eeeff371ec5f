"""Writing tables: keys that Spark doesn't enforce are kept by the writer.

Each function returns the rows that belong in the table, or writes them; a job
that runs twice leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ID_BUCKETS = 4096


def only_new(existing: DataFrame, new: DataFrame, key: list[str], order: list[Column | str] = ()) -> DataFrame:
    """Insert or ignore: rows of new whose key isn't there, one a key."""
    w = Window.partitionBy(*key).orderBy(*(order or key))
    once = new.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return once.join(existing.select(*key).distinct(), key, "left_anti")


def upserted(existing: DataFrame, new: DataFrame, key: list[str], order: list[Column | str] = ()) -> DataFrame:
    """existing with the rows of new put over those of the same key; of several
    new rows of a key the first by order counts. One shuffle by key."""
    tagged = new.select(*existing.columns, F.lit(0).alias("_old")).unionByName(existing.withColumn("_old", F.lit(1)))
    w = Window.partitionBy(*key).orderBy("_old", *(order or key))
    return tagged.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_old")


def with_ids(rows: DataFrame, key: str, name: str = "id") -> DataFrame:
    """rows (one a key) numbered from 1 without gaps, by digest and key: numbers
    are given within buckets of the key's digest, and each bucket begins where
    those before it end, so that no task orders all rows."""
    bucket = F.substring(F.md5(F.encode(F.col(key).cast("string"), "UTF-8")), 1, 3)
    dealt = rows.withColumn("_b", bucket)
    sizes = dealt.groupBy("_b").count()  # at most ID_BUCKETS rows
    begin = F.coalesce(F.sum("count").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_b", begin.alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_b").orderBy(key))
    return dealt.withColumn("_nth", nth).join(F.broadcast(starts), "_b").withColumn(name, F.col("_start") + F.col("_nth")).drop("_b", "_nth", "_start")


def rebuild(df: DataFrame, path: str) -> None:
    """Delete and rebuild the whole table."""
    df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Rebuilds only those partitions that df has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
