"""A table with a unique key that takes batches without being rewritten.

The base is bucketed and sorted by key. A batch is written as a delta of its own,
bucketed alike, so an upsert shuffles the batch and doesn't read the base; insert
or ignore reads the base's key column, where it lies. Reading leaves out of the
base what deltas have and adds the newest of theirs: the join is by bucket, and
the base isn't shuffled. ``compact`` makes a new base of what is read.

Tables are named ``<name>_g<generation>`` and ``..._d<number>`` in the session's
catalogue, which is all the state there is; a batch that was written in part and
failed has no table and is written again. There is one writer at a time.

Defined results: of several rows of a key in a batch the first by ``order`` (or
by all columns) counts; rows without key are left out, as no key finds them; an
empty batch changes nothing.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.scratch import scratch_path


class KeyedTable:
    def __init__(self, spark: SparkSession, name: str, key: str, buckets: int | None = None):
        self.spark, self.name, self.key = spark, name.lower(), key
        self.buckets = buckets or spark.sparkContext.defaultParallelism

    def _generation(self) -> tuple[str, list[str]]:
        """The newest base and its deltas, the oldest first."""
        found = [re.fullmatch(rf"({self.name}_g(\d+))(_d\d+)?", t.name) for t in self.spark.catalog.listTables(pattern=f"{self.name}_g*")]
        newest = max((m for m in found if m and not m[3]), key=lambda m: int(m[2]))[1]
        return newest, sorted(m[0] for m in found if m and m[1] == newest and m[3])

    def _write(self, rows: DataFrame, table: str) -> None:
        out = rows.repartition(self.buckets, self.key).write.bucketBy(self.buckets, self.key).sortBy(self.key)
        out.format("parquet").option("path", scratch_path(self.spark, table)).saveAsTable(table)

    def _once(self, rows: DataFrame, order: list[Column | str]) -> DataFrame:
        w = Window.partitionBy(self.key).orderBy(*(order or rows.columns))
        return rows.filter(F.col(self.key).isNotNull()).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")

    def create(self, rows: DataFrame, order: list[Column | str] = ()) -> KeyedTable:
        self._write(self._once(rows, order), f"{self.name}_g{0:04}")
        return self

    def upsert(self, batch: DataFrame, order: list[Column | str] = ()) -> None:
        base, deltas = self._generation()
        self._write(self._once(batch.select(*self.spark.table(base).columns), order), f"{base}_d{len(deltas):06}")

    def insert_new(self, batch: DataFrame, order: list[Column | str] = ()) -> None:
        """Insert or ignore. Only keys are read of what is there."""
        base, deltas = self._generation()
        new = self._once(batch.select(*self.spark.table(base).columns), order)
        for t in (base, *deltas):
            new = new.join(self.spark.table(t).select(self.key).hint("merge"), self.key, "left_anti")
        self._write(new, f"{base}_d{len(deltas):06}")

    def read(self) -> DataFrame:
        base, deltas = self._generation()
        rows = self.spark.table(base)
        if not deltas:
            return rows
        if len(deltas) == 1:
            newest = self.spark.table(deltas[0])
        else:
            each = reduce(DataFrame.unionByName, [self.spark.table(t).withColumn("_d", F.lit(i)) for i, t in enumerate(deltas)])
            w = Window.partitionBy(self.key).orderBy(F.desc("_d"))
            newest = each.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_d")
        return rows.join(newest.select(self.key).hint("merge"), self.key, "left_anti").unionByName(newest)

    def compact(self) -> None:
        base, deltas = self._generation()
        self._write(self.read(), f"{self.name}_g{int(base[-4:]) + 1:04}")
        for t in (*deltas, base):
            self.spark.sql(f"DROP TABLE {t}")

    def drop(self) -> None:
        for t in self.spark.catalog.listTables(pattern=f"{self.name}_g*"):
            self.spark.sql(f"DROP TABLE IF EXISTS {t.name}")
