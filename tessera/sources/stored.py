"""Derived tables that a session writes once and every query reads.

``@stored(*by)`` turns a function of (spark, sf_dir) that derives a table into
one that writes it on first use, as Parquet bucketed by ``by`` in the shared
folder, and reads it from then on. The number of buckets grows with the input. A window or join by that key (or by more
columns with it) then needs no shuffle, and a query plans a scan where it would
plan the whole derivation again. Tables are kept by application, function and
input, and written anew if a file of the input has changed.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.scratch import scratch_path

#: Input tables that stored tables derive from.
INPUTS = ("lineitem", "orders", "supplier")
_kept: dict[tuple, tuple[tuple, str]] = {}


#: Bytes of the input that a bucket stands for, where that makes more of them than there are cores.
BUCKET_BYTES = 64 << 20


def stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Number, bytes and a digest of path, size and time of the input's files.
    Their contents are not read, and one row comes back whatever their number."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{sf_dir}/{t}.parquet" for t in INPUTS])
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return tuple(files.agg(F.count("path"), F.sum("length"), F.sum(each)).first())


def stored(*by: str) -> Callable:
    def keeper(derive: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        @functools.wraps(derive)
        def read(spark: SparkSession, sf_dir: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, derive.__module__, derive.__name__, sf_dir)
            now = stamp(spark, sf_dir)
            if key not in _kept or _kept[key][0] != now:
                forget(spark, key)
                _kept[key] = (now, _written(derive(spark, sf_dir), derive.__name__, by, now[1] or 0))
            return spark.table(_kept[key][1])

        return read

    return keeper


def _written(rows: DataFrame, name: str, by: tuple[str, ...], input_bytes: int) -> str:
    spark = rows.sparkSession
    table = f"tessera_{name}_{uuid.uuid4().hex}"
    if not by:
        out = rows.coalesce(1).write  # a row a month or so
    else:
        n = max(spark.sparkContext.defaultParallelism, -(-input_bytes // BUCKET_BYTES))
        out = rows.repartition(n, *by).write.bucketBy(n, *by)  # each bucket is one file of one task
    out.format("parquet").option("path", scratch_path(spark, name)).saveAsTable(table)
    return table


def forget(spark: SparkSession, key: tuple | None = None) -> None:
    """Drops a stored table, or all of them."""
    for k in [key] if key else list(_kept):
        if k in _kept:
            spark.sql(f"DROP TABLE IF EXISTS {_kept.pop(k)[1]}")
