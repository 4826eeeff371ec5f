"""The incremental loop: idempotent claims, bounded lateness, appended vintages.

Each step may run twice: a stream's checkpoint names its batches, a batch writes
under its own number, and what is there already is left out by an anti-join.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.predicates import iso_week
from tessera.sources.tables import upserted

STALE_AFTER = "INTERVAL 6 HOURS"


def once_within(stream: DataFrame, time: str, key: list[str], lateness: str) -> DataFrame:
    """Rows of a stream, each key once within the time that events may be late."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(key)


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Works off what is there in numbered batches, then returns."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def replayed(each: Callable[[DataFrame, int], None], lost: tuple[type[Exception], ...] = (ConnectionError,), tries: int = 3, wait: float = 2.0) -> Callable[[DataFrame, int], None]:
    """each, for `run_available`, with a batch run again whose connection is
    lost: up to so many times in all, after wait seconds, then twice that, and so
    on. The last loss, and any other error, is raised and fails the stream, which
    begins with that batch when it is started anew.

    A batch that is lost halfway is written in part, so each has to write under
    the batch's number and over what is there, as `by_number` does.
    """

    def run(batch: DataFrame, number: int) -> None:
        for nth in range(1, tries + 1):
            try:
                return each(batch, number)
            except lost:
                if nth == tries:
                    raise
                time.sleep(wait * nth)

    return run


def by_number(path: str) -> Callable[[DataFrame, int], None]:
    """Writes each batch to a folder of its number, over what an earlier run of
    that batch has left there."""
    return lambda batch, number: batch.write.parquet(f"{path}/batch={number}", mode="overwrite")


def later_rows(stored: DataFrame, new: DataFrame, key: str, time: str) -> DataFrame:
    """Rows of new that are later than the last stored one of their key; keys
    that nothing is stored of are left to a backfill."""
    last = stored.groupBy(key).agg(F.max(time).alias("_last"))
    return new.join(last, key).filter(F.col(time) > F.col("_last")).drop("_last")


def new_vintages(existing: DataFrame, feed: DataFrame, key: list[str], hash_col: str) -> DataFrame:
    """Rows of feed that differ from the latest vintage of their key, with the
    next vintage_id; 1 where the key is new. One row a key in feed."""
    latest = existing.groupBy(*key).agg(F.max(F.struct("vintage_id", F.col(hash_col).alias("h"))).alias("_x"))
    rows = feed.join(latest, key, "left").filter(~F.col(hash_col).eqNullSafe(F.col("_x.h")))
    return rows.withColumn("vintage_id", (F.coalesce("_x.vintage_id", F.lit(0)) + 1).cast("int")).drop("_x")


def due(clock: DataFrame, now: str = "now") -> DataFrame:
    """(now, job, period) of what each time of a clock in UTC calls for: daily
    from 23:00 on weekdays, weekly from 12:00 on Saturdays, monthly from 13:00 on
    every day from the second on, so that a month that was missed is made up for.

    What is run, and when, is left to an outside scheduler; this tells it what
    to ask for.
    """
    t = F.col(now)
    day, hour = F.weekday(t), F.hour(t)  # Monday is 0
    rules = {
        "daily": ((day < 5) & (hour >= 23), F.date_format(t, "yyyy-MM-dd")),
        "weekly": ((day == 5) & (hour >= 12), iso_week(t)),
        "monthly": ((F.dayofmonth(t) >= 2) & (hour >= 13), F.date_format(t, "yyyy-MM")),
    }
    each = F.array(*[F.when(rule, F.struct(F.lit(job).alias("job"), period.alias("period"))) for job, (rule, period) in rules.items()])
    return clock.select(t.alias("now"), F.explode(F.array_compact(each)).alias("x")).select("now", "x.*")


def claimable(asked: DataFrame, log: DataFrame) -> DataFrame:
    """The earliest asking (job, period, now) of each period that may run: none is
    logged for it, or only a ``running`` row that is older than STALE_AFTER. A
    period that ended, well or not, isn't run again.

    log: job, period, status, ran_at; a row a period.
    """
    first = asked.groupBy("job", "period").agg(F.min("now").alias("now"))
    held = log.select("job", "period", "status", "ran_at")
    rows = first.join(held, ["job", "period"], "left")
    stale = (F.col("status") == "running") & (F.col("ran_at") < F.col("now") - F.expr(STALE_AFTER))
    return rows.filter(F.col("status").isNull() | stale).select("job", "period", "now")


def recorded(log: DataFrame, claims: DataFrame, status: str, detail: Column) -> DataFrame:
    """log with the claims' rows put in their new status (upsert by period)."""
    new = claims.select("job", "period", F.lit(status).alias("status"), F.col("now").alias("ran_at"), detail.alias("detail"))
    return upserted(log, new.select(*log.columns), ["job", "period"])


def topped_up(stored: DataFrame, daily: DataFrame, today: Column, days: int = 45) -> DataFrame:
    """stored (as_of, sec, mktcap) with the last value of each month put over it
    that the daily feed (sec, d, mktcap) has within so many days of today."""
    late = daily.filter((F.col("d") >= F.date_sub(today, days)) & (F.col("mktcap") > 0))
    last = late.groupBy("sec", F.trunc("d", "MM").alias("m")).agg(F.max(F.struct(F.col("d").alias("as_of"), "mktcap")).alias("x"))
    return upserted(stored, last.select("x.as_of", "sec", "x.mktcap").select(*stored.columns), ["as_of", "sec"])
