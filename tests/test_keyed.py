"""Keyed state against the same decisions made by hand, over restarts and replays."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.streaming import keyed

T = dt.datetime(2024, 5, 1)


def run(spark, path, schema, work, out, state):
    with keyed.keyed_store(spark):
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        q = work(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination(300)
        assert q.exception() is None


@pytest.mark.parametrize("runs", [1, 3])
def test_one_runner_gets_a_period(spark, tmp_path, runs):
    rnd, schema = random.Random(runs), "job string, period string, now timestamp_ntz, what string, feed int"
    rows = [("daily", f"p{i % 4}", T + dt.timedelta(minutes=37 * i), "ask", feed) for i in range(60) for feed in (1, 2)]
    rows += [("daily", "p1", T + dt.timedelta(hours=3), "end", 0), ("daily", "p2", T + dt.timedelta(hours=30), "end", 0)]
    want = []
    for p in range(4):
        status, at = None, None
        for _, _, now, what, feed in sorted((r for r in rows if r[1] == f"p{p}"), key=lambda r: (r[2], r[3] != "end", r[4])):
            if what == "end":
                status = "ended" if status == "running" else status
            elif status is None or status == "running" and now - at > dt.timedelta(hours=6):
                status, at = "running", now
                want.append((f"p{p}", now, feed))
    rows.sort(key=lambda r: r[2])
    out, state, path = (str(tmp_path / x) for x in ("out", "state", "in"))
    for k in range(runs):
        part = rows[len(rows) * k // runs : len(rows) * (k + 1) // runs]
        rnd.shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        run(spark, path, schema, keyed.claims, out, state)
    got = spark.read.parquet(out).select("period", F.timestamp_millis("ms").cast("timestamp_ntz").alias("now"), "feed").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    run(spark, path, schema, keyed.claims, out, state)  # nothing new: nothing is claimed
    assert spark.read.parquet(out).count() == len(want)


def test_a_changed_hash_is_one_vintage_over_restarts(spark, tmp_path):
    schema = "k string, ms long, h string"
    feed = [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, None), ("b", 5, None)], [("a", 4, "y"), ("a", 5, "x"), ("b", 6, "z"), ("c", 1, "q")]
    out, state, path = (str(tmp_path / x) for x in ("out", "state", "in"))
    for part in feed:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        run(spark, path, schema, lambda rows: keyed.vintages(rows, F.col("k")), out, state)
    got = sorted((r.key, r.vintage, r.ms, r.h) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1, 1, "x"), ("a", 2, 3, "y"), ("a", 3, 5, "x"), ("b", 1, 1, None), ("b", 2, 6, "z"), ("c", 1, 1, "q")]
