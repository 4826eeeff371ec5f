"""Cross-sections of more names than a window keeps as plain rows, in little memory."""

import os
import subprocess
import sys

SCRIPT = """
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from tessera.operators import crosssection as C

conf = {"spark.driver.memory": "480m", "spark.buffer.pageSize": "32m", "spark.sql.shuffle.partitions": "1", "spark.ui.enabled": "false"}
spark = SparkSession.builder.master("local[1]").config(map=conf).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
sec, k = F.col("id") % 6000, F.floor(F.col("id") / 6000)
values = spark.range(24000).select(
    F.concat(F.lit("m"), k % 2).alias("as_of"), F.concat(F.lit("f"), F.floor(k / 2)).alias("factor"), sec.alias("sec"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("value"),
    (sec % 5).cast("string").alias("sector"), (F.pmod(F.xxhash64(sec), F.lit(10**6)) + 1).cast("double").alias("mktcap"),
)
members = values.filter("factor = 'f0'").select("as_of", "sec", (F.col("sec") % 7 == 0).alias("is_fin"))
z = C.standardise(C.covered(values, members)).groupBy("as_of", "factor").agg(F.count("*").alias("n"), F.avg("z_sector_size").alias("m"), F.stddev_pop("z_sector_size").alias("s"))
print("GROUPS", [(r.n, round(abs(r.m), 6), round(r.s, 6)) for r in z.collect()])
"""


def test_standardising_large_groups_in_few_pages():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    assert f"GROUPS {[(6000, 0.0, 1.0)] * 4}" in done.stdout, done.stderr[-2000:]
