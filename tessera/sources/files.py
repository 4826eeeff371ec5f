"""Files in and out: delimited, JSON and ragged text, read by explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def scan_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def scan_months(spark: SparkSession, path: str, scale: float = 100.0) -> DataFrame:
    """(month, value) of text in which only some lines are data: those of two
    fields whose first is a six-digit month. Other lines are passed over."""
    fields = F.split("value", ",")
    lines = spark.read.text(path).select(F.trim(F.get(fields, F.lit(0))).alias("month"), F.trim(F.get(fields, F.lit(1))).alias("x"), F.size(fields).alias("n"))
    return lines.filter(F.col("month").rlike(r"^\d{6}$") & (F.col("n") == 2)).select("month", (F.col("x").try_cast("double") / scale).alias("value"))


def scan_dates(table: DataFrame, column: str, low: str, high: str) -> DataFrame:
    """Rows between two days, both included; the bounds reach the file scan."""
    return table.filter(F.col(column).between(F.lit(low).cast("date"), F.lit(high).cast("date")))


def write_artifact(rows: DataFrame, path: str, kind: str = "json") -> None:
    """A result as JSON lines or as delimited text with a header, in place of
    what is there; as many files as rows has partitions."""
    writer = rows.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)
