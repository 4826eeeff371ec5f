"""What the corpus operators share: reading, shared storage, small column helpers."""

from __future__ import annotations

import ctypes
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.scratch import checkpointed, scratch_path, shared_dir  # noqa: F401  operators take them from here

#: White space of the word rule, as a Java and as a Python class body.
SPACES = r"\x20\x09-\x0D"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder that a job of this session wrote and no plan reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def give_back() -> None:
    """Hands memory that a task has freed back to the system. Workers wait for
    their next task beside the JVM, and what they hold on to counts."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only some C libraries can
        ctypes.CDLL(None).malloc_trim(0)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df has not, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, for use inside expressions."""
    return F.transform(F.array(value), body)[0]


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """The number of words without building them: starts of runs."""
    return F.regexp_count(text, F.lit(f"[^{SPACES}]+"))


def unit(h: Column) -> Column:
    """A hash as a number strictly between 0 and 1."""
    return (F.shiftrightunsigned(h, 12).cast("double") + 0.5) / float(1 << 52)


def bin_of(v: Column) -> Column:
    """The lower end of the log-linear bin of a whole number, 32 bins to an
    octave: exact below 64."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)
