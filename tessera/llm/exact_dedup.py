"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to its
distinct digests first (partial sums before the shuffle, so a text that fills a
third of the rows costs one row a task), the new ones are found by a sort-merge
anti-join with the index, and are appended to it: what an earlier batch brought
stays what is kept. Only DataFrame operations.

``deduplicate_newest_first`` takes a whole table through an index in batches of
falling doc_id, so that of equal texts the row of the largest doc_id is the one
that comes first.

Defined results: a null text counts as empty; a null doc_id is less than any
other; rows that repeat both doc_id and text are one document, of which one row
is kept; an empty batch appends nothing; batches given no name have names of
their own. Other columns are not read, and the stage form hands all of them on
unchanged, whatever their names.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, text_of, unused

#: A digest with over this share of the rows is hot; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1000


def normalised(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. lower() does that where every
    character is ASCII, and is much cheaper than translate()."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def digest(text: Column) -> Column:
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


class DigestIndex:
    """A table (digest, keep_id, group_size, first_batch) bucketed by digest.

    group_size and keep_id are those of the batch that brought the digest.
    buckets: of a new table; two a core if not given. A temporary index is dropped at the end of its ``with`` block.
    """

    SCHEMA = "digest string, keep_id long, group_size long, first_batch string"

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None):
        self.spark, self.name = spark, name
        self.buckets = buckets or 2 * spark.sparkContext.defaultParallelism
        if not spark.catalog.tableExists(name):
            self._write(spark.createDataFrame([], self.SCHEMA))

    @classmethod
    @contextmanager
    def temporary(cls, spark: SparkSession, buckets: int | None = None) -> Iterator[DigestIndex]:
        index = cls(spark, f"digest_index_{uuid.uuid4().hex}", buckets)
        try:
            yield index
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {index.name}")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Adds those digests of groups (digest, keep_id, group_size) that are new."""
        new = groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti")
        # dealt as the buckets are, so that each bucket is one file of one task
        self._write(new.select("digest", "keep_id", "group_size", F.lit(batch).alias("first_batch")).repartition(self.buckets, "digest"))

    def _write(self, rows: DataFrame) -> None:
        rows.write.bucketBy(self.buckets, "digest").sortBy("digest").mode("append").format("parquet").saveAsTable(self.name)

    def found(self, groups: DataFrame) -> DataFrame:
        """groups (digest, group_size) with what the index keeps of them:
        digest, keep_id, group_size, first_batch."""
        kept = self.table().select("digest", "keep_id", "first_batch").hint("merge")
        return groups.select("digest", "group_size").join(kept, "digest")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, doc_id, copies): the distinct rows of docs by digest and id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(text_of(text_col)).alias("digest"))
    return rows.groupBy("digest", "doc_id").agg(F.count("*").alias("copies"))


def groups_of(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size) from the rows of digests()."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))


def with_groups(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """rows joined with groups (digest, group_size, ...) by digest. Digests with
    over HOT_SHARE of the ``total`` rows, of which there are fewer than
    1 / HOT_SHARE whatever the input, are broadcast; the others are joined by
    sort and merge."""
    hot = F.col("group_size") > max(1, int(total * HOT_SHARE))
    few = groups.filter(hot)
    named = rows.join(F.broadcast(few.select("digest", F.lit(True).alias("is_hot"))), "digest", "left")
    return (
        named.filter("is_hot").drop("is_hot").join(F.broadcast(few), "digest")
        .unionByName(named.filter("is_hot IS NULL").drop("is_hot").join(groups.filter(~hot).hint("merge"), "digest"))
    )


def _rows_out(rows: DataFrame, found: DataFrame, batch: str | None) -> DataFrame:
    """A row for each copy in rows; batch: the one whose digests are kept (None: any)."""
    total = rows.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    each = with_groups(rows, found, total).select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("nth"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    if batch is not None:
        kept = kept & (F.col("first_batch") == batch)
    return each.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs a batch against the index, appends what is new, and returns a row
    for each row of docs: doc_id, keep_id, group_size (in this batch), kept,
    digest.

    Of equal texts within the batch that of the largest doc_id is kept; none is
    kept if an earlier batch brought the text (keep_id is then the earlier id).
    """
    batch = batch or uuid.uuid4().hex
    rows = checkpointed(digests(docs, id_col, text_col))
    groups = checkpointed(groups_of(rows))
    index.append(groups, batch)
    return checkpointed(_rows_out(rows, checkpointed(index.found(groups)), batch))


def _append_newest_first(rows: DataFrame, index: DigestIndex, batches: int) -> list[str]:
    """Takes rows through the index in batches of falling doc_id, so that the
    anti-join decides what of the later ones is new; the batches' names."""
    edges = rows.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)])).first()[0] if batches > 1 else []
    number, names = F.lit(0), []  # the batch of a row, from 0 up; rows without doc_id come last, in batch 0
    for edge in edges or []:
        number = number + F.coalesce(F.col("doc_id") >= edge, F.lit(False)).cast("int")
    for i in reversed(range(len(edges or []) + 1)):
        names.append(uuid.uuid4().hex)
        index.append(groups_of(rows.filter(number == i)), names[-1])
    return names


def deduplicate_newest_first(docs: DataFrame, index: DigestIndex, batches: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A whole table through the index in batches of falling doc_id; a row for
    each row of docs: doc_id, keep_id, group_size (in docs), kept, digest."""
    rows = checkpointed(digests(docs, id_col, text_col))
    _append_newest_first(rows, index, batches)
    return checkpointed(_rows_out(rows, checkpointed(index.found(groups_of(rows))), None))


def kept_documents(docs: DataFrame, index: DigestIndex, batches: int = 1) -> DataFrame:
    """The rows of docs that stay, with all their columns: of each text that the
    index hasn't had before, that of the largest doc_id.

    Only rows that repeat both doc_id and text are deduplicated as whole rows;
    all other rows pass by a semi-join on (doc_id, digest).
    """
    rows = checkpointed(digests(docs))
    names = _append_newest_first(rows, index, batches)
    mine = index.table().filter(F.col("first_batch").isin(names)).select("digest", F.col("keep_id").alias("doc_id"))
    kept = checkpointed(rows.join(mine.hint("merge"), [rows["digest"] == mine["digest"], rows["doc_id"].eqNullSafe(mine["doc_id"])], "left_semi"))
    name = unused(docs, "digest")
    keyed = docs.withColumn(name, digest(text_of()))

    def those(keys: DataFrame) -> DataFrame:
        return keyed.join(keys, keyed[name].eqNullSafe(keys["digest"]) & keyed["doc_id"].eqNullSafe(keys["doc_id"]), "left_semi")

    repeated = kept.filter("copies > 1")
    out = those(kept.filter("copies = 1"))
    if not repeated.isEmpty():
        out = out.unionByName(those(repeated).dropDuplicates(["doc_id", name]))
    return out.drop(name)
