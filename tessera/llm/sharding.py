"""Sharding by fixed virtual slots.

Each record is hashed into one of thousands of virtual slots. Bytes are summed
per slot, and a versioned table maps slots to shards: it is first dealt so that
the shards' bytes are nearly equal, and later edited, moving whole slots, when
a shard is added. Records never change their slot, so a new version of the map
is all that rebalancing writes. Only DataFrame operations.

The law that holds for the result is ``bytes``: sizes near equal.

Places in a shard are gapless from 0 and numbered without gathering a shard in
one task: rows are numbered within their slot, and the slots of a shard are
laid one after another by a running sum over the slots (a bounded table).

Defined results: a null text has size 1 and the checksum of the empty text;
rows that repeat doc_id, size and checksum are counted together and get places
of their own; an empty table returns no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, text_of

SLOTS = 4096


def slot_of(*keys: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record: the leading 32 bits of an MD5 of its keys."""
    text = F.concat_ws(":", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, 8), 16, 10).cast("long") % slots


def records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, copies) of the distinct records."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    rows = rows.withColumn("virtual_slot", slot_of(F.col("doc_id"), F.col("size"), F.col("text_crc32"), slots=slots))
    return rows.groupBy("doc_id", "size", "text_crc32", "virtual_slot").agg(F.count("*").alias("copies"))


def slot_sizes(rows: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, records): one row for each slot in use."""
    return rows.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("records"))


def dealt_map(sizes: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, shard): the largest slot first, each to the shard with the
    fewest bytes so far. One row of at most ``slots`` structs is folded over."""
    every = sizes.sparkSession.range(slots).select(F.col("id").alias("virtual_slot")).join(sizes, "virtual_slot", "left")
    item = F.struct((-F.coalesce("bytes", F.lit(0))).alias("less"), F.col("virtual_slot"))
    ordered = every.agg(F.array_sort(F.collect_list(item)).alias("items"))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"), F.expr("cast(array() as array<int>)").alias("to"))

    def step(acc: Column, x: Column) -> Column:
        pick = F.array_position(acc["loads"], F.array_min(acc["loads"])).cast("int") - 1
        loads = F.transform(acc["loads"], lambda v, i: F.when(i == pick, v - x["less"]).otherwise(v))
        return F.struct(loads.alias("loads"), F.concat(acc["to"], F.array(pick)).alias("to"))

    dealt = ordered.select("items", F.aggregate("items", start, step)["to"].alias("to"))
    return dealt.select(F.explode(F.arrays_zip("items", "to")).alias("x")).select(F.col("x.items.virtual_slot").alias("virtual_slot"), F.col("x.to").alias("shard"))


def grown_map(current: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The map edited for one shard more (``shards`` is the new count): slots
    move into the new shard only, largest first, while their own shard stays at
    or above the new mean and the new shard at or below it."""
    every = current.join(sizes, "virtual_slot", "left").select("virtual_slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    item = F.struct((-F.col("bytes")).alias("less"), F.col("virtual_slot"), F.col("shard"))
    row = every.agg(F.array_sort(F.collect_list(item)).alias("items"), F.sum("bytes").alias("total"))
    loads = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.aggregate(F.filter("items", lambda x: x["shard"] == s), F.lit(0).cast("long"), lambda a, x: a - x["less"]))
    row = row.withColumn("loads", loads)

    def step(acc: Column, x: Column) -> Column:
        size, own, new = -x["less"], F.get(acc["loads"], x["shard"]), F.get(acc["loads"], F.lit(shards - 1))
        move = (size > 0) & ((own - size) * shards >= acc["total"]) & ((new + size) * shards <= acc["total"])
        changed = F.transform(acc["loads"], lambda v, i: F.when(move & (i == x["shard"]), v - size).when(move & (i == shards - 1), v + size).otherwise(v))
        to = F.when(move, F.lit(shards - 1)).otherwise(x["shard"]).cast("int")
        return F.struct(changed.alias("loads"), F.concat(acc["to"], F.array(to)).alias("to"), acc["total"].alias("total"))

    start = F.struct(F.col("loads"), F.expr("cast(array() as array<int>)").alias("to"), F.col("total"))
    edited = row.select("items", F.aggregate("items", start, step)["to"].alias("to"))
    return edited.select(F.explode(F.arrays_zip("items", "to")).alias("x")).select(F.col("x.items.virtual_slot").alias("virtual_slot"), F.col("x.to").alias("shard"))


class SlotMap:
    """The versions of a slot-to-shard map, one Parquet folder each."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, version: int, mapping: DataFrame) -> None:
        mapping.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/version={version}")

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema("virtual_slot long, shard int").parquet(f"{self.path}/version={version}")


def shard(docs: DataFrame, path: str, shards: int = 8, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: doc_id, size, text_crc32, virtual_slot,
    shard, place. Writes version 1 of the map (``shards`` shards) to path."""
    rows = checkpointed(records(docs, slots, id_col, text_col))
    sizes = checkpointed(slot_sizes(rows))
    store = SlotMap(docs.sparkSession, path)
    store.write(1, dealt_map(sizes, shards, slots))
    mapping = store.read(1)
    # where each slot begins in its shard: a running sum over at most ``slots`` rows
    begin = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = mapping.join(sizes, "virtual_slot").select("virtual_slot", "shard", F.coalesce(F.sum("records").over(begin), F.lit(0)).alias("slot_start"))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.withColumn("before", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    # at most ``slots`` rows: a proven bound
    placed = numbered.join(F.broadcast(starts), "virtual_slot")
    first = F.col("slot_start") + F.col("before")
    return placed.select("doc_id", "size", "text_crc32", "virtual_slot", "shard", F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("place"))


def add_shard(docs_or_records: DataFrame, path: str, version: int, shards: int) -> DataFrame:
    """Writes the next version of the map with one shard more than ``shards``
    and returns it. docs_or_records: the rows of records()."""
    store = SlotMap(docs_or_records.sparkSession, path)
    store.write(version + 1, grown_map(store.read(version), slot_sizes(docs_or_records), shards + 1))
    return store.read(version + 1)
