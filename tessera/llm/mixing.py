"""Mixing sources to target weights by Pareto order sampling.

Every source gets a share of all words by its weight, at most ``max_repeats``
times its own size; what a source can't take is shared among the others by
weight. Target over size is the number of times a source is read: the whole
part is allocated as certain copies of every document, and the rest is drawn by
Pareto order sampling: documents are ranked by random odds over inclusion odds,
u/(1-u) / (p/(1-p)), and the first ones are taken until their words fill the
rest. u is a hash of doc_id and text: reruns agree. Only DataFrame operations.

p falls with the root of a document's length beyond the mean, so that one long
document does not decide what a small source holds, and is scaled so that the
expected words are the source's rest: min(1, c w) with the one c for which they
are, found from sums over bins of lengths (see ``inclusion``).

A source with a third of all rows is not ranked in one task: ranks are cut into
``BINS`` bins whose words are summed first, and only the one bin in which the
source's rest ends is put in order. Scaled as they are, draws end near rank one,
where bins are narrow; a source that has no rest isn't ranked at all.

Defined results: a null text has no words; a null source is a source of its
own and comes last; a document without words takes none; the words taken differ
from the target by at most the document at the end of the ranking; equal ranks
are ordered by doc_id; an empty table returns no rows. Other columns are not
read, and the stage form hands all of them on unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bin_of, checkpointed, text_of, unused, word_count

BINS = 4096


def targets(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: int = 3, share: float = 1.0) -> DataFrame:
    """source, source_size, documents + weight, target. One row a source.

    Weights repeat over the sources by code point, null last. Sharing the excess
    again until no source is above its limit ends where all but the limited ones
    get one rate a weight: with sources in order of limit over weight, that rate
    follows from running sums.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights)).cast("int"))
    rows = sources.withColumn("weight", w).withColumn("limit", F.col("source_size").cast("double") * max_repeats)
    rows = rows.withColumn("total", F.sum("source_size").over(whole) * F.lit(float(share)))
    by = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    so_far = by.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by.rowsBetween(0, Window.unboundedFollowing)
    rate = (F.col("total") - F.coalesce(F.sum("limit").over(so_far), F.lit(0.0))) / F.sum("weight").over(from_here)
    rows = rows.withColumn("rate_here", rate).withColumn("open", F.col("limit") / F.col("weight") >= F.col("rate_here"))
    level = F.min(F.when(F.col("open"), F.struct((F.col("limit") / F.col("weight")).alias("k"), F.col("rate_here").alias("rate")))).over(whole)["rate"]
    target = F.least(F.col("limit"), F.coalesce(level * F.col("weight"), F.col("limit")))
    return rows.select("source", "source_size", "documents", "weight", target.alias("target"))


def _random(doc_id: str, text_hash: str, seed: int) -> Column:
    """A digest of a document as a number strictly between 0 and 1."""
    key = F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(text_hash), F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(F.encode(key, "UTF-8")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def inclusion(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, length, p): the inclusion probability of a source's documents of
    a length, so that their expected words are what the source has to draw.

    rows: source, size; plan: source, source_size, documents, rest (above nil).
    With lengths in rising order, weights w fall; those first ones that are
    certain are told by running sums, as every later one then has c w <= 1.
    """
    bins = rows.groupBy("source", bin_of(F.col("size")).alias("length")).agg(F.sum("size").alias("words"))
    p = plan.select(F.col("source").alias("s"), "source_size", "documents", "rest")
    bins = bins.join(p, bins["source"].eqNullSafe(F.col("s"))).drop("s")
    bins = bins.withColumn("w", 1 / F.sqrt(F.greatest(F.lit(1.0), F.col("length") * F.col("documents") / F.col("source_size"))))
    by = Window.partitionBy("source").orderBy("length")  # a few hundred lengths a source
    before = F.coalesce(F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tail = F.sum(F.col("words") * F.col("w")).over(by.rowsBetween(0, Window.unboundedFollowing))
    bins = bins.withColumn("c", F.try_divide(F.col("rest") - before, tail))
    level = F.min(F.when(F.col("c") * F.col("w") <= 1, F.struct("length", "c"))).over(Window.partitionBy("source"))
    return bins.withColumn("level", level).select("source", "length", F.when(F.col("length") >= F.col("level.length"), F.col("level.c") * F.col("w")).otherwise(1.0).alias("p"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: int = 3, share: float = 1.0, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row for each row of docs: doc_id, source, size, source_size, target,
    copies (whole times taken), taken (words), text_hash."""
    text = text_of(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text).cast("long").alias("size"), F.md5(F.encode(text, "UTF-8")).alias("text_hash"))
    rows = checkpointed(base)
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    plan = targets(sources, weights, max_repeats, share)
    plan = plan.withColumn("times", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    plan = plan.withColumn("whole", F.least(F.floor("times"), F.lit(max_repeats)).cast("int"))
    plan = checkpointed(plan.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))))
    joined = rows.join(plan.withColumnRenamed("source", "s"), rows["source"].eqNullSafe(F.col("s"))).drop("s")
    ranks = (F.col("rest") > 0) & (F.col("whole") < max_repeats)

    odds = checkpointed(inclusion(rows, plan.filter(ranks)))
    drawn_from = joined.filter(ranks).withColumn("length", bin_of(F.col("size")))
    on = drawn_from["source"].eqNullSafe(odds["source"]) & (drawn_from["length"] == odds["length"])
    u = _random("doc_id", "text_hash", seed)
    q = F.when(F.col("p") >= 1, 0.0).otherwise((u / (1 - u)) / (F.col("p") / (1 - F.col("p"))))
    ranked = drawn_from.join(odds, on).select(drawn_from["*"], "p").drop("length")
    ranked = ranked.withColumn("q", F.coalesce(q, F.lit(float("inf")))).drop("p").withColumn("bin", F.floor(BINS - BINS / (1 + F.col("q"))).cast("int"))

    # bins before the one in which a source's rest ends are taken whole
    sums = ranked.groupBy("source", "bin").agg(F.sum("size").alias("bin_words"), F.first("rest").alias("rest"))
    run = Window.partitionBy("source").orderBy("bin")
    sums = sums.withColumn("upto", F.sum("bin_words").over(run))
    ends = sums.filter("upto >= rest").groupBy("source").agg(F.min(F.struct("bin", (F.col("upto") - F.col("bin_words")).alias("before"))).alias("e"))
    ends = ends.select(F.col("source").alias("s"), F.col("e.bin").alias("end_bin"), F.col("e.before").alias("before"))
    marked = ranked.join(ends, ranked["source"].eqNullSafe(F.col("s")), "left").drop("s")

    at_end = F.col("bin") == F.col("end_bin")
    inside = Window.partitionBy("source").orderBy("q", "doc_id", "text_hash", "size").rowsBetween(Window.unboundedPreceding, 0)
    last = marked.filter(at_end).withColumn("upto", F.col("before") + F.sum("size").over(inside))
    # the document that crosses the end is taken if that comes nearer to it
    last = last.withColumn("drawn", (2 * F.col("upto") - F.col("size") <= 2 * F.col("rest")) & ((F.col("rest") - F.col("upto") + F.col("size")) > 0))
    others = marked.filter(~at_end | F.col("end_bin").isNull()).withColumn("drawn", F.coalesce(F.col("bin") < F.col("end_bin"), F.lit(True)))
    names = ["doc_id", "source", "size", "source_size", "target", "whole", "text_hash", "drawn"]
    out = others.select(*names).unionByName(last.select(*names)).unionByName(joined.filter(~ranks).withColumn("drawn", F.lit(False)).select(*names))
    copies = F.col("whole") + F.col("drawn").cast("int")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), "text_hash")


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The documents as the mix takes them, each as often as it is taken, with
    all their columns. Rows that repeat doc_id, source and text are one draw."""
    drawn = mix(docs, **params).filter("copies > 0").groupBy("doc_id", "source", "text_hash").agg(F.max("copies").alias("copies"))
    hashed, nth = unused(docs, "text_hash"), unused(docs, "nth")
    keyed = docs.withColumn(hashed, F.md5(F.encode(text_of(), "UTF-8")))
    on = (keyed[hashed] == drawn["text_hash"]) & keyed["doc_id"].cast("long").eqNullSafe(drawn["doc_id"]) & keyed["source"].eqNullSafe(drawn["source"])
    named = keyed.join(drawn, on).select(*[keyed[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), drawn["copies"])).alias(nth))
    return named.drop(nth)
