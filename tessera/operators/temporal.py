"""Joins in time: as-of, bitemporal, interval overlap, merging, priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.predicates import covers
from tessera.sources.scratch import checkpointed

FOREVER = "9999-12-31"


def asof_backward(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str], max_age_days: int | None = None) -> DataFrame:
    """Each row of left with the last row of right at or before its time.

    Both sides are laid over one another and the last value is carried forward:
    one shuffle and one sort by key and time, no join of ranges. Where right
    repeats a key and time, the largest values count.
    """
    r = right.groupBy(key, right_time).agg(F.max(F.struct(F.col(right_time).alias("found_at"), *values)).alias("v"))
    r = r.select(F.col(key).alias("_k"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), "v", F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"))
    both = left.select(F.col(key).alias("_k"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(r.schema["v"].dataType).alias("v"), F.struct("*").alias("_row")).unionByName(r)
    w = Window.partitionBy("_k").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("v", F.last("v", ignorenulls=True).over(w)).filter("_side = 1").select("_row.*", "v.*")
    if max_age_days is not None:
        fresh = F.datediff(F.col(left_time), F.col("found_at")) <= max_age_days
        out = out.select(*left.columns, *[F.when(fresh, F.col(c)).alias(c) for c in ("found_at", *values)])
    return out


def resolve(left: DataFrame, intervals: DataFrame, key: str, time: str, value: str, valid_from: str = "valid_from", valid_to: str = "valid_to", bin_days: int = 366) -> DataFrame:
    """Each row of left with the value whose interval covers its time, that of
    the latest start (then the largest value) if several do.

    Time is cut into bins of ``bin_days``: an interval is written out for the
    bins it reaches, an open one up to left's last time, and an equi-join on key
    and bin meets only what lies in the same stretch of time. A key with very many
    rows is so dealt to as many tasks as it has bins.
    """
    bin_ = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / bin_days)
    asked = left.select(F.col(key).alias("_k"), F.col(time).alias("_at")).distinct().withColumn("_bin", bin_(F.col("_at")))
    last = asked.agg(F.max("_bin").alias("_last"))  # one row
    i = intervals.select(F.col(key).alias("_k"), F.col(valid_from).alias("_f"), F.col(valid_to).alias("_t"), F.col(value).alias("_v")).join(F.broadcast(last))
    i = i.withColumn("_to", F.least(F.coalesce(bin_(F.col("_t")), "_last"), "_last")).filter(bin_(F.col("_f")) <= F.col("_to"))
    i = i.withColumn("_bin", F.explode(F.sequence(bin_(F.col("_f")), "_to"))).drop("_last", "_to")
    hit = asked.join(i, ["_k", "_bin"]).filter(covers("_f", "_t", "_at"))
    best = hit.groupBy("_k", "_bin", "_at").agg(F.max(F.struct("_f", "_v"))["_v"].alias(value)).drop("_bin")
    return left.join(best, (left[key] == best["_k"]) & (left[time] == best["_at"]), "left").drop("_k", "_at")


def seen_intervals(statements: DataFrame) -> DataFrame:
    """statements + seen, until: a vintage is what is known of its period from
    when it was accepted until a later vintage is. Vintages that are never known
    (accepted after a later one, or not at all) have no row."""
    later = Window.partitionBy("sec", "period_end").orderBy(F.desc("vintage_id")).rowsBetween(Window.unboundedPreceding, -1)
    rows = statements.withColumn("seen", F.col("accepted")).withColumn("until", F.min("accepted").over(later))
    return rows.filter("seen IS NOT NULL AND (until IS NULL OR seen < until)")


def visible_on_grid(statements: DataFrame, grid: DataFrame, last_periods: int | None = 6) -> DataFrame:
    """For each as_of of grid (as_of, ai; a row a month) the statements as they
    were known by its close; ``nth`` counts periods back from the latest.

    A vintage is written out for the months of its own interval only, and a
    period no longer than until last_periods later ones are known, so the rows
    made are in proportion to those returned. Windows by sec: one shuffle, or
    none where statements are stored by it.
    """
    months = [r.as_of for r in grid.select("as_of").orderBy("as_of").collect()]  # a row a month
    first = grid.agg(F.coalesce(F.min("ai"), F.lit(1)).alias("ai")).first().ai
    closes = F.array(*[F.lit(m).cast("timestamp_ntz") + F.expr("INTERVAL 16 HOURS") for m in months]) if months else F.array().cast("array<timestamp_ntz>")
    # months are numbered one after another, so the first close at or after t has the number of those before it
    month_of = lambda t: F.size(F.filter(closes, lambda c: c < t)) + first
    rows = seen_intervals(statements).withColumn("seen", F.greatest("seen", F.col("period_end").cast("timestamp_ntz")))
    if last_periods is None:
        gone = F.lit(None).cast("timestamp_ntz")
    else:
        known = F.min("seen").over(Window.partitionBy("sec", "period_end"))
        rows = rows.withColumn("known", known).withColumn("place", F.dense_rank().over(Window.partitionBy("sec").orderBy("period_end")))
        ahead = Window.partitionBy("sec").orderBy("place").rangeBetween(1, last_periods)
        full = F.max("place").over(ahead) == F.col("place") + last_periods
        gone = F.when(full, F.max("known").over(ahead))
    rows = rows.withColumn("lo", month_of(F.col("seen"))).withColumn("hi", F.least(month_of(F.coalesce("until", F.lit("9999-01-01").cast("timestamp_ntz"))), month_of(F.coalesce(gone, F.lit("9999-01-01").cast("timestamp_ntz")))) - 1)
    each = rows.filter("lo <= hi").withColumn("ai", F.explode(F.sequence("lo", "hi"))).join(F.broadcast(grid.select("as_of", F.col("ai").cast("int").alias("ai"))), "ai")
    out = each.withColumn("nth", F.row_number().over(Window.partitionBy("sec", "as_of").orderBy(F.desc("period_end"))))
    values = [c for c in statements.columns if c not in ("sec", "period_end")]
    out = out.select("sec", "as_of", "period_end", *values, "nth")
    return out if last_periods is None else out.filter(F.col("nth") <= last_periods)


def visible_statements(grid: DataFrame, statements: DataFrame, last_periods: int | None = 6) -> DataFrame:
    """visible_on_grid for the cells (sec, as_of) of grid only."""
    dates = grid.select("as_of").distinct()
    months = dates.withColumn("ai", F.row_number().over(Window.orderBy("as_of")))  # a row a date
    return visible_on_grid(statements, months, last_periods).join(grid.select("sec", "as_of").distinct(), ["sec", "as_of"], "left_semi")


def _end(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(FOREVER).cast("date"))


def overlaps(intervals: DataFrame, key: str, entity: str, across: bool = True) -> DataFrame:
    """Pairs of intervals of one key that share a day, of different entities
    (a.entity < b.entity) or of the same one (a starts first). An equi-join on
    the key with the overlap as residual condition."""
    a = intervals.select(key, F.col(entity).alias("a_entity"), F.col("valid_from").alias("a_from"), F.col("valid_to").alias("a_to"))
    b = intervals.select(key, F.col(entity).alias("b_entity"), F.col("valid_from").alias("b_from"), F.col("valid_to").alias("b_to"))
    order = F.col("a_entity") < F.col("b_entity") if across else (F.col("a_entity") == F.col("b_entity")) & (F.col("a_from") < F.col("b_from"))
    return a.join(b, key).filter(order & (F.col("a_from") <= _end("b_to")) & (F.col("b_from") <= _end("a_to")))


def merged(intervals: DataFrame, by: list[str]) -> DataFrame:
    """Intervals of each group merged where they share a day, in one pass: an
    island begins where no earlier interval reaches."""
    w = Window.partitionBy(*by).orderBy("valid_from", _end("valid_to"))
    rows = intervals.withColumn("reach", F.max(_end("valid_to")).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("island", F.sum(F.when(F.col("reach") >= F.col("valid_from"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = rows.groupBy(*by, "island").agg(F.min("valid_from").alias("valid_from"), F.max(_end("valid_to")).alias("valid_to"), F.count("*").alias("n"))
    return out.select(*by, "valid_from", F.nullif("valid_to", F.lit(FOREVER).cast("date")).alias("valid_to"), "n")


def held_alike(asked: DataFrame, intervals: DataFrame, key: str, entity: str) -> DataFrame:
    """The rows of asked (a_key, a_time, b_key, b_time and others) where the very
    same entities, at least one, hold both keys, each at its time. intervals: those
    of one entity and key share no day.

    No set is gathered. Running sums over a key's starts and ends have, for each of
    its days, how many entities hold it and the sum of their digests. Where both
    agree, the sets are the same exactly if they share as many as each has.
    """
    day = lambda c: F.datediff(c, F.lit("0001-01-01").cast("date"))
    held = intervals.select(F.col(key).alias("k"), F.col(entity).alias("e"), day("valid_from").alias("f"), (day("valid_to") + 1).alias("g"))
    held = held.filter("k IS NOT NULL AND e IS NOT NULL AND (g IS NULL OR f < g)")
    asked = asked.withColumns({"_a": day("a_time"), "_b": day("b_time")})
    turns = held.select("k", F.xxhash64("e").cast("decimal(20,0)").alias("h"), F.explode(F.array(F.struct(F.col("f").alias("t"), F.lit(1).alias("s")), F.struct(F.col("g").alias("t"), F.lit(-1).alias("s")))).alias("x"))
    turns = turns.filter("x.t IS NOT NULL").groupBy("k", "x.t").agg(F.sum("x.s").alias("n"), F.sum(F.when(F.col("x.s") > 0, F.col("h")).otherwise(-F.col("h"))).alias("h"))
    points = asked.select(F.explode(F.array(F.struct(F.col("a_key").alias("k"), F.col("_a").alias("t")), F.struct(F.col("b_key").alias("k"), F.col("_b").alias("t")))).alias("x")).select("x.*").distinct()
    days = turns.unionByName(points.withColumns({"n": F.lit(0).cast("long"), "h": F.lit(0).cast("decimal(30,0)")})).groupBy("k", "t").agg(F.sum("n").alias("n"), F.sum("h").alias("h"))
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    by_day = days.select("k", "t", F.sum("n").over(w).alias("n"), F.sum("h").over(w).alias("h"))
    for side in "ab":
        asked = asked.join(by_day.select(F.col("k").alias(f"{side}_key"), F.col("t").alias(f"_{side}"), F.struct("n", "h").alias(f"_{side}_sums")), [f"{side}_key", f"_{side}"])
    likely = checkpointed(asked.filter("_a_sums = _b_sums AND _a_sums.n > 0").withColumn("_n", F.col("_a_sums.n")).drop("_a_sums", "_b_sums"))
    shared = _covering_both(likely.select("a_key", "_a", "b_key", "_b").distinct(), held)
    return likely.join(shared, ["a_key", "_a", "b_key", "_b"]).filter("_shared = _n").drop("_a", "_b", "_n", "_shared")


def _covering_both(points: DataFrame, held: DataFrame) -> DataFrame:
    """points (a_key, _a, b_key, _b) + _shared: how many entities of held (k, e, f,
    g: from day f, before day g, null if open) hold a_key on day _a and b_key on _b.

    An entity with both keys is a rectangle, and how many lie over a point is the
    signed number of corners at or before it in both directions. The days up to
    _a are at most 22 blocks of lengths in powers of two: corners are written out
    for the block of each length they lie in, points for those they are made of,
    and a running sum in order of _b counts within a block.
    """
    side = lambda s, k, f, g: held.select(F.col("k").alias(k), "e", F.col("f").alias(f), F.col("g").alias(g)).join(points.select(k).distinct(), k, "left_semi")
    both = side("a", "a_key", "f1", "g1").join(side("b", "b_key", "f2", "g2"), "e").join(points.select("a_key", "b_key").distinct(), ["a_key", "b_key"], "left_semi")
    corners = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.lit(s).cast("long").alias("s")) for x, y, s in (("f1", "f2", 1), ("g1", "f2", -1), ("f1", "g2", -1), ("g1", "g2", 1))])
    corners = both.select("a_key", "b_key", F.explode(corners).alias("c")).filter("c.x IS NOT NULL AND c.y IS NOT NULL")
    level = F.explode(F.sequence(F.lit(0), F.lit(21))).alias("level")  # days up to 9999 have 22 bits
    corners = corners.select("a_key", "b_key", "c.*", level).groupBy("a_key", "b_key", "level", F.expr("shiftright(x, level)").alias("block"), "y").agg(F.sum("s").alias("s"))
    parts = points.select("*", level).filter("shiftright(_a + 1, level) % 2 = 1")
    parts = parts.select("a_key", "b_key", "level", (F.expr("shiftright(_a + 1, level)") - 1).alias("block"), F.col("_b").alias("y"), F.lit(0).cast("long").alias("s"), "_a")
    w = Window.partitionBy("a_key", "b_key", "level", "block").orderBy("y").rangeBetween(Window.unboundedPreceding, 0)
    rows = corners.withColumn("_a", F.lit(None).cast("int")).unionByName(parts).withColumn("s", F.sum("s").over(w)).filter("_a IS NOT NULL")
    return rows.groupBy("a_key", "_a", "b_key", F.col("y").alias("_b")).agg(F.sum("s").alias("_shared"))


def uncontained(intervals: DataFrame, by: list[str], stretch: str = "month") -> DataFrame:
    """Intervals that no other, different one of their group contains.

    In order of start, and of falling end at one start, an interval is contained
    exactly if one before it reaches as far. So the furthest end so far decides:
    that of all earlier stretches of time, carried over a table of one row a group
    and stretch, and within the stretch a window. No interval is joined with
    others of its group, and a large group is dealt by its stretches.
    """
    end, part = _end("valid_to"), F.trunc("valid_from", stretch)
    rows = intervals.dropDuplicates([*by, "valid_from", "valid_to"]).withColumn("_part", part).withColumn("_end", end)
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*by, "_part").agg(F.max("_end").alias("_far")).withColumn("_far", F.max("_far").over(earlier))
    carried = carried.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_part").alias("_stretch"), "_far")
    same = F.col("_part") == F.col("_stretch")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    within = Window.partitionBy(*by, "_part").orderBy("valid_from", F.desc("_end")).rowsBetween(Window.unboundedPreceding, -1)
    reach = rows.withColumn("_near", F.max("_end").over(within)).join(carried, same)
    return reach.filter(F.coalesce(F.greatest("_near", "_far") < F.col("_end"), F.lit(True))).select(*intervals.columns)


def by_priority(parts: list[DataFrame], key: list[str], order: list[str] | None = None) -> DataFrame:
    """The rows of all parts, one a key: that of the earliest part that has it
    (within a part the first by ``order``)."""
    tagged = None
    for i, p in enumerate(parts):
        q = p.withColumn("_priority", F.lit(i))
        tagged = q if tagged is None else tagged.unionByName(q)
    w = Window.partitionBy(*key).orderBy("_priority", *(order or []))
    return tagged.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth", "_priority")


def rename_chain(edges: DataFrame) -> DataFrame:
    """(start, last, steps) of each name followed along edges (old, new), as far
    as they go. Each name has one edge at most; last and steps are null for a
    name that leads into a cycle.

    Doubling until nothing goes on: a chain of n steps takes log2(n) joins. A
    chain of distinct names has no more steps than there are edges, so what goes
    on beyond that is a cycle.
    """
    jumps = checkpointed(edges.select(F.col("old").alias("start"), F.col("new").alias("last"), F.lit(1).cast("long").alias("steps")))
    most, reach = jumps.count(), 1
    while True:
        nxt = jumps.select(F.col("start").alias("last"), F.col("last").alias("then"), F.col("steps").alias("more"))
        going = checkpointed(jumps.join(nxt, "last", "left").select("start", "last", "steps", "then", "more"))
        if reach > most or going.filter("then IS NOT NULL").isEmpty():
            break
        jumps = going.select("start", F.coalesce("then", "last").alias("last"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        reach *= 2
    ends = F.col("then").isNull()
    return going.select("start", F.when(ends, F.col("last")).alias("last"), F.when(ends, F.col("steps")).alias("steps"))


def fuzzy_match(left: DataFrame, right: DataFrame, key: list[str], left_date: str, right_date: str, days: int = 6) -> DataFrame:
    """Each row of left with the row of right of the same key nearest in date
    within days; the earlier one on a tie. Weekly bins make it an equi-join."""
    width = days + 1
    bin_ = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / width)
    r = right.select(*[F.col(k).alias(f"_{k}") for k in key], *[c for c in right.columns if c not in key])
    r = r.withColumn("_bin", F.explode(F.array(*[bin_(F.col(right_date)) + i for i in (-1, 0, 1)])))
    on = bin_(F.col(left_date)) == F.col("_bin")
    for k in key:
        on = on & (F.col(k) == F.col(f"_{k}"))
    gap = F.datediff(F.col(left_date), F.col(right_date))
    hit = left.join(r, on).filter(F.abs(gap) <= days).drop("_bin", *[f"_{k}" for k in key])
    w = Window.partitionBy(*key, left_date).orderBy(F.abs(gap), right_date)
    return hit.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
