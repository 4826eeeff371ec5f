"""Balls of bit strings that meet in the middle.

Two strings differ in at most 2r bits exactly if some value lies within r bits
of both: the balls of radius r around them share it. So every string's variants
within r bits are written out, equal ones are brought together, and what meets
is a candidate. A ball of radius 2 over 64 bits has 2,081 variants; to shuffle
them one by one would move hundreds of times the input, so strings are dealt to
tasks and each task writes out its own variants:

- Of 2r + 1 blocks of bits, strings within 2r bits agree in one at least. A
  string is dealt once for each block, by the block's leading bits, and balls are
  met over the bits outside that block: 2r + 1 copies, whatever the input.
- A group of strings too large for a task is dealt once more: the bits outside
  its block make 2r + 1 blocks again, of which two strings within 2r bits agree
  in one too, and balls are met over the bits outside both. So up to some
  (2r + 1)**2 copies, and as many groups as two blocks of bits have values.
- What is too large even so (strings that agree in nearly all bits) is split by a
  linear map of the *variant*: each part gets every string, but writes out only
  those variants that the map sends to it, so the parts share the work evenly
  however close the strings lie.
- Within a task the same map cuts the variants into portions of ``CHUNK``.

No variant is left out, so every pair within 2r bits meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Variants written out at once.
CHUNK = 1 << 21
#: A group is cut into at most 2**MOST_PARTS parts.
MOST_PARTS = 10
#: Groups of more strings leave memory that is worth handing back.
SMALL = 4096
#: What makes up a task.
GROUP = ("block", "lead", "inner", "deep", "part")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Rows of the linear map: bit i of an image is the parity of the bits in row i.
MAP = np.random.default_rng(1).integers(1, 1 << 63, 20, dtype=np.uint64) | np.uint64(1)


def blocks(width: int, radius: int) -> list[tuple[int, int]]:
    """(low, high) bit bounds of the 2*radius + 1 blocks."""
    n = 2 * radius + 1
    return [(width * j // n, width * (j + 1) // n) for j in range(n)]


def inner_blocks(width: int, radius: int, block: int) -> list[list[int]]:
    """The bits of the 2*radius + 1 blocks within what a block leaves, the
    highest first."""
    low, high = blocks(width, radius)[block]
    rest = [b for b in range(width) if not low <= b < high]
    n = 2 * radius + 1
    return [rest[len(rest) * j // n : len(rest) * (j + 1) // n][::-1] for j in range(n)]


def dealt(rows: DataFrame, n: int, width: int, radius: int, per_group: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """rows (fp, ...) + block, lead, inner, deep, part, parts, by which tasks are
    made up (``GROUP``).

    n: rows that have the same ``keys``. Up to per_group of them are one group,
    with block and inner -1; the pairs that meet are the same either way.
    """
    bits = max(0, math.ceil(math.log2(max(1, n / per_group))))
    none = {"inner": F.lit(-1), "deep": F.lit(0).cast("long")}
    if not bits:
        return rows.withColumns({"block": F.lit(-1), "lead": F.lit(0).cast("long"), **none, "part": F.lit(0), "parts": F.lit(0)})
    each = []
    for j, (low, high) in enumerate(blocks(width, radius)):
        take = min(bits, high - low)
        lead = F.shiftrightunsigned("fp", high - take).bitwiseAND((1 << take) - 1)
        each.append(F.struct(F.lit(j).alias("block"), lead.alias("lead")))
    out = rows.withColumn("at", F.explode(F.array(*each))).select("*", "at.block", "at.lead").drop("at")
    out = _sized(out, [*keys, "block", "lead"], per_group)
    # of a group that is too large, an inner block's leading bits: as many as make it small, and as many more as
    # blocks were dealt by, since strings that crowd in several of those agree in these
    places = []
    for j in range(2 * radius + 1):
        inner = []
        for i, bits_of in enumerate(inner_blocks(width, radius, j)):
            masks = [sum(1 << b for b in bits_of[:k]) for k in range(len(bits_of) + 1)]
            masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks])
            deep = F.col("fp").bitwiseAND(F.get(masks, F.least(F.col("over") + bits, F.lit(len(bits_of)))))
            inner.append(F.struct(F.lit(i).alias("inner"), deep.alias("deep")))
        places.append(F.array(*inner))
    whole = F.array(F.struct(none["inner"].alias("inner"), none["deep"].alias("deep")))
    out = out.withColumn("at", F.explode(F.when(F.col("over") > 0, F.get(F.array(*places), F.col("block"))).otherwise(whole)))
    out = out.select(*rows.columns, "block", "lead", "at.inner", "at.deep")
    cut = _sized(out, [*keys, *GROUP[:-1]], per_group).withColumn("parts", F.least("over", F.lit(MOST_PARTS))).drop("over")
    return cut.withColumn("part", F.explode(F.sequence(F.lit(0), F.pow(F.lit(2.0), F.col("parts")).cast("int") - 1)))


def _sized(rows: DataFrame, group: list[str], per_group: int) -> DataFrame:
    """rows + over: into how many parts, as a power of two, their group should be
    cut; nil for one that is at most twice as large as it should be."""
    over = F.ceil(F.log2(F.col("size") / float(per_group))).cast("int")
    large = rows.groupBy(*group).agg(F.count("*").alias("size")).filter(F.col("size") > 2 * per_group).select(*group, over.alias("over"))
    return rows.join(large, group, "left").withColumn("over", F.coalesce("over", F.lit(0)))


def image(values: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    for i in range(bits):
        out |= (np.bitwise_count(values & MAP[i]) & 1).astype(np.int64) << i
    return out


def flips(free: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of at most radius of the free bits, and how many bits each has."""
    one = np.uint64(1) << np.array(free, np.uint64)
    out, last, at = [np.zeros(1, np.uint64)], np.zeros(1, np.uint64), np.full(1, -1)
    for _ in range(radius):
        grown = at[:, None] < np.arange(len(one))[None, :]  # each mask once
        at = np.broadcast_to(np.arange(len(one)), grown.shape)[grown]
        last = (last[:, None] | one[None, :])[grown]
        out.append(last)
    masks = np.concatenate(out)
    return masks, np.bitwise_count(masks).astype(np.uint64)


def meetings(fps: np.ndarray, width: int, radius: int, block: int, part: int = 0, parts: int = 0, inner: int = -1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of indices (first, other) into fps: of the strings that share a
    variant, each with the one nearest to it (the least index on a tie).

    Only variants of this part are written out, and only over the bits outside
    the block and the inner block (-1: none).
    """
    low, high = blocks(width, radius)[block] if block >= 0 else (0, 0)
    agreed = {*range(low, high), *(inner_blocks(width, radius, block)[inner] if inner >= 0 else ())}
    masks, sizes = flips([b for b in range(width) if b not in agreed], radius)
    m = len(fps)
    if m < 2:
        return
    bits = min(len(MAP), max(parts, math.ceil(math.log2(max(1, m * len(masks) / CHUNK)))))
    of_mask, of_fp = image(masks, bits), image(fps, bits)
    by_image = [np.flatnonzero(of_mask == s) for s in range(1 << bits)]
    classes = [(g, np.flatnonzero(of_fp == g).astype(np.uint64)) for g in np.unique(of_fp).tolist()]
    room = np.uint64(max(1, (m - 1).bit_length()))
    exact = width + 2 + int(room) <= 64
    for s in range(part, 1 << bits, 1 << parts):
        packed = []
        for g, own in classes:
            use = by_image[s ^ g]
            if len(use):
                values = fps[own][:, None] ^ masks[use][None, :]
                if exact:
                    values = ((values << np.uint64(2) | sizes[use][None, :]) << room) | own[:, None]
                else:  # equal values have equal hashes; the reverse is checked by the caller's verification
                    values = ((values * MULTIPLIER) >> room << room) | own[:, None]
                packed.append(values.ravel())
        if not packed:
            continue
        packed = np.sort(np.concatenate(packed))
        owner = (packed & ((np.uint64(1) << room) - np.uint64(1))).astype(np.int64)
        value = packed >> (room + np.uint64(2) if exact else room)
        begins = np.r_[True, value[1:] != value[:-1]]
        first = np.maximum.accumulate(np.where(begins, np.arange(len(value)), 0))
        a, b = owner[first[~begins]], owner[~begins]
        if not exact:
            false = np.bitwise_count(fps[a] ^ fps[b]) > 2 * radius
            if false.any():  # two values of one hash: the strings of such a run are met again by the values themselves
                runs = np.unique(first[~begins][false])
                mixed = np.isin(first, runs)
                again = np.unique(owner[mixed])
                yield _by_value(fps, again, masks)
            a, b = a[~false], b[~false]
        yield a, b


def _by_value(fps: np.ndarray, own: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = (fps[own][:, None] ^ masks[None, :]).ravel()
    owner = np.repeat(own, len(masks))
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    begins = np.r_[True, values[1:] != values[:-1]]
    first = np.maximum.accumulate(np.where(begins, np.arange(len(values)), 0))
    return owner[first[~begins]], owner[~begins]


def roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index reachable from each of n, by hooking and pointer jumping;
    pairs are taken one portion at a time."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            if (ra == rb).all():
                break
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (root[root] != root).any():
                root = root[root]
    return root
