"""Benchmark decontamination by training suffix arrays.

Training text is taken in shards, portions of a task's rows. Each shard gets a
suffix array over its words (see ``suffixes``); every suffix of every test item
is binary-searched in it. Where an array holds a window of an item (its next
``window`` words, or a whole item of fewer) the words it covers are hit, and the
affected documents can be removed. Searching for whole suffixes gives the
longest verbatim match of each item and where it is.

Training text isn't shuffled: what travels are the items, in blocks of some
``BLOCK_BYTES``, each a broadcast of its own that a task holds one at a time.
However many items there are, neither the driver nor a task holds them all.

Defined results: a null or empty text has no words; an item without words has no
window; rows of one item_id are one item, and a null item_id is the empty
string; repeated documents return repeated rows; an empty table on either side
gives no rows or no hits. Other columns aren't read, but removal hands them
through. A task's memory holds a shard, that is ``SHARD_BYTES`` or its longest
text some twenty times over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import suffixes

WINDOW = 10
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 8 << 20


@dataclass
class Block:
    """Test items as numbers, with a foreign word after each, and their windows."""

    names: list[str]
    vocabulary: suffixes.Vocabulary
    ids: np.ndarray
    item: np.ndarray  # which of names each place of ids belongs to
    begins: np.ndarray  # where each item begins in ids
    ends: np.ndarray
    at: np.ndarray  # each distinct window: where it is, how long, and of which items
    length: np.ndarray
    owners: list[frozenset[str]]

    @classmethod
    def of(cls, names: list[str], texts: list[bytes], window: int) -> Block:
        words = suffixes.of_texts(texts)
        vocabulary, numbers = suffixes.Vocabulary.of(words)
        counts = np.diff(words.first)
        item = np.repeat(np.arange(len(names)), counts)
        ids = np.zeros(len(words) + len(names) + window, np.int64)
        ids[np.arange(len(words)) + item] = numbers
        begins = words.first[:-1] + np.arange(len(names))
        ends = begins + counts
        of_place = np.zeros(len(ids), np.int64)
        of_place[np.arange(len(words)) + item] = item
        lengths = np.minimum(counts, window)
        which, at = suffixes.ranges(begins, ends - lengths + (lengths > 0))
        content = ids[at[:, None] + np.arange(window)[None, :]] * (np.arange(window)[None, :] < lengths[which][:, None])
        _, first, inverse = np.unique(content, axis=0, return_index=True, return_inverse=True)
        owners: list[set[str]] = [set() for _ in first]
        for c, i in zip(inverse.ravel().tolist(), which.tolist()):
            owners[c].add(names[i])
        return cls(names, vocabulary, ids, of_place, begins, ends, at[first], lengths[which[first]], [frozenset(x) for x in owners])

    def depth(self) -> int:
        return int((self.ends - self.begins).max(initial=1))


def blocks(items: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> list:
    """The items as broadcast blocks; the driver holds one block at a time."""
    sc = items.sparkSession.sparkContext
    rows = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("name"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out, names, texts, size = [], [], [], 0
    for r in rows.toLocalIterator():
        names.append(r.name)
        texts.append(r.text.encode())
        size += len(texts[-1])
        if size >= block_bytes:
            out.append(sc.broadcast(Block.of(names, texts, window)))
            names, texts, size = [], [], 0
    if names:
        out.append(sc.broadcast(Block.of(names, texts, window)))
    return out


class Shard:
    """The words of some texts, and what the blocks of items find in them."""

    def __init__(self, texts: list[pa.Array]):
        column = pa.concat_arrays([t.cast(pa.large_binary()) for t in texts]).fill_null(b"")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.words = suffixes.cut(data, offsets - offsets[0])
        self.n_words = np.diff(self.words.first)
        self.doc = np.repeat(np.arange(len(column)), self.n_words)
        self.size = len(self.words) + len(column) + 1  # a foreign word after each text
        self.place = np.arange(len(self.words)) + self.doc

    def ids(self, block: Block) -> np.ndarray:
        out = np.zeros(self.size, np.int32)
        out[self.place] = block.vocabulary.numbered(self.words)
        return out

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The text, and the word's number there, of places in ids."""
        word = np.searchsorted(self.place, places)
        return self.doc[word], word - self.words.first[self.doc[word]]

    def hits(self, held: list) -> tuple[np.ndarray, dict[int, frozenset[str]]]:
        """Which places are hit, and the items that each text has windows of."""
        edges = np.zeros(self.size + 1, np.int64)
        names: dict[int, frozenset[str]] = {}
        known: dict[tuple[int, bytes], frozenset[str]] = {}
        for b, broadcast in enumerate(held):
            block = broadcast.value
            ids = self.ids(block)
            order = suffixes.suffix_array(ids, int(block.length.max(initial=1)))
            begin, end = (suffixes.bounds(ids, order, block.ids, block.at, block.length, upper) for upper in (False, True))
            window, nth = suffixes.ranges(begin, end)
            place = order[nth]
            np.add.at(edges, place, 1)
            np.add.at(edges, place + block.length[window], -1)
            doc, _ = self.at(place)
            codes = np.unique(doc * len(block.at) + window)
            doc, window = codes // max(1, len(block.at)), codes % max(1, len(block.at))
            for d, own in zip(doc[starts := _starts(doc)].tolist(), np.split(window, starts[1:])):
                key = (b, own.tobytes())
                if key not in known:
                    known[key] = frozenset().union(*(block.owners[w] for w in own.tolist()))
                names[d] = names.get(d, frozenset()) | known[key]
        return np.cumsum(edges[:-1]) > 0, names

    def longest(self, block: Block) -> tuple[np.ndarray, ...]:
        """For each item with words: the place of ids where its longest match
        begins, its length, and the text and word where it is."""
        ids = self.ids(block)
        order = suffixes.suffix_array(ids, block.depth())
        at = np.flatnonzero(block.ids)
        rest = block.ends[block.item[at]] - at
        best, where = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        if len(order):
            found = suffixes.bounds(ids, order, block.ids, at, rest, False)
            for beside in (found - 1, found):
                near = order[np.clip(beside, 0, len(order) - 1)]
                n = suffixes.common(ids, near, block.ids, at, rest)
                best, where = np.where(n > best, n, best), np.where(n > best, near, where)
        first = np.lexsort((at, -best, block.item[at]))
        first = first[_starts(block.item[at][first])]
        first = first[best[first] > 0]
        return (at[first], best[first], *self.at(where[first]))


def _starts(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)


def _shards(batches: Iterator[pa.RecordBatch], column: int, shard_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for b in batches:
        for at in range(0, len(b), 64):
            part = b.slice(at, 64)
            held.append(part)
            size += pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if size >= shard_bytes:
                yield held
                held, size = [], 0
    if held:
        yield held


SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(SPAN))])


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of every row: hit words, the names
    of the items it has windows of in order, and where its runs of hit words
    begin and end, counted in words."""
    held = blocks(items, window, item_col, item_text_col, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in _shards(batches, 1, shard_bytes):
            shard = Shard([b.column(1) for b in portion])
            hit, names = shard.hits(held)
            edge = np.flatnonzero(np.diff(np.r_[False, hit, False]))
            begins, ends = edge[::2], edge[1::2]
            doc, begin = shard.at(begins)
            n = len(shard.n_words)
            spans = pa.StructArray.from_arrays([pa.array(begin), pa.array(begin + ends - begins)], fields=list(SPAN))
            n_hit = np.bincount(doc, ends - begins, n).astype(np.int64)
            found = pa.array([sorted(names.get(d, ())) for d in range(n)], pa.list_(pa.string()))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(doc, minlength=n))].astype(np.int32)), spans)
            ids = pa.concat_arrays([b.column(0) for b in portion])
            yield pa.RecordBatch.from_arrays([ids, pa.array(shard.n_words), pa.array(n_hit), found, lists], schema=RESULT)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<begin: long, end: long>>")


def removed(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, that no window of an item is in."""
    held, column = blocks(items, window, item_col, item_text_col, block_bytes), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in _shards(batches, column, shard_bytes):
            _, names = Shard([b.column(column) for b in portion]).hits(held)
            at = 0
            for b in portion:
                yield b.filter(pa.array([i not in names for i in range(at, at + len(b))]))
                at += len(b)

    return docs.mapInArrow(run, docs.schema)


def longest_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, item_at, length, doc_id, doc_at): the longest run of words that
    an item shares with any document, and where it is in either; of equally long
    ones the earliest in the item, then the least doc_id and place. Items that
    share no word have no row. A shard sends one row an item at most."""
    held = blocks(items, WINDOW, item_col, item_text_col, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in _shards(batches, 1, shard_bytes):
            shard = Shard([b.column(1) for b in portion])
            ids = pa.concat_arrays([b.column(0) for b in portion])
            for broadcast in held:
                block = broadcast.value
                at, length, doc, word = shard.longest(block)
                own = block.item[at]
                names = [block.names[i] for i in own.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(at - block.begins[own]), pa.array(length), ids.take(pa.array(doc)), pa.array(word)], ["item_id", "item_at", "length", "doc_id", "doc_at"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    each = rows.mapInArrow(run, "item_id string, item_at long, length long, doc_id long, doc_at long")
    best = each.groupBy("item_id").agg(F.min(F.struct((-F.col("length")).alias("less"), "item_at", "doc_id", "doc_at")).alias("x"))
    return best.select("item_id", "x.item_at", (-F.col("x.less")).alias("length"), "x.doc_id", "x.doc_at")
