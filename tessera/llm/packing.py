"""Packing documents into sequences by minimum bin slack.

A document's ids are cut at multiples of the capacity: full pieces fill a
sequence each, and the remainders are packed. For each sequence the longest
remainder waiting goes first, and a bitset dynamic program over the multiset of
waiting lengths (each length as often as it waits, by binary splitting) finds
the sum closest to what is left; the counts of each length are traced back.

Work stays where the text is read: each task tokenizes its rows and packs them
in windows of bounded size, so no ids are shuffled and nothing is gathered; a
task that is run again does the same. Only the last sequence of a task may have
more than a few places left.

Defined results: a null text is empty and gives the end id alone; repeated rows
are packed each by itself; sequence ids are unique, not gapless; an empty table
returns no rows. Other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import give_back

CAPACITY = 4096
END_ID = 2
#: Remainders that wait in a task at most, pieces handed on and texts tokenized at once.
WINDOW = 4096
PIECES_AT_ONCE = 1024
BATCH = 1024
#: Words that a worker remembers, and their bytes.
REMEMBERED = 250_000
REMEMBERED_BYTES = 1 << 24
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

_loaded: dict[str, WordTokenizer] = {}


@lru_cache(maxsize=1)
def not_folded() -> str:
    """A pattern for what keeps a text from being folded: marks, special tokens,
    letters that lower-casing or normalising turns into a letter and a mark, and
    the one whose lower case depends on what follows it."""
    apart = [c for c in map(chr, range(0x80, 0x30000)) if c.isalpha() and any(unicodedata.category(x)[0] == "M" for x in unicodedata.normalize("NFC", c.lower()))]
    return r"\pM|<\||[\x{03A3}" + "".join(f"\\x{{{ord(c):X}}}" for c in apart) + "]"


class WordTokenizer:
    """A tokenizer that drops white space and never joins what it separates, so
    that a text's ids are those of its words. Each distinct word of a batch is
    looked up once; words are remembered from batch to batch, as Arrow and NumPy
    arrays of bounded size, those that many batches have the longest.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.pool = np.zeros(0, "<u4")
        self.sizes = self.starts = self.hits = np.zeros(0, np.int64)

    def _keep_common(self) -> None:
        """Forgets words that one batch only has had, and where that isn't enough
        the less common half of the others."""
        least = max(2, int(np.median(self.hits[self.hits > 1])) + 1 if (self.hits > 1).sum() > REMEMBERED // 2 else 2)
        keep = self.hits >= least
        sizes, starts = self.sizes[keep], self.starts[keep]
        begins = np.cumsum(sizes) - sizes
        self.pool = self.pool[np.repeat(starts - begins, sizes) + np.arange(int(sizes.sum()))]
        self.words, self.sizes, self.starts, self.hits = self.words.filter(pa.array(keep)), sizes, begins, self.hits[keep] // 2
        if self.words.nbytes + self.pool.nbytes > REMEMBERED_BYTES:
            self._forget()

    @classmethod
    def at(cls, path: str) -> WordTokenizer:
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def _learn(self, words: pa.Array) -> None:
        """Appends distinct words that aren't remembered, with their ids."""
        for at in range(0, len(words), 20_000):
            part = words.slice(at, 20_000)
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(part.to_pylist(), add_special_tokens=False)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), "<u4", int(sizes.sum()))])
            self.words = pa.concat_arrays([self.words, part])

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where each of some distinct words is remembered."""
        if len(self.words) > REMEMBERED or self.words.nbytes + self.pool.nbytes > REMEMBERED_BYTES:
            self._keep_common()
        at = pc.index_in(words, value_set=self.words)
        new, known = at.is_null(), len(self.words)
        self._learn(words.filter(new))
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        at[at < 0] = np.arange(known, len(self.words))
        self.hits = np.append(self.hits, np.zeros(len(self.words) - known, np.int64))
        self.hits[at] += 1
        return at

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        texts = texts.cast(pa.large_string())
        odd = pc.match_substring_regex(texts, not_folded()).to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        for mask, fold in ((odd, False), (~odd, True)):
            if mask.any():
                for i, ids in zip(np.flatnonzero(mask).tolist(), self._encode(texts.filter(pa.array(mask)), fold)):
                    out[i] = ids
        return out

    def _encode(self, texts: pa.Array, fold: bool) -> list[np.ndarray]:
        # letters fold and end before a stop or comma in the tokenizer too, so
        # fewer distinct words do; not where marks combine or special tokens hide
        if fold:
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), r"(\pL)([.,])", r"\1 \2")
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        at = self._places(words.dictionary)[words.indices.to_numpy(zero_copy_only=False)]
        each = self.sizes[at]
        ends = np.concatenate([[0], np.cumsum(each)])
        tokens = self.pool[np.repeat(self.starts[at] - ends[:-1], each) + np.arange(ends[-1])]
        bounds = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [tokens[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How often to take each length so that the sum comes closest to room, from
    below: the first such multiset with the lengths in falling order."""
    reach, full, layers = 1, (1 << (room + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        left, take = min(counts[length], room // length), 1
        while left > 0:
            k = min(take, left)
            layers.append((length, k, reach))
            reach |= (reach << (length * k)) & full
            left -= k
            take *= 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, defaultdict(int)
    for length, k, before in reversed(layers):
        if not before >> total & 1:
            out[length] += k
            total -= length * k
    return dict(out)


def pack_window(waiting: dict[int, list], capacity: int, keep: int) -> Iterator[list]:
    """Sequences of the waiting items (by length, changed in place), until at
    most ``keep`` ids wait."""
    counts = {length: len(items) for length, items in waiting.items() if items}
    total = sum(length * n for length, n in counts.items())
    lengths = sorted(counts)
    while total > keep:
        while not counts[lengths[-1]]:
            lengths.pop()
        first = lengths[-1]
        counts[first] -= 1
        taken = best_fill({k: counts[k] for k in lengths if counts[k] and k <= capacity - first}, capacity - first)
        picked = [waiting[first].pop()]
        for length, k in taken.items():
            counts[length] -= k
            picked += [waiting[length].pop() for _ in range(k)]
        total -= first + sum(length * k for length, k in taken.items())
        yield picked


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a piece: doc_id, start (ids of the document before it), length,
    doc_tokens, sequence_id, offset (place in the sequence), ids (binary,
    little-endian unsigned 32-bit)."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.at(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 32
        out: list[tuple] = []
        waiting: dict[int, list] = defaultdict(list)
        n_waiting = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            kinds = [pa.int64()] * 6 + [pa.binary()]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        def place(pieces: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, total, ids in pieces:
                out.append((doc, start, len(ids) // 4, total, sequence, offset, ids))
                offset += len(ids) // 4
            sequence += 1

        def settle(keep: int) -> Iterator[pa.RecordBatch]:
            nonlocal n_waiting
            for pieces in pack_window(waiting, capacity, keep):
                n_waiting -= len(pieces)
                place(pieces)
                if len(out) >= PIECES_AT_ONCE:
                    yield flush()

        for b in batches:
            docs_ids, texts = b.column(0).to_pylist(), b.column(1)
            for at in range(0, len(docs_ids), BATCH):
                encoded = tokenizer.encode(texts.slice(at, BATCH).fill_null(""))
                for doc, ids in zip(docs_ids[at : at + BATCH], encoded):
                    ids = ids.tobytes() + end
                    total = len(ids) // 4
                    whole = total // capacity * capacity
                    for start in range(0, whole, capacity):
                        place([(doc, start, total, ids[4 * start : 4 * (start + capacity)])])
                    if total > whole:
                        waiting[total - whole].append((doc, whole, total, ids[4 * whole :]))
                        n_waiting += 1
                    if len(out) >= PIECES_AT_ONCE:
                        yield flush()
                if n_waiting >= WINDOW:
                    yield from settle(keep=WINDOW // 8 * capacity // 8)
            give_back()
        yield from settle(keep=0)
        if out:
            yield flush()
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def packed_digest(pieces: DataFrame) -> DataFrame:
    """pieces without their ids, with ids_crc32 instead."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
