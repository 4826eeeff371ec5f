"""Language identification word by word, by a linear-chain CRF.

Each word is described by its characters' n-grams with marks at both ends (so
affixes are n-grams too) and by itself, as an entry of the learned lexicon, all
hashed. Transitions between languages are learned on sequences in which pieces
of labelled documents follow one another, as in code-switched text. A document
gets the language with the largest sum of posteriors over its words
(forward-backward over the whole text), and the mean of them as score.

The model is fitted on the driver from a bounded sample of labelled rows:
``per_lang`` documents a language and ``max_docs`` in all, of which whole
documents are used up to ``max_words`` words. Everything else covers all rows.

Defined results: a text that is null or has no letter is ``und`` with score 0,
as is every text if no labelled row can be learned from; equal sums go to the
language that comes first by code point; repeated rows return repeated rows;
rows without doc_id are never learned from and never held out; an empty table
returns no rows. Only doc_id and text are read for a prediction.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import give_back, unit
from tessera.llm.crf import Bag, Chain

LETTERS = re.compile(r"[^\W\d_]+")
ORDERS = 4
GRAMS = 1 << 16
LEXICON = 1 << 16
#: Characters and distinct words worked on at once.
CHARS_AT_ONCE = 1_000_000
ITEMS_AT_ONCE = 40_000
#: Words before and behind a stretch of a long text that are read with it.
BESIDE = 50
UNDETERMINED = "und"


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of doc_id as text leaves 1 modulo 3; false without doc_id."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def word_bags(words: list[str]) -> list[Bag]:
    """Hashed features of distinct words, none of them empty."""
    chars = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    ends = np.repeat(starts + sizes, sizes)
    n, at = len(chars), np.arange(len(chars))
    bags, h = [], np.zeros(n, np.uint64)
    whole = np.zeros(len(words), np.uint64)
    for order in range(1, ORDERS + 1):
        shifted = np.zeros(n, np.uint64)
        shifted[: n - order + 1] = chars[order - 1 :]
        h = (h ^ shifted) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        buckets = ((h >> np.uint64(11)) & np.uint64(GRAMS - 1)).astype(np.int64)
        inside = at + order <= ends
        bags.append(Bag(np.where(inside, buckets, -1), starts))
        # of the word's own grams only: a word's features don't depend on the next one
        whole = whole * np.uint64(31) + np.add.reduceat(np.where(inside, h, np.uint64(0)) * (np.uint64(2) * (at - np.repeat(starts, sizes)).astype(np.uint64) + np.uint64(1)), starts)
    whole = (whole ^ (whole >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    bags.append(Bag((GRAMS + ((whole >> np.uint64(20)) & np.uint64(LEXICON - 1))).astype(np.int64), np.arange(len(words))))
    return bags


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def labelled_sample(docs: DataFrame, per_lang: int = 300, max_docs: int = 4000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """(lang, text) of at most max_docs labelled rows that aren't held out.

    Rows are thinned by a hash of doc_id to some four times per_lang a language
    before they are ranked, so that no task ranks all rows of a language. At
    most max_docs languages are counted, those with the most rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    may = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = may.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_docs)
    thin = may.select("doc_id", "lang").join(F.broadcast(counts), "lang").filter(unit(F.xxhash64("doc_id")) * F.col("count") <= 4 * per_lang)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = thin.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_lang)
    ids = ids.orderBy("nth", "lang", "doc_id").limit(max_docs).select("doc_id").distinct()
    # at most max_docs ids are broadcast; the second limit is for ids that repeat, and takes the same rows each time
    return [(r.lang, r.text or "") for r in may.join(F.broadcast(ids), "doc_id").select("lang", "text", "doc_id").orderBy("doc_id", "lang", "text").limit(max_docs).collect()]


def fit(sample: list[tuple[str, str]], max_words: int = 200_000, seed: int = 11, rounds: int = 30) -> Chain | None:
    """A chain over the languages of (lang, text) pairs; None without any word."""
    rng = random.Random(seed)
    by_lang: dict[str, list[list[str]]] = {}
    for lang, text in sample:
        if ws := words_of(text):
            by_lang.setdefault(lang, []).append(ws)
    if not by_lang:
        return None
    langs = sorted(by_lang)
    pieces, each = [], max_words // len(langs)
    for k, lang in enumerate(langs):
        used = 0
        for ws in by_lang[lang]:
            if used and used + len(ws) > each:
                continue
            used += len(ws)
            at = 0
            while at < len(ws):
                size = rng.randint(4, 40)
                pieces.append((k, ws[at : at + size]))
                at += size
    rng.shuffle(pieces)
    index: dict[str, int] = {}
    items, gold, lens = [], [], []
    for i in range(0, len(pieces), 5):
        for k, ws in pieces[i : i + 5]:
            items += [index.setdefault(w, len(index)) for w in ws]
            gold += [k] * len(ws)
        lens.append(len(items) - sum(lens))
    chain = Chain.new(langs, GRAMS + LEXICON)
    return chain.fit(word_bags(list(index)), np.array(items), np.array(gold), np.array(lens), rounds)


def stretches(text: str) -> Iterator[tuple[list[str], int, int]]:
    """(words, first, end): a text's words by stretches of ``CHARS_AT_ONCE``
    characters, with up to ``BESIDE`` of those before and behind it; first and
    end bound its own. Beyond so many words nothing is left of a neighbour's
    influence, so a text of any length is read in bounded memory."""
    at, n = 0, len(text)
    while at < n:
        end = min(n, at + CHARS_AT_ONCE)
        if end < n and (rest := LETTERS.match(text, end)):
            end = rest.end()  # the word that goes on is its own
        low, high = max(0, at - 12 * BESIDE), min(n, end + 12 * BESIDE)
        before, own, after = words_of(text[low:at])[low > 0 :], words_of(text[at:end]), words_of(text[end:high])
        before, after = before[-BESIDE:], after[: len(after) - (high < n)][:BESIDE]
        yield [*before, *own, *after], len(before), len(before) + len(own)
        at = end


def _label(chain: Chain, texts: pa.Array, with_words: bool = False):
    """For each text its sums of posteriors and number of words, and, if asked
    for, its words' labels. Stretches of like length are worked on together,
    some ``CHARS_AT_ONCE`` at a time."""
    size = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    sums, counts = np.zeros((len(texts), len(chain.labels))), np.zeros(len(texts), np.int64)
    labels: list[list[str]] = [[] for _ in range(len(texts))] if with_words else []

    def work(pieces: list[tuple[int, list[str], int, int]]) -> None:
        pieces = [p for p in pieces if p[3] > p[2]]
        if not pieces:
            return
        lens = np.array([len(p[1]) for p in pieces])
        index: dict[str, int] = {}
        items = np.fromiter((index.setdefault(w, len(index)) for p in pieces for w in p[1]), np.int64, int(lens.sum()))
        distinct = list(index)
        scores = np.concatenate([chain.emissions(word_bags(distinct[j : j + ITEMS_AT_ONCE])) for j in range(0, len(distinct), ITEMS_AT_ONCE)])
        gamma = chain.marginals(scores[items], lens)
        begins = np.cumsum(lens) - lens
        own = np.stack([begins + [p[2] for p in pieces], begins + [p[3] for p in pieces]], axis=1)
        # what lies between one piece's own words and the next one's is summed too, and left out
        found = np.add.reduceat(np.concatenate([gamma, np.zeros_like(gamma[:1])]), own.ravel(), axis=0, dtype=np.float64)[::2]
        for (i, _, first, end), f, (lo, hi) in zip(pieces, found, own):
            sums[i] += f
            counts[i] += end - first
            if with_words:
                labels[i] += [chain.labels[k] for k in gamma[lo:hi].argmax(axis=1)]

    order = np.argsort(-size, kind="stable")
    waiting, chars = [], 0
    for i in order[size[order] > 0].tolist():
        for words, first, end in stretches(texts[i].as_py()):
            waiting.append((i, words, first, end))
            chars += min(int(size[i]), CHARS_AT_ONCE)
            if chars >= CHARS_AT_ONCE:
                work(waiting)
                waiting, chars = [], 0
    work(waiting)
    return sums, counts, labels


def identify(docs: DataFrame, chain: Chain | None, with_words: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row, and word_langs if with_words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            if chain is None:
                found, scores, labels = [UNDETERMINED] * len(texts), [0.0] * len(texts), [[] for _ in texts]
            else:
                sums, lens, labels = _label(chain, texts, with_words)
                best = sums.argmax(axis=1)
                found = [chain.labels[k] if n else UNDETERMINED for k, n in zip(best, lens)]
                scores = np.clip(sums.max(axis=1) / np.maximum(lens, 1), 0.0, 1.0)
            columns = [b.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            names = ["doc_id", "lang_pred", "score"]
            if with_words:
                columns, names = [*columns, pa.array(labels, pa.list_(pa.string()))], [*names, "word_langs"]
            yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double" + ", word_langs array<string>" * with_words)


def accepted(docs: DataFrame, chain: Chain | None, least: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, whose language was found with a
    score of ``least`` or more. Rows are labelled where they are: no join."""
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if chain is None:
                continue
            sums, lens, _ = _label(chain, b.column(at))
            yield b.filter(pa.array((lens > 0) & (sums.max(axis=1) >= least * np.maximum(lens, 1))))
        give_back()

    return docs.mapInArrow(run, schema)
