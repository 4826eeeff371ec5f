"""Suffix arrays over the words of a portion of training text, in NumPy.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased: in
UTF-8 that is a rule on single bytes, so texts are cut into words without
decoding them. Words that the test items don't have are one foreign word, which
no match goes across; suffixes that begin with it can't match and are left out
of the array.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np

_BYTES = np.arange(256, dtype=np.uint8)
#: Each byte's lower-case form, and whether it is part of a word.
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IN_WORD = (LOWER >= 128) | ((LOWER >= 97) & (LOWER <= 122)) | ((LOWER >= 48) & (LOWER <= 57))
#: Words of up to two lanes of eight bytes are compared as numbers.
SHORT = 16
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
FILTER_BITS = 20


@dataclass
class Words:
    """The words of several texts: where each begins and ends among the
    lower-cased bytes, and with which word each text begins."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than there are texts

    def __len__(self) -> int:
        return len(self.starts)


def cut(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of the texts that lie one after another in data (UTF-8)."""
    low = LOWER[data]
    inside = IN_WORD[data]
    new = np.zeros(len(data) + 1, bool)
    new[offsets] = True  # no word goes from one text into the next
    before = np.r_[False, inside]
    after = np.r_[inside, False]
    starts = np.flatnonzero(after & (~before | new))
    ends = np.flatnonzero(before & (~after | new))
    return Words(np.r_[low, np.zeros(SHORT, np.uint8)], starts, ends, np.searchsorted(starts, offsets))


def of_texts(texts: Sequence[bytes]) -> Words:
    return cut(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))


def _lanes(w: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers of eight bytes for each of the short words; no word has a
    byte nil, so they stand for it exactly."""
    eight = np.ndarray((len(w.data) - 7,), "<u8", w.data, strides=(1,))
    starts, length = w.starts[which], w.ends[which] - w.starts[which]
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    a = eight[starts] & masks[np.minimum(length, 8)]
    b = eight[starts + 8] & masks[np.clip(length - 8, 0, 8)]
    return a, b


@dataclass
class Vocabulary:
    """Numbers from 1 of the distinct words of the test items."""

    hashes: np.ndarray
    lanes: tuple[np.ndarray, np.ndarray]
    numbers: np.ndarray
    long: dict[bytes, int]
    maybe: np.ndarray
    size: int
    lengths: frozenset[int] = field(default_factory=frozenset)

    @classmethod
    def of(cls, w: Words) -> tuple[Vocabulary, np.ndarray]:
        """The vocabulary of w, and the number of each word of w."""
        out = np.zeros(len(w), np.int64)
        short = np.flatnonzero(w.ends - w.starts <= SHORT)
        a, b = _lanes(w, short)
        pairs, inverse = np.unique(np.stack([a, b], 1), axis=0, return_inverse=True)
        out[short] = inverse.ravel() + 1
        long: dict[bytes, int] = {}
        for i in np.flatnonzero(w.ends - w.starts > SHORT).tolist():
            out[i] = long.setdefault(w.data[w.starts[i] : w.ends[i]].tobytes(), len(pairs) + 1 + len(long))
        h = _mixed(pairs[:, 0], pairs[:, 1])
        order = np.argsort(h, kind="stable")
        maybe = np.zeros(1 << FILTER_BITS, bool)
        maybe[h >> np.uint64(64 - FILTER_BITS)] = True
        lanes = (pairs[order, 0], pairs[order, 1])
        return cls(h[order], lanes, order + 1, long, maybe, len(pairs) + len(long), frozenset(map(len, long))), out

    def numbered(self, w: Words) -> np.ndarray:
        """The number of each word of w, nil for one that the items don't have."""
        out = np.zeros(len(w), np.int32)
        length = w.ends - w.starts
        short = np.flatnonzero(length <= SHORT)
        a, b = _lanes(w, short)
        h = _mixed(a, b)
        may = np.flatnonzero(self.maybe[h >> np.uint64(64 - FILTER_BITS)])
        if len(may) and len(self.hashes):
            a, b, h = a[may], b[may], h[may]
            at = np.searchsorted(self.hashes, h)
            while True:  # words of one hash lie side by side
                inside = np.minimum(at, len(self.hashes) - 1)
                same = (self.lanes[0][inside] == a) & (self.lanes[1][inside] == b)
                go_on = ~same & (inside + 1 < len(self.hashes)) & (self.hashes[inside] == h)
                if not go_on.any():
                    break
                at = np.where(go_on, at + 1, at)
            out[short[may[same]]] = self.numbers[inside[same]]
        if self.long:
            wanted = np.flatnonzero(length > SHORT)
            wanted = wanted[np.isin(length[wanted], list(self.lengths))]
            for i in wanted.tolist():
                out[i] = self.long.get(w.data[w.starts[i] : w.ends[i]].tobytes(), 0)
        return out


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (b * MIX[1])) * MIX[0]
    return (h ^ (h >> np.uint64(29))) * MIX[1]


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions whose word isn't foreign (0), ordered by the words from there on
    up to the next foreign word, at least depth words deep. ids ends with a 0.

    The first key packs as many words as 62 bits hold; then prefix doubling
    sorts only those that are still tied and go on.
    """
    where = np.flatnonzero(ids)
    if not len(where):
        return where
    width = int(ids.max()).bit_length()
    reach = max(1, 62 // width)
    key, alive = np.zeros(len(where), np.int64), np.ones(len(where), bool)
    for j in range(reach):
        at = where + j
        word = np.where(alive & (at < len(ids)), ids[np.minimum(at, len(ids) - 1)], 0)
        alive &= word > 0
        key = key << width | word
    order = np.argsort(key, kind="stable")
    where, key = where[order], key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    group = np.maximum.accumulate(np.where(new, np.arange(len(where)), 0))
    foreign = np.flatnonzero(ids == 0)
    end = foreign[np.searchsorted(foreign, where)]  # where the run of known words ends
    rank = np.zeros(len(ids) + 1, np.int64)
    rank[where] = group + 1
    while reach < depth:
        tied = (group == np.r_[group[1:], -1]) | (group == np.r_[-1, group[:-1]])
        open_groups = np.zeros(len(where), bool)
        open_groups[group[tied & (where + reach < end)]] = True
        todo = np.flatnonzero(tied & open_groups[group])
        if not len(todo):
            break
        at = where[todo] + reach
        then = np.where(at < end[todo], rank[np.minimum(at, len(ids))], 0)
        order = np.lexsort((then, group[todo]))
        moved = where[todo[order]]
        then, g = then[order], group[todo]  # groups keep their places
        where[todo], end[todo] = moved, end[todo[order]]
        new = np.r_[True, (g[1:] != g[:-1]) | (then[1:] != then[:-1])]
        group[todo] = np.maximum.accumulate(np.where(new, todo, 0))
        rank[where[todo]] = group[todo] + 1
        reach *= 2
    return where


def bounds(ids: np.ndarray, order: np.ndarray, items: np.ndarray, at: np.ndarray, length: np.ndarray, upper: bool) -> np.ndarray:
    """By binary search, for each test suffix (``length`` words of items from
    ``at``) the first place in the suffix array that isn't below it, or with
    upper the first that is above it and doesn't begin with it."""
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(order), np.int64)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        shared = common(ids, order[mid], items, at[open_], length[open_])
        whole = shared == length[open_]
        theirs = ids[np.minimum(order[mid] + shared, len(ids) - 1)]
        ours = items[np.minimum(at[open_] + shared, len(items) - 1)]
        right = np.where(whole, upper, theirs < ours)
        lo[open_[right]] = mid[right] + 1
        hi[open_[~right]] = mid[~right]
    return lo


def common(ids: np.ndarray, place: np.ndarray, items: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """How many words from place on agree with those of the items from at on, up
    to length."""
    shared = np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))
    j = 0
    while open_.size:
        open_ = open_[(j < length[open_]) & (place[open_] + j < len(ids))]
        open_ = open_[ids[place[open_] + j] == items[at[open_] + j]]
        j += 1
        shared[open_] = j
    return shared


def ranges(begin: np.ndarray, end: np.ndarray) -> Iterable[np.ndarray]:
    """(which, place): every place from begin to end of each."""
    n = end - begin
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
