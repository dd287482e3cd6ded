"""Merging Burrows-Wheeler transforms of string collections by interleave refinement (numpy, inside tasks).

Strings are cut into symbols of ``width`` bytes at each of ``width`` phases,
so every byte position but the last few begins a row of the transform. Rows
are the suffixes of these symbol strings, each string with an end mark of its
own. Shards are sorted on their own. Merging keeps the order within each shard
and finds how their rows interleave: the interleave (one shard number a row)
starts as shard after shard, and each round deals it out stably by the symbols
of the transforms read in its order. After k rounds it is sorted by the first
k symbols; block borders that appear in round k have a common prefix of k - 1
symbols with the row before, and never move again. No suffix is compared or
sorted anew.
"""

from __future__ import annotations

import numpy as np

#: Bytes that one number holds.
_WORD = 5

def stable_order(values: np.ndarray) -> np.ndarray:
    """Stable order of small non-negative integers, 16 bits a pass, or 8 if they fit."""
    most = int(values.max(initial=0))
    if most <= 0xFF:
        return np.argsort(values.astype(np.uint8), kind="stable")
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    if most > 0xFFFF:
        order = order[np.argsort((values[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def _packed(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` bytes from each of ``at`` as one number, most significant first."""
    out = np.zeros(len(at), np.uint64)
    for i in range(width):
        out = (out << np.uint64(8)) | data[at + i]
    return out


def _numbered(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


class Rows:
    """Rows of a collection: one for each symbol of each string, then one for each end mark."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int):
        lengths = np.diff(offsets)
        count = np.maximum(0, lengths - width + 1)  # symbols of each string, over all phases
        string = np.repeat(np.arange(len(lengths)), count)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = offsets[string] + within
        code = _numbered(_packed(data, at, min(width, _WORD)))
        for i in range(_WORD, width, _WORD):  # wider symbols: the number of their front, then the next bytes
            rest = _numbered(_packed(data, at + i, min(width - i, _WORD)))
            code = _numbered(code.astype(np.uint64) * np.uint64(len(at) + 1) + rest.astype(np.uint64))
        self.code = code.astype(np.int64) + 1  # 0 is the end mark
        self.string, self.within, n = string, within, len(at)
        phase = within % width
        ends = string * width + phase  # the end mark of each row's phase
        used, end_of = np.unique(ends, return_inverse=True)
        self.n, self.marks = n, len(used)
        last = within + width >= count[string]
        row = np.arange(n)
        #: the row that follows, an end mark after the last symbol; end marks follow themselves
        self.after = np.r_[np.where(last, n + end_of, row + width), n + np.arange(self.marks)]
        #: the symbol before each row; 0 before the first
        before = np.zeros(n + self.marks, np.int64)
        inner = np.flatnonzero(~last)
        before[row[inner] + width] = self.code[inner]
        before[n + end_of[last]] = self.code[np.flatnonzero(last)]
        self.before = before
        self.mark_string = used // width


def shard_order(rows: Rows, shard: np.ndarray) -> np.ndarray:
    """Rows in order of (shard, suffix), by doubling the symbols compared; ``shard`` is by row."""
    rank = np.r_[rows.code + rows.marks, np.arange(rows.marks)]
    rank = rank + shard.astype(np.int64) * (rank.max() + 1 if len(rank) else 1)
    after = rows.after
    while True:
        order = np.argsort(rank, kind="stable")
        new = np.ones(len(rank), bool)
        new[1:] = rank[order][1:] != rank[order][:-1]
        dense = np.empty(len(rank), np.int64)
        dense[order] = np.cumsum(new) - 1
        if new.all():
            return order
        rank = dense * (len(rank) + 1) + dense[after]
        after = after[after]


def merge(rows: Rows, order: np.ndarray, shard: np.ndarray, rounds: int):
    """(position of each of ``order`` in the merged transform, common symbols with the row before, capped at ``rounds``)."""
    bwt = rows.before[order]
    of = shard[order].astype(np.int64)
    marks_of = np.sort(shard[rows.n:]).astype(np.int64)
    m = rows.marks
    z, block = of.copy(), np.zeros(len(of), np.int64)
    common = np.full(len(of), rounds, np.int64)
    common[:1] = 0
    known = np.zeros(len(of), bool)
    known[:1] = True
    for k in range(1, rounds + 1):
        read = stable_order(z)
        symbols = np.empty(len(z), np.int64)
        symbols[read] = bwt  # the transforms, read in the order of the interleave
        deal = stable_order(symbols)
        s, b = symbols[deal], block[deal]
        border = np.ones(len(z), bool)
        border[1:] = (s[1:] != s[:-1]) | (b[1:] != b[:-1])
        border[:m + 1] = True  # end marks differ from one another
        z = z[deal]
        z[:m] = marks_of
        fresh = border & ~known
        common[fresh] = k - 1
        known |= border
        block = np.cumsum(border) - 1
        if known.all():
            break
    at = np.empty(len(z), np.int64)
    at[:] = stable_order(z)
    return at, common


def repeated(data: np.ndarray, offsets: np.ndarray, shard_of_string: np.ndarray, length: int):
    """Repeated intervals of ``length`` bytes: (interval, string, position) of each row in one.

    Strings are those of ``data`` between ``offsets``; intervals are numbered
    in lexicographic order, and every position from which ``length`` bytes of
    its string occur elsewhere too is in exactly one.
    """
    width = next(w for w in (10, 5, 4, 3, 2, 1) if length % w == 0)
    rows = Rows(data, offsets, width)
    none = np.empty(0, np.int64)
    if not rows.n:
        return none, none, none
    shard = shard_of_string[np.r_[rows.string, rows.mark_string]]
    order = shard_order(rows, shard)
    at, common = merge(rows, order, shard, length // width)
    merged = np.empty(len(order), np.int64)
    merged[at] = order
    begins = np.flatnonzero(common < length // width)
    size = np.diff(np.r_[begins, len(common)])
    pick = np.repeat(size > 1, size)
    interval = np.repeat(np.arange(len(begins)), size)[pick]
    row = merged[pick]
    return interval, rows.string[row], rows.within[row]


