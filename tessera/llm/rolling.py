"""Vectorised words and rolling hashes of a chunk of texts (numpy, inside tasks)."""

from __future__ import annotations

import hashlib

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Odd multipliers of the polynomial hashes; any odd numbers do.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Values whose sums are held at once.
_SEGMENT = 1 << 17
#: Bytes of a word whose place has a row of its own in the tables of word hashes.
_PLACES = 64
_BYTES: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, at least ``n`` of each; one table a base is kept."""
    if base not in _TABLES or len(_TABLES[base][0]) < n:
        size = 1 << max(16, int(n).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _TABLES[base] = both[0], both[1]
    return _TABLES[base]


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h``."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _byte_table(base: int) -> np.ndarray:
    """A random 64-bit value for each (place in its word, byte); one table a base is kept."""
    if base not in _BYTES:
        _BYTES[base] = np.random.default_rng(base).integers(0, 1 << 64, (_PLACES, 256), np.uint64)
    return _BYTES[base]


def tabulated(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of data[begin:end]; the ranges ascend and do not overlap.

    Every byte is replaced by a random value that depends on its place, which no
    repetitive pattern of bytes cancels, unlike the powers of one multiplier.
    Ranges longer than ``_SEGMENT`` are digested by BLAKE2, in constant memory.
    """
    lengths = ends - begins
    if (long := lengths > _SEGMENT).any():
        out = np.empty(len(begins), np.uint64)
        out[~long] = tabulated(data, begins[~long], ends[~long], base)
        key = base.to_bytes(8, "little")
        out[long] = [int.from_bytes(hashlib.blake2b(data[b:e], digest_size=8, key=key).digest(), "little")
                     for b, e in zip(begins[long].tolist(), ends[long].tolist())]
        return out
    out, table, i = np.empty(len(begins), np.uint64), _byte_table(base), 0
    total = np.cumsum(lengths)
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + _SEGMENT)))
        n = lengths[i:j]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        byte = data[np.repeat(begins[i:j], n) + place]
        value = table[np.minimum(place, _PLACES - 1), byte]
        far = place >= _PLACES
        if far.any():
            value[far] = mixed(value[far] + mixed(place[far].astype(np.uint64)))
        out[i:j] = np.add.reduceat(value, first)
        i = j
    return mixed(out + mixed(lengths.astype(np.uint64)))


def spans(values: np.ndarray, begins: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of values[begin:end]; begins and ends ascend."""
    out = np.empty(len(begins), np.uint64)
    i = 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(begins, begins[i] + _SEGMENT)))
        a, z = int(begins[i]), int(ends[i:j].max())
        up, down = powers(base, z - a + 1)
        total = np.zeros(z - a + 1, np.uint64)
        np.cumsum((values[a:z].astype(np.uint64) + np.uint64(1)) * up[: z - a], out=total[1:])
        b = begins[i:j] - a
        out[i:j] = (total[ends[i:j] - a] - total[b]) * down[b]
        i = j
    return mixed(out)


class Chunk:
    """The words of several texts laid end to end; words of different texts never share a window."""

    def __init__(self, texts: list[bytes], fold: bytes | None = None):
        """``fold`` maps each byte before words are cut, as ``bytes.translate`` does."""
        joined = b" " + b" ".join(texts) + b" "
        self.data = np.frombuffer(joined.translate(fold) if fold else joined, np.uint8)
        word = ~_SPACE[self.data]
        edges = np.flatnonzero(word[1:] != word[:-1]) + 1
        self.begins, self.ends = edges[::2], edges[1::2]
        #: first byte of each text
        self.text_at = at = np.cumsum([1] + [len(t) + 1 for t in texts])
        #: first word of each text, and one past the last of all
        self.offsets = np.searchsorted(self.begins, at).astype(np.int64)
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.offsets))

    def word_hashes(self, base: int) -> np.ndarray:
        return tabulated(self.data, self.begins, self.ends, base)

    def windows(self, size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first word) of every window of ``size`` words of one text."""
        n = len(self.begins)
        if n < size:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        at = np.arange(n - size + 1)
        at = at[self.text_of[at] == self.text_of[at + size - 1]]
        w = self.word_hashes(base)
        return spans(w, at, at + size, base ^ 0x5851F42D4C957F2C), at


def planes(a: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, so that a codec sees the zero ones."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()


def from_planes(b: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def groups(*keys: np.ndarray) -> np.ndarray:
    """Begins of the runs of equal rows in sorted ``keys``."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def per_group(ufunc, values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """``ufunc`` over each group, given to each of its rows."""
    return np.repeat(ufunc.reduceat(values, begins), np.diff(np.r_[begins, len(values)]))


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges, as ranges that neither overlap nor touch."""
    order = np.argsort(begins, kind="stable")
    b, e = begins[order], np.maximum.accumulate(ends[order]) if len(order) else ends
    cut = np.flatnonzero(b[1:] > e[:-1]) + 1
    return b[np.r_[0, cut]] if len(b) else b, e[np.r_[cut - 1, len(b) - 1]] if len(b) else e
