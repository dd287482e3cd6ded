"""Suffix-array dedup of byte strings by merging shard Burrows-Wheeler transforms.

A byte goes if it lies in a ``length``-byte string that starts earlier too: in
a smaller doc_id, or further up the same text.

1. Candidates. In each string the least of its 32-byte hashes (the rightmost of
   equal ones) is its anchor: equal strings have equal anchors at the same
   place, so a string whose anchor occurs nowhere else cannot repeat and needs
   no suffix. Neighbouring strings share anchors, so about one position in 35
   is exchanged, packed by chunk and shard of the hash range. An anchor found
   more than once in a chunk is sent once for all.
2. Collections. The strings with the same repeated anchor form a segment of at
   most 2 * length bytes. Segments go to the shard of their anchor, equal
   strings thus to the same one. Equal segments are one entry with their first
   place (within a chunk, then within the shard), so a passage that a third
   of all texts hold is one entry a chunk: all places but the first go.
3. Suffix arrays. The distinct segments of anchors that have several are sorted
   a few chunks at a time: the shards of the transform. Their Burrows-Wheeler
   transforms are merged by interleave refinement (``bwt``), which gives the
   common prefixes of neighbouring suffixes and with them the repeated
   intervals of ``length`` bytes. All strings of an interval but the first go.
   Equal segments are found by 96 bits of hash, and their bytes compared.
   The anchor exchange also adds up how many strings the distinct segments of
   an anchor have a chunk. Anchors of more than ``HOT_STRINGS`` (a frequent
   phrase among ever new neighbours) are not left to one shard: their segments
   are cut into strings, dealt by a 96-bit digest of their bytes (BLAKE2),
   first places only, over as many groups as their number asks for. Anchors
   with more than ``LONG_BYTES`` of distinct segments are compared by the same
   digests within their shard, the others by the transforms; the result is one.
4. Removed strings come back by chunk, merge to maximal runs and are cut out.

Texts longer than ``PIECE`` bytes are hashed in pieces that overlap by
``length - 1``, so a chunk is bounded; texts without a candidate are never
shuffled.

Edge cases: a null text is empty; a null doc_id counts as larger than all
others; rows with the same doc_id are compared by start, and repeated rows do
not remove each other's bytes; a text shorter than ``length`` keeps all; a very
long text is hashed in such pieces, so nothing is lost between them; only ``doc_id`` and the text are read, so clashing names
do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bwt import repeated
from tessera.llm.common import discard, written
from tessera.llm.rolling import BASES, from_planes, groups, merged, mixed, per_group, planes, powers
from tessera.llm.substring_dedup import exchange_sizes, keyed, with_blobs

LENGTH = 100
GRAM = 32
PIECE = 1 << 18
#: Bytes whose hashes are held at once.
PART_BYTES = 1 << 17
#: Text bytes behind one packed row of the exchanges, and the least of a chunk or shard.
ROW_BYTES = 1 << 12
LEAST_BYTES = 1 << 16
#: Rows of a transform that are sorted on their own before merging.
SORT_ROWS = 1 << 15
#: Strings from which an anchor is dealt by string, and the strings of one group then.
HOT_STRINGS = 1 << 17
#: Bytes of distinct segments from which an anchor's strings are compared by digest.
LONG_BYTES = 1 << 17
#: Strings that a segment alone in its chunk is taken to have.
_USUAL = 32
_LAST = np.iinfo(np.int64).max
_ENTRIES, _TABLE, _HITS, _STRINGS, _HOT = 0, 1, 2, 3, 4
_NAMES = ["kind", "route", "chunk", "a", "b", "c"]
_SCHEMA = "kind int, route bigint, chunk bigint, a binary, b binary, c binary"
_LOW = np.uint64((1 << 24) - 1)


def _chunks(batches, length: int, size: int):
    """(chunk id, keys, doc_ids, pieces, bases, others): texts cut into overlapping pieces, about ``size`` bytes at a time."""
    part, seq, rows, held = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        for key, doc, text, *other in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or b""
            for base in range(0, max(1, len(text) - length + 1), PIECE):
                rows.append((key, _LAST if doc is None else doc, text[base:base + PIECE + length - 1], base, other))
                held += len(rows[-1][2])
                if held >= size:
                    yield (part << 32) + seq, [list(c) for c in zip(*rows)]
                    rows, held, seq = [], 0, seq + 1
    if rows:
        yield (part << 32) + seq, [list(c) for c in zip(*rows)]


def _slide(a: np.ndarray, size: int, ufunc) -> np.ndarray:
    """``ufunc`` over every window of ``size`` values, by doubling."""
    w = 1
    while 2 * w <= size:
        a = ufunc(a[:-w], a[w:])
        w *= 2
    return ufunc(a[:len(a) - (size - w)], a[size - w:]) if w < size else a


class Hashed:
    """Bytes with the running sums that give the hash of any of their ranges."""

    def __init__(self, data: np.ndarray):
        self.data, n, self.sums = data, len(data), []
        for base in BASES:
            total = np.zeros(n + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, n + 1)[0][:n], out=total[1:])
            self.sums.append(total)

    def hashes(self, begins: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        down = powers(BASES[which], len(self.data) + 1)[1]
        return mixed((self.sums[which][ends] - self.sums[which][begins]) * down[begins])


class Bytes(Hashed):
    """Texts end to end: their offsets, and the anchor of every string of ``length`` bytes in one text."""

    def __init__(self, texts: list[bytes], length: int):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.offsets = _offsets(texts)
        n, gram = len(self.data), min(GRAM, length)
        self.starts = self.anchors = np.empty(0, np.int64)
        if n < length:
            return
        super().__init__(self.data)
        at = np.arange(n - gram + 1)
        self.grams = self.hashes(at, at + gram)
        # 40 bits of hash, then the place in reverse: the least is the rightmost of equal ones
        marked = (self.grams & ~_LOW) | (_LOW - at.astype(np.uint64))
        least = _slide(marked, length - gram + 1, np.minimum)
        starts = np.arange(len(least))
        text = np.searchsorted(self.offsets, starts, "right") - 1
        own = starts + length <= self.offsets[text + 1]
        self.starts = starts[own]
        self.anchors = (_LOW - (least[own] & _LOW)).astype(np.int64)

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, "right") - 1


def _parts(texts: list[bytes]):
    """(begin, end) of runs of ``texts`` of about PART_BYTES."""
    i = held = 0
    for j, t in enumerate(texts, 1):
        held += len(t)
        if held >= PART_BYTES or j == len(texts):
            yield i, j
            i, held = j, 0


def _batch(rows):
    kind, route, chunk, *blobs = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(route, pa.int64()), pa.array(chunk, pa.int64()),
         *(pa.array(b, pa.binary()) for b in blobs)], names=_NAMES)


def _offsets(texts: list[bytes]) -> np.ndarray:
    return np.cumsum([0] + [len(t) for t in texts])


def _table(chunk: int, keys, offsets: np.ndarray, bases):
    return (_TABLE, -1 - chunk, chunk, b"".join(keys), offsets.astype("<i8").tobytes(),
            np.array(bases, "<i8").tobytes())


def _hits(chunk: int, begins: np.ndarray, ends: np.ndarray):
    b, e = merged(begins, ends)
    return _HITS, -1 - chunk, chunk, np.stack([b, e], 1).astype("<u4").tobytes(), b"", b""


def _cuts(shard: np.ndarray):
    b = groups(shard) if len(shard) else np.empty(0, np.int64)
    return zip(shard[b].tolist(), b.tolist(), [*b[1:].tolist(), len(shard)])


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    # anchors are least hashes, which crowd at the low end of their range: mixed again they spread
    return ((mixed(h) >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _anchored(length: int, size: int, shards: int):
    """Chunks to packed anchors.

    ``a``: how many stand alone in their chunk, then the strings of the others' distinct segments; ``b``: hashes,
    ``c``: positions.
    """
    def run(batches):
        for chunk, (keys, _, texts, bases, _) in _chunks(batches, length, size):
            offsets = _offsets(texts)
            rows, ats, hs, ns, bodies = [_table(chunk, keys, offsets, bases)], [], [], [], []
            for i, j in _parts(texts):
                t = Bytes(texts[i:j], length)
                if len(t.starts):
                    run_at = groups(t.anchors, t.text_of(t.starts))
                    n = np.diff(np.r_[run_at, len(t.starts)])
                    at, start = t.anchors[run_at], t.starts[run_at]
                    ats.append(at + offsets[i])
                    hs.append(t.grams[at])
                    ns.append(n)
                    bodies.append(t.hashes(start, start + n - 1 + length))
            if ats:
                h, at, n, body = (np.concatenate(x) for x in (hs, ats, ns, bodies))
                order = np.lexsort((body, h))
                h, at, n, body = h[order], at[order], n[order], body[order]
                g = groups(h)
                several = np.repeat(np.diff(np.r_[g, len(h)]) > 1, np.diff(np.r_[g, len(h)]))
                gone = np.sort(at[several])
                rows.append(_hits(chunk, gone, gone + 1))
                distinct = np.zeros(len(h), bool)
                distinct[groups(h, body)] = True
                strings = np.add.reduceat(n * distinct, g)
                h, at, several = h[g], at[g], several[g]
                shard = _shard(h, shards)
                order = np.lexsort((several, shard))
                h, at, several, shard, strings = (x[order] for x in (h, at, several, shard, strings))
                low = h.astype(np.uint32)
                for s, i, j in _cuts(shard):
                    many = several[i:j]
                    rows.append((_ENTRIES, s, chunk,
                                 int((~many).sum()).to_bytes(4, "little") + planes(strings[i:j][many].astype("<u4")),
                                 low[i:j].tobytes(), planes(at[i:j].astype("<u4"))))
            yield _batch(rows)
    return run


def _answer_anchors(hot_strings: int):
    """Anchors that stand alone in their chunk and occur in another too; and those of more than ``hot_strings``."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["kind"].iat[0] != _ENTRIES:
            return pdf
        h = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["b"]])
        at = np.concatenate([from_planes(x, "<u4") for x in pdf["c"]]).astype(np.int64)
        sizes = [len(x) // 4 for x in pdf["b"]]
        counts = [int.from_bytes(a[:4], "little") for a in pdf["a"]]
        alone = np.concatenate([np.arange(n) < k for k, n in zip(counts, sizes)])
        strings = np.concatenate([x for k, a in zip(counts, pdf["a"]) for x in (np.full(k, _USUAL), from_planes(a[4:], "<u4"))])
        chunk = np.repeat(pdf["chunk"].to_numpy(), sizes)
        order = np.argsort(h)
        h, at, alone, chunk, strings = h[order], at[order], alone[order], chunk[order], strings[order].astype(np.int64)
        g = groups(h)
        hit = alone & (per_group(np.add, np.ones(len(h), np.int64), g) > 1)
        out = _ranges_by_chunk(chunk[hit], at[hit], at[hit] + 1)
        total = np.add.reduceat(strings, g)
        if (total > hot_strings).any():
            most, route = total > hot_strings, int(pdf["route"].iat[0])
            code = (np.int64(route) << np.int64(32)) + h[g][most].astype(np.int64)
            hot = (_HOT, -1, -1, code.astype("<i8").tobytes(), int(total[most].sum()).to_bytes(8, "little"), b"")
            out = pd.concat([out, pd.DataFrame([hot], columns=_NAMES)])
        return out
    return run


def _ranges_by_chunk(chunk, begins, ends) -> pd.DataFrame:
    order = np.argsort(chunk, kind="stable")
    chunk, begins, ends = chunk[order], begins[order], ends[order]
    return pd.DataFrame([_hits(c, begins[i:j], ends[i:j]) for c, i, j in _cuts(chunk)], columns=_NAMES)


def _by_key(pdf: pd.DataFrame) -> pd.DataFrame:
    """Ranges of a chunk, from all shards, to (key, ranges within the text)."""
    out = []
    blobs = pdf.loc[pdf["kind"] == _HITS, "a"]
    r = np.concatenate([np.frombuffer(x, "<u4").reshape(-1, 2) for x in blobs] or [np.empty((0, 2), "<u4")]).astype(np.int64)
    if len(r):
        t = pdf[pdf["kind"] == _TABLE].iloc[0]
        offsets, bases = np.frombuffer(t["b"], "<i8"), np.frombuffer(t["c"], "<i8")
        # ranges of starts never run from one text into the next, but may touch there
        r = r[np.argsort(r[:, 0], kind="stable")]
        text = np.searchsorted(offsets, r[:, 0], "right") - 1
        while (over := r[:, 1] > offsets[text + 1]).any():
            rest = np.stack([offsets[text[over] + 1], r[over, 1]], 1)
            r[over, 1] = rest[:, 0]
            r = np.concatenate([r, rest])
            r = r[np.argsort(r[:, 0], kind="stable")]
            text = np.searchsorted(offsets, r[:, 0], "right") - 1
        for k, i, j in _cuts(text):
            b, e = merged(r[i:j, 0], r[i:j, 1])
            out.append((t["a"][16 * k:16 * k + 16], (np.stack([b, e], 1) - offsets[k] + bases[k]).astype("<i8").tobytes()))
    return pd.DataFrame(out, columns=["key", "blob"])


def _ranges(blobs):
    r = np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in blobs])
    return merged(r[:, 0], r[:, 1])


def _within(at: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    k = np.searchsorted(begins, at, "right") - 1
    return (k >= 0) & (at < ends[np.maximum(k, 0)])


#: One segment of a collection.
_SEGMENT = np.dtype([("anchor", "<u8"), ("h1", "<u8"), ("h2", "<u4"), ("doc", "<i8"), ("start", "<i8"),
                     ("at", "<u4"), ("n", "<u2")])


def _segments_of(texts, ids, bases, others, length: int) -> np.ndarray:
    """The segments of a part of a chunk: runs of strings with the same repeated anchor."""
    t = Bytes(texts, length)
    if not len(t.starts):
        return np.empty(0, _SEGMENT)
    text = t.text_of(t.starts)
    b = groups(t.anchors, text)
    n = np.diff(np.r_[b, len(t.starts)])
    start, anchor, text = t.starts[b], t.anchors[b], text[b]
    hit = np.zeros(len(b), bool)
    for k, i, j in _cuts(text):
        lo, hi = _ranges(others[k][0])
        hit[i:j] = _within(anchor[i:j] - t.offsets[k] + bases[k], lo, hi)
    start, anchor, text, n = start[hit], anchor[hit], text[hit], n[hit]
    end = start + n - 1 + length
    seg = np.empty(len(start), _SEGMENT)
    seg["anchor"], seg["at"], seg["n"] = t.grams[anchor], start, n
    seg["h1"], seg["h2"] = t.hashes(start, end), t.hashes(start, end, 1).astype(np.uint32)
    seg["doc"], seg["start"] = np.array(ids)[text], start - t.offsets[text] + np.array(bases)[text]
    return seg


def _segments(length: int, size: int, shards: int, hot: Hot):
    """Chunks of texts with repeated anchors to packed segments, and to packed strings of hot anchors.

    ``b``: their heads by plane, ``c``: the bytes of segments.
    """
    def run(batches):
        for chunk, (keys, ids, texts, bases, others) in _chunks(batches, length, size):
            offsets = _offsets(texts)
            rows, found = [_table(chunk, keys, offsets, bases)], []
            for i, j in _parts(texts):
                seg = _segments_of(texts[i:j], ids[i:j], bases[i:j], others[i:j], length)
                seg["at"] += np.uint32(offsets[i])
                found.append(seg)
            data = np.frombuffer(b"".join(texts), np.uint8)
            seg = np.concatenate(found)
            first, gone = _firsts(seg, data, seg["at"].astype(np.int64), length)
            if len(gone):
                at = np.sort(gone, order="at")
                rows.append(_hits(chunk, at["at"].astype(np.int64), at["at"].astype(np.int64) + at["n"]))
            cut = hot.has(first["anchor"])
            if cut.any():
                rows += _string_rows(chunk, first[cut], data, length, shards, hot.groups)
                first = first[~cut]
            shard = _shard(first["anchor"], shards)
            order = np.argsort(shard, kind="stable")
            first, shard = first[order], shard[order]
            for s, i, j in _cuts(shard):
                part = first[i:j]
                body = data[_gather(part["at"].astype(np.int64), part["n"].astype(np.int64) + length - 1)]
                rows.append((_ENTRIES, s, chunk, b"", planes(part), body.tobytes()))
            yield _batch(rows)
    return run


def _gather(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _firsts(seg: np.ndarray, data: np.ndarray | None = None, body: np.ndarray | None = None, length: int = 0):
    """Of equal entries the first by (doc, start), with others of the same place, and those after it.

    With ``data`` entries are segments whose bytes begin there at ``body``: those of one hash are compared, and
    told apart by digest if they differ.
    """
    order = np.lexsort((seg["start"], seg["doc"], seg["h2"], seg["h1"]))
    seg = seg[order]
    g = groups(seg["h1"], seg["h2"]) if len(seg) else np.empty(0, np.int64)
    size = np.diff(np.r_[g, len(seg)])
    lead = np.repeat(g, size)
    if data is not None and len(seg):
        body = body[order]
        unlike = _unlike(data, body, seg["n"].astype(np.int64) + length - 1, lead)
        if len(unlike):
            mixed_up = np.isin(lead, lead[unlike])
            for k in np.flatnonzero(mixed_up).tolist():
                d = hashlib.blake2b(data[body[k]:body[k] + int(seg["n"][k]) + length - 1], digest_size=12).digest()
                seg["h1"][k], seg["h2"][k] = int.from_bytes(d[:8], "little"), int.from_bytes(d[8:], "little")
            return _firsts(seg)
    later = (seg["doc"] != seg["doc"][lead]) | (seg["start"] != seg["start"][lead])
    return seg[~later], seg[later]


def _unlike(data: np.ndarray, body: np.ndarray, lengths: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Entries whose bytes are not those of their lead, about PART_BYTES at a time."""
    rest = np.flatnonzero(lead != np.arange(len(lead)))
    out = [rest[lengths[rest] != lengths[lead[rest]]]]
    rest = rest[lengths[rest] == lengths[lead[rest]]]
    total = np.cumsum(lengths[rest])
    for _, i, j in _cuts(total // PART_BYTES):
        k = rest[i:j]
        differ = data[_gather(body[k], lengths[k])] != data[_gather(body[lead[k]], lengths[k])]
        if differ.any():
            out.append(k[np.add.reduceat(differ, np.cumsum(lengths[k]) - lengths[k]) > 0])
    return np.concatenate(out)


class Hot:
    """Anchors that are dealt by string: the shard and 32 bits of each hash, and the groups their strings go to."""

    def __init__(self, codes: np.ndarray, strings: int, shards: int, most: int):
        self.codes, self.shards, self.groups = np.sort(codes), shards, max(1, -(-strings // most))

    def has(self, anchor: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(anchor), bool)
        code = (_shard(anchor, self.shards).astype(np.int64) << np.int64(32)) + anchor.astype(np.uint32).astype(np.int64)
        return self.codes[np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)] == code


#: One string of a hot anchor.
_STRING = np.dtype([("h1", "<u8"), ("h2", "<u4"), ("doc", "<i8"), ("start", "<i8"), ("at", "<u4")])


def _strings_of(seg: np.ndarray, data: np.ndarray, body: np.ndarray, length: int) -> np.ndarray:
    """The strings of ``seg``, whose bytes begin in ``data`` at ``body``, by a digest of their bytes."""
    n = seg["n"].astype(np.int64)
    own = np.repeat(np.arange(len(seg)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = body[own] + within
    out, view = np.empty(len(own), _STRING), memoryview(data)
    digest = b"".join(hashlib.blake2b(view[i:i + length], digest_size=12).digest() for i in at.tolist())
    digest = np.frombuffer(digest, np.dtype([("h1", "<u8"), ("h2", "<u4")]))
    out["h1"], out["h2"] = digest["h1"], digest["h2"]
    out["doc"], out["start"], out["at"] = seg["doc"][own], seg["start"][own] + within, seg["at"][own] + within
    return out


def _string_rows(chunk: int, seg: np.ndarray, data: np.ndarray, length: int, shards: int, parts: int):
    """Packed strings of a chunk's segments, and the hits among them."""
    first, gone = _firsts(_strings_of(seg, data, seg["at"].astype(np.int64), length))
    if len(gone):
        at = np.sort(gone["at"].astype(np.int64))
        yield _hits(chunk, at, at + 1)
    part = (first["h1"] % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    first, part = first[order], part[order]
    for s, i, j in _cuts(part):
        yield _STRINGS, shards + s, chunk, b"", planes(first[i:j]), b""


def _answer_strings(pdf: pd.DataFrame) -> pd.DataFrame:
    strings = [from_planes(x, _STRING) for x in pdf["b"]]
    both = np.empty(sum(map(len, strings)), np.dtype([*_STRING.descr, ("chunk", "<i8")]))
    for f in _STRING.names:
        both[f] = np.concatenate([x[f] for x in strings])
    both["chunk"] = np.repeat(pdf["chunk"].to_numpy(), [len(x) for x in strings])
    gone = _firsts(both)[1]
    gone = gone[np.argsort(gone["at"], kind="stable")]
    at = gone["at"].astype(np.int64)
    return _ranges_by_chunk(gone["chunk"], at, at + 1)


def _answer_segments(length: int, long_bytes: int = LONG_BYTES):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["kind"].iat[0] == _STRINGS:
            return _answer_strings(pdf)
        if pdf["kind"].iat[0] != _ENTRIES:
            return pdf
        seg = np.concatenate([from_planes(x, _SEGMENT) for x in pdf["b"]])
        sizes = [len(x) // _SEGMENT.itemsize for x in pdf["b"]]
        data = np.frombuffer(b"".join(pdf["c"]), np.uint8)
        body = np.cumsum(seg["n"].astype(np.int64) + length - 1)
        body -= seg["n"].astype(np.int64) + length - 1
        both = np.empty(len(seg), np.dtype([*_SEGMENT.descr, ("chunk", "<i8"), ("body", "<i8")]))
        for f in _SEGMENT.names:
            both[f] = seg[f]
        both["chunk"], both["body"] = np.repeat(pdf["chunk"].to_numpy(), sizes), body
        first, gone = _firsts(both, data, body, length)
        out = [(gone["chunk"], gone["at"].astype(np.int64), gone["n"].astype(np.int64))]
        # segments of an anchor that has no other differ in every string from all others
        first = first[np.argsort(first["anchor"], kind="stable")]
        if len(first):
            g = groups(first["anchor"])
            first = first[per_group(np.add, np.ones(len(first), np.int64), g) > 1]
            for part, long in _whole_anchors(first, length, long_bytes):
                out.append((_later_by_digest if long else _later_strings)(part, data, length))
        chunk, at, n = (np.concatenate(x) for x in zip(*out))
        return _ranges_by_chunk(chunk, at, at + n)
    return run


def _whole_anchors(seg: np.ndarray, length: int, long_bytes: int, rows: int = 1 << 17):
    """(segments of whole anchors, whether it is one of more than ``long_bytes``), else about ``rows`` bytes at a time."""
    if not len(seg):
        return
    g = groups(seg["anchor"])
    size = np.add.reduceat(seg["n"].astype(np.int64) + length - 1, g)
    count = np.diff(np.r_[g, len(seg)])
    long = size > long_bytes
    for i, n in zip(g[long].tolist(), count[long].tolist()):
        yield seg[i:i + n], True
    seg, size, count = seg[~np.repeat(long, count)], size[~long], count[~long]
    for _, i, j in _cuts(np.repeat((np.cumsum(size) - size) // rows, count)):
        yield seg[i:j], False


def _later_by_digest(seg: np.ndarray, data: np.ndarray, length: int):
    """What ``_later_strings`` gives, by digests of the strings instead of their order."""
    both = np.empty(int(seg["n"].astype(np.int64).sum()), np.dtype([*_STRING.descr, ("chunk", "<i8")]))
    strings = _strings_of(seg, data, seg["body"], length)
    for f in _STRING.names:
        both[f] = strings[f]
    both["chunk"] = np.repeat(seg["chunk"], seg["n"].astype(np.int64))
    gone = _firsts(both)[1]
    return gone["chunk"], gone["at"].astype(np.int64), np.ones(len(gone), np.int64)


def _later_strings(seg: np.ndarray, data: np.ndarray, length: int):
    """(chunk, position, 1) of every string that an earlier segment has too, from the merged transforms."""
    seg = seg[np.argsort(seg["chunk"], kind="stable")]
    lengths = seg["n"].astype(np.int64) + length - 1
    offsets = np.r_[0, np.cumsum(lengths)]
    shard = offsets[:-1] // SORT_ROWS
    interval, string, within = repeated(data[_gather(seg["body"], lengths)], offsets, shard, length)
    doc, start = seg["doc"][string], seg["start"][string] + within
    order = np.lexsort((start, doc, interval))
    interval, string, within, doc, start = (x[order] for x in (interval, string, within, doc, start))
    g = groups(interval) if len(interval) else np.empty(0, np.int64)
    lead = np.repeat(g, np.diff(np.r_[g, len(interval)]))
    later = (doc != doc[lead]) | (start != start[lead])
    string = string[later]
    return seg["chunk"][string], seg["at"][string].astype(np.int64) + within[later], np.ones(len(string), np.int64)


def _removal(length: int):
    """Texts with the starts of their removed strings to what is left of them."""
    def run(batches):
        for batch in batches:
            out = []
            for key, text, blobs in zip(*(c.to_pylist() for c in batch.columns)):
                b, e = _ranges(blobs)
                b, e = merged(b, e + length - 1)
                kept, last = [], 0
                for i, j in zip(b.tolist(), e.tolist()):
                    kept.append(text[last:i])
                    last = j
                kept = b"".join([*kept, text[last:]])
                out.append((key, int((e - b).sum()), len(b), kept, hashlib.sha256(kept).hexdigest(),
                            np.stack([b, e], 1).tolist()))
            key, n, k, kept, sha, spans = zip(*out) if out else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.binary()), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(sha, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                names=["key", "n_removed", "n_spans", "kept", "kept_sha256", "spans"])
    return run


def candidates(docs: DataFrame, text: str, length: int) -> tuple[DataFrame, Hot, str]:
    """(key, doc_id, text, blobs) of the texts with repeated anchors, the hot anchors and the scratch table."""
    d = keyed(docs, text)
    size, shards = exchange_sizes(d, ROW_BYTES, LEAST_BYTES)
    found, at = written(d.mapInArrow(_anchored(length, size, shards), _SCHEMA).groupBy("route").applyInPandas(
        _answer_anchors(HOT_STRINGS), _SCHEMA), "anchors")
    # eight bytes for each HOT_STRINGS strings of the table at most
    rows = found.filter(F.col("kind") == _HOT).select("a", "b").collect()
    hot = Hot(np.concatenate([np.frombuffer(r["a"], "<i8") for r in rows] or [np.empty(0, np.int64)]),
              sum(int.from_bytes(r["b"], "little") for r in rows), shards, HOT_STRINGS)
    anchors, at2 = written(found.filter(F.col("kind") != _HOT).groupBy("chunk").applyInPandas(
        _by_key, "key binary, blob binary"), "candidates")
    hit, at3 = written(with_blobs(d, anchors).dropDuplicates(["key"]), "hit")
    discard(docs.sparkSession, at, at2)
    return hit, hot, at3


def packed(hit: DataFrame, hot: Hot, length: int) -> DataFrame:
    """Packed segments, and strings of hot anchors, by the group that compares them."""
    return hit.mapInArrow(_segments(length, *exchange_sizes(hit, ROW_BYTES, LEAST_BYTES), hot), _SCHEMA)


def removed(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(key, n_removed, n_spans, kept, kept_sha256, spans) of the rows that lose bytes; spans are byte ranges."""
    spark = docs.sparkSession
    hit, hot, at3 = candidates(docs, text, length)
    found, at = written(packed(hit, hot, length).groupBy("route").applyInPandas(_answer_segments(length, LONG_BYTES), _SCHEMA), "segments")
    gone, at2 = written(found.groupBy("chunk").applyInPandas(_by_key, "key binary, blob binary"), "gone")
    gone = gone.groupBy(F.col("key").alias("__key")).agg(F.collect_list("blob").alias("gone"))
    out = hit.select("key", "text").join(gone, F.col("key") == F.col("__key")).select("key", "text", "gone")
    out, _ = written(out.mapInArrow(
        _removal(length), "key binary, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string, "
                          "spans array<array<bigint>>"), "removed")
    discard(spark, at, at2, at3)
    return out


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lost = removed(docs).select(F.col("key").alias("__key"), "n_removed", "n_spans", "kept_sha256")
    t = F.coalesce("text", F.lit(b""))
    d = keyed(docs).select("key", "doc_id", F.length(t).cast("long").alias("n_bytes"), F.sha2(t, 256).alias("whole"))
    d = d.join(lost, F.col("key") == F.col("__key"), "left")
    return d.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
                    F.coalesce("kept_sha256", "whole").alias("kept_sha256"))


SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT rid, doc_id, i, md5_number(substr(x, CAST(2 * i - 1 AS BIGINT), 200)) AS h
      FROM (SELECT rid, doc_id, x, unnest(range(1, length(x) // 2 - 98)) AS i FROM d WHERE length(x) >= 200)),
r AS (SELECT rid, i FROM (SELECT rid, doc_id, i, first_value(doc_id) OVER o AS fd, first_value(i) OVER o AS fi
      FROM w WINDOW o AS (PARTITION BY h ORDER BY doc_id NULLS LAST, i)) WHERE doc_id IS DISTINCT FROM fd OR i <> fi),
s AS (SELECT rid, i, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i), 1000) > 100 AS fresh FROM r),
t AS (SELECT rid, i, sum(fresh::INT) OVER (PARTITION BY rid ORDER BY i) AS k FROM s),
u AS (SELECT rid, k, min(i) AS b, max(i) + 99 AS e FROM t GROUP BY rid, k),
v AS (SELECT rid, k, b, e, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY k), 0) AS p FROM u),
g AS (SELECT rid, count(*) AS n_spans, sum(e - b + 1) AS n, max(e) AS tail FROM v GROUP BY rid),
k AS (SELECT rid, string_agg(substr(x, CAST(2 * p + 1 AS BIGINT), CAST(2 * (b - 1 - p) AS BIGINT)), '' ORDER BY k)
        || substr(first(x), CAST(2 * first(tail) + 1 AS BIGINT)) AS kept FROM v JOIN g USING (rid) JOIN d USING (rid) GROUP BY rid)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN g USING (rid) LEFT JOIN k USING (rid)
"""
