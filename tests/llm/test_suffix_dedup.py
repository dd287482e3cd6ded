import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import bwt
from tessera.llm import suffix_dedup as S

LAST = float("inf")


def brute(rows, length):
    texts = [(LAST if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in texts:
        for i in range(len(t) - length + 1):
            k = t[i:i + length]
            first[k] = min(first.get(k, (LAST, LAST)), (d, i))
    out = []
    for (d, t), (doc, _) in zip(texts, rows):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if first[t[i:i + length]] < (d, i):
                gone[i:i + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def result(df, rows, length):
    """Rows without a removal are not in ``removed``; they keep all."""
    got = {}
    from tessera.llm.substring_dedup import keyed
    j = keyed(df).join(S.removed(df, length=length), "key", "left")
    for r in j.collect():
        t = bytes(r.text or b"")
        got.setdefault(0, []).append((r.doc_id, len(t), r.n_removed or 0, r.n_spans or 0,
                                      r.kept_sha256 or hashlib.sha256(t).hexdigest()))
    return order(got.get(0, []))


@pytest.mark.parametrize("length,letters,seed", [(3, 4, 1), (10, 2, 2), (40, 2, 3), (35, 1, 4), (100, 2, 5), (7, 3, 6)])
def test_matches_brute_force(spark, monkeypatch, length, letters, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(S, "LEAST_BYTES", 700)
    monkeypatch.setattr(S, "ROW_BYTES", 30)
    monkeypatch.setattr(S, "SORT_ROWS", 150)
    monkeypatch.setattr(S, "PIECE", 150)
    monkeypatch.setattr(S, "PART_BYTES", 300)
    base = ["".join(rng.choice("abéd"[:letters]) for _ in range(rng.randrange(0, 300))) for _ in range(20)]
    rows = [(i, base[i]) for i in range(20)]
    for i in range(40):
        a, b = rng.choice(base), rng.choice(base)
        rows.append((rng.randrange(100), a[rng.randrange(len(a) + 1):] + b[:rng.randrange(len(b) + 1)]))
    rows += rows[:3] + [(None, base[1]), (None, None), (101, ""), (102, base[2] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    exp = order(brute(rows, length))
    assert any(r[2] for r in exp)
    assert result(df, rows, length) == exp


def test_hot_anchor_is_dealt_by_string(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(S, "LONG_BYTES", 2000)
    monkeypatch.setattr(S, "HOT_STRINGS", 500)
    monkeypatch.setattr(S, "LEAST_BYTES", 4000)
    monkeypatch.setattr(S, "PART_BYTES", 3000)
    phrase = "".join(rng.choice("abcd") for _ in range(60))
    word = lambda n: "".join(rng.choice("efgh") for _ in range(n))
    tails = [word(60) for _ in range(8)]
    rows = [(i, word(90) + phrase + (rng.choice(tails) if i % 2 else word(90))) for i in range(300)]
    rows += rows[:3] + [(None, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    exp = order(brute(rows, 100))
    assert sum(r[2] > 0 for r in exp) > 100
    assert result(df, rows, 100) == exp
    # no group holds the segments of the phrase: those of about 150 bytes in each of 300 texts
    hit, hot, _ = S.candidates(df, "text", 100)
    assert 0 < len(hot.codes) < 20
    held = defaultdict(int)
    for r in S.packed(hit, hot, 100).collect():
        held[r.kind, r.route] += len(r.c) if r.kind == S._ENTRIES else len(S.from_planes(bytes(r.b), S._STRING)) if r.kind == S._STRINGS else 0
    assert sum(k == S._STRINGS for k, _ in held) > 10
    assert max(n for (k, _), n in held.items() if k == S._STRINGS) < 3 * S.HOT_STRINGS


def test_equal_hashes_of_unlike_segments():
    """Segments that share a hash but not their bytes are told apart, at the same length and at another."""
    texts = [b"a" * 30, b"b" * 30, b"a" * 30, b"a" * 31, b"b" * 30]
    seg = np.zeros(5, S._SEGMENT)
    seg["doc"], seg["n"] = np.arange(5), [len(t) - 20 + 1 for t in texts]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    seg["at"] = offsets[:-1]
    first, gone = S._firsts(seg, np.frombuffer(b"".join(texts), np.uint8), offsets[:-1], 20)
    assert sorted(first["doc"]) == [0, 1, 3] and sorted(gone["doc"]) == [2, 4]


def test_long_anchors_by_digest(spark, monkeypatch):
    """Anchors too long for the transforms give the same removal."""
    monkeypatch.setattr(S, "LONG_BYTES", 300)
    rng = random.Random(9)
    base = ["".join(rng.choice("ab c") for _ in range(300)) for _ in range(5)]
    rows = [(rng.randrange(90), rng.choice(base)[rng.randrange(200):] + rng.choice(base)[:rng.randrange(300)]) for _ in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(df, rows, 50) == order(brute(rows, 50))


def test_anchors_spread_over_shards():
    rng = random.Random(3)
    t = S.Bytes([bytes(rng.randrange(97, 123) for _ in range(100_000))], 100)
    sizes = np.bincount(S._shard(t.grams[np.unique(t.anchors)], 50).astype(int), minlength=50)
    assert sizes.max() < 2 * sizes.mean()


def test_corpus(clashing, corpus):
    rows = [r[:2] for r in corpus]
    exp = order(brute(rows, 100))
    assert sum(r[2] > 0 for r in exp) >= 10
    assert result(clashing, rows, 100) == exp


def test_empty(empty):
    assert S.removed(empty).collect() == []


def test_merged_transforms_give_repeated_intervals():
    rng = random.Random(5)
    for _ in range(200):
        length = rng.choice([4, 5, 6, 10, 7, 20])
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 40))) for _ in range(rng.randrange(1, 9))]
        strings.append(rng.choice(strings))
        offsets = np.cumsum([0] + [len(s) for s in strings])
        shard = np.sort([rng.randrange(3) for _ in strings])
        got, exp = defaultdict(set), defaultdict(set)
        for i, s, p in zip(*bwt.repeated(np.frombuffer(b"".join(strings), np.uint8), offsets, shard, length)):
            got[i].add((int(s), int(p)))
        for j, x in enumerate(strings):
            for q in range(len(x) - length + 1):
                exp[x[q:q + length]].add((j, q))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in exp.values() if len(v) > 1)


def test_merged_order_is_the_suffix_order():
    rng = random.Random(6)
    strings = [bytes(rng.choice(b"abc") for _ in range(30)) for _ in range(6)]
    offsets = np.cumsum([0] + [len(s) for s in strings])
    rows = bwt.Rows(np.frombuffer(b"".join(strings), np.uint8), offsets, 1)
    shard = np.array([0, 0, 1, 1, 2, 2])[np.r_[rows.string, rows.mark_string]]
    order_ = bwt.shard_order(rows, shard)
    at, common = bwt.merge(rows, order_, shard, 30)
    merged = np.empty(len(at), int)
    merged[at] = order_
    suffix = [strings[s][w:] for s, w in zip(rows.string, rows.within)]
    inner = [r for r in merged if r < rows.n]
    assert [suffix[r] for r in inner] == sorted(suffix)
    for k in range(rows.marks + 1, len(merged)):
        a, b = suffix[merged[k - 1]], suffix[merged[k]]
        n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert common[k] == n
