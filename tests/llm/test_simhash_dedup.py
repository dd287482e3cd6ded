import random
import re

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash_dedup as S


def fingerprint(text, k=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(fps, d):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= d:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def expected(corpus, d=4):
    fps = [fingerprint(r[1]) for r in corpus]
    root = roots(fps, d)
    best = {}
    for r, k in zip(corpus, root):
        if r[0] is not None:
            best[k] = min(best.get(k, r[0]), r[0])
    return [(r[0], f, best.get(k)) for r, f, k in zip(corpus, fps, root)]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def result(docs, **kw):
    return order((r.doc_id, r.fp % (1 << 64), r.component_id) for r in S.assigned(docs, **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"max_bits": 3}, {"max_bits": 0}, {"max_list": 1}])
def test_matches_brute_force(docs, corpus, kw):
    exp = order(expected(corpus, kw.get("max_bits", 4)))
    assert len({c for _, _, c in exp}) < len({f for _, f, _ in exp}) + 1
    assert result(docs, **kw) == exp


def test_forest_joins_what_all_pairs_join():
    rng = random.Random(2)
    for d in (1, 2, 4):
        base = [rng.getrandbits(64) for _ in range(4)]
        fps = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) % (1 << 64) for b in base for _ in range(25)})
        links = list(S._forest(np.array(fps, np.uint64), d, 8 - d))
        where = {f: i for i, f in enumerate(fps)}
        parent = list(range(len(fps)))
        for f, r in links:
            a, b = where[int(f)], where[int(r)]
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            parent[max(a, b)] = min(a, b)
        exp = roots(fps, d)
        got = []
        for i in range(len(fps)):
            while parent[i] != i:
                i = parent[i]
            got.append(i)
        assert len(links) == len(fps) - len(set(exp))
        assert len({*zip(exp, got)}) == len(set(exp)) == len(set(got))


@pytest.mark.parametrize("bits", [3, 4])
def test_middles(spark, bits):
    rng = random.Random(bits)
    base = rng.getrandbits(64)
    fps = [base]
    for _ in range(12):  # a chain, each some bits from one before
        fps.append(rng.choice(fps) ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(1, 6))}))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in set(fps)]
    e = S._through_middles(spark.createDataFrame(signed, "fp long"), bits)
    links = {(r.u % (1 << 64), r.v % (1 << 64)) for r in e.collect()}
    assert all((u ^ v).bit_count() <= bits for u, v in links)
    nodes = sorted(set(fps))
    exp = roots(nodes, bits)
    where, parent = {f: i for i, f in enumerate(nodes)}, list(range(len(nodes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in links:
        a, b = find(where[u]), find(where[v])
        parent[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(nodes))] == exp


def test_stage_keeps_one_of_each(clashing, corpus):
    out = S.stage(clashing)
    assert out.columns == clashing.columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    exp = expected(corpus)
    keep = {c for _, _, c in exp if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(keep)
    # the null rows: one text is linked to the empty ones, the other has a component of its own
    assert ids.count(None) == len({f for d, f, c in exp if c is None})


def test_empty(empty):
    assert result(empty) == []
    assert S.stage(empty).collect() == []


def test_words():
    assert S.simhash(None) == S.simhash(b"") == S.simhash(b" \n\x0b") == 0
    assert S.simhash(b"one two") % (1 << 64) == fingerprint("one two")
    assert S.simhash("É x y z w q".encode()) % (1 << 64) == fingerprint("É x y z w q")
    long = " ".join(str(i % 977) for i in range(70_000))
    assert S.simhash(long.encode()) % (1 << 64) == fingerprint(long)


def test_clashing_names(clashing, corpus):
    assert result(clashing) == order(expected(corpus))


def test_tally_decides():
    """Pairs of a posting list with three shared bytes only are dropped by the tally, one with four is linked."""
    base = 0x0102030405060708
    four, three = base ^ 0x0101010100000000, base ^ 0x0101010101000000
    assert [tuple(map(int, x)) for x in S._forest(np.array([base, four], np.uint64), 4, 4)] == [(four, base)]
    assert list(S._forest(np.array([base, three], np.uint64), 5, 4)) == []


@pytest.mark.parametrize("bits", [0, 1, 4, 7])
def test_links_of_random_fingerprints(spark, bits):
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for _ in range(3):
            fps.add(f ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(9))}))
    fps = sorted(fps)
    edges, _ = S.links(spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long"), bits)
    links = [(r.u % (1 << 64), r.v % (1 << 64)) for r in edges.collect()]
    where, parent = {f: i for i, f in enumerate(fps)}, list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in links:
        a, b = find(where[u]), find(where[v])
        parent[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == roots(fps, bits)
