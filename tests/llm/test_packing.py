import random

import pytest

from tessera.llm import packing as P


def brute(lengths, capacities, overhead):
    """Best fit by looking at every open bin, for every upper limit; the least cost."""
    best = None
    for top in sorted(capacities):
        bins, where = [], []
        for i, n in enumerate(lengths):
            fit = [b for b in bins if b[0] - b[1] >= n]
            if fit:
                b = min(fit, key=lambda b: (b[0] - b[1], b[2]))
            else:
                rest = sum(lengths[i:])
                sizes = [c for c in capacities if n <= c <= top] or [min(c for c in capacities if c >= n)]
                b = [min(sizes, key=lambda c: ((c + overhead) / min(c, rest), c)), 0, len(bins)]
                bins.append(b)
            where.append((b[2], b[1]))
            b[1] += n
        caps = [min(c for c in capacities if c >= b[1]) for b in bins]
        cost = sum(caps) + overhead * len(caps)
        if best is None or cost < best[0]:
            best = cost, where, caps
    return best[1], best[2]


@pytest.mark.parametrize("capacities", [(8, 20, 50), (50,), (10, 11, 12, 50)])
def test_plan_matches_brute_force(capacities):
    rng = random.Random(sum(capacities))
    for _ in range(40):
        lengths = sorted((rng.randrange(1, 51) for _ in range(rng.randrange(0, 80))), reverse=True)
        assert P.plan(lengths, capacities, 3) == brute(lengths, capacities, 3)


def test_downsizing():
    at, caps = P.plan([20, 7], (8, 32, 64), 0)
    assert caps == [32] and at == [(0, 0), (0, 20)]


def check(rows, texts, capacities):
    by_bin, by_doc = {}, {}
    for r in rows:
        if r.length:
            by_bin.setdefault(r.bin_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for b in by_bin.values():
        end = 0
        for r in sorted(b, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert {r.used for r in b} == {end}
        assert {r.capacity for r in b} == {min(c for c in capacities if c >= end)}
    for doc, n in texts.items():
        end = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == end and r.piece == r.start // max(capacities)
            assert (r.bin_id is None) == (r.length == 0)
            end += r.length
        assert end == n
    assert by_doc.keys() == texts.keys()
    return by_bin


def test_every_byte_is_packed_once(docs, corpus):
    rows = P.packed(docs.dropDuplicates(["doc_id", "text"]).filter("doc_id IS NOT NULL"), capacities=(256, 1024, 4096), shard_pieces=20)
    texts = {r[0]: len((r[1] or "").encode()) for r in corpus if r[0] is not None}
    by_bin = check(rows.collect(), texts, (256, 1024, 4096))
    space = sum(v[0].capacity for v in by_bin.values())
    assert space < 1.25 * sum(texts.values())


def test_repeated_and_null_rows_are_kept(docs, corpus):
    rows = P.packed(docs).collect()
    assert sum(r.length for r in rows) == sum(len((r[1] or "").encode()) for r in corpus)
    assert sorted(str(r.doc_id) for r in rows if r.piece == 0) == sorted(str(r[0]) for r in corpus)


def test_copies_are_dealt_over_the_shards(spark):
    rows = [(7, "the same text")] * 300 + [(None, "of no document")] * 301 + [(1000 + i, f"text {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.packed(df, capacities=(64, 256), shard_pieces=50).collect()
    assert sorted((str(r.doc_id), r.length) for r in got) == sorted((str(d), len(t)) for d, t in rows)
    ids = [r.bin_id >> 32 for r in got]
    assert len(set(ids)) == 19 and max(ids.count(x) for x in set(ids)) < 100


def test_empty(empty):
    assert P.packed(empty).collect() == []


def test_clashing_names(clashing, corpus):
    d = clashing.selectExpr("*", "1 AS piece", "2 AS length", "'x' AS bin_id", "'y' AS spread")
    assert sum(r.length for r in P.packed(d).collect()) == sum(len((r[1] or "").encode()) for r in corpus)


def test_stage_carries_the_bytes(clashing, corpus):
    d = clashing.selectExpr("*", "'x' AS row_hash", "'y' AS content", "'z' AS __text")
    rows = P.stage(d).collect()
    long = [(None, "é" * 40_000), (None, "é" * 40_000), (5, None)]
    rows += P.stage(clashing.sparkSession.createDataFrame(long, "doc_id long, text string")).collect()
    want, got = {}, {}
    for d, t in [r[:2] for r in corpus] + long:
        want.setdefault(d, []).append((t or "").encode())
    for r in rows:
        assert len(r.content) == r.length
        got.setdefault(r.doc_id, {}).setdefault(r.start, []).append(bytes(r.content))
    for d, texts in want.items():
        assert sorted(x for t in texts for x in [t[i:i + 32768] for i in range(0, max(1, len(t)), 32768)]) == sorted(
            x for parts in got[d].values() for x in parts), d
    assert got.keys() == want.keys()
