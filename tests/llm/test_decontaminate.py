import random
import re
from collections import Counter

import pytest

from tessera.llm import decontaminate as D
from tests.llm.conftest import prose


def words(t):
    return [w for w in re.split(r"[^\w]|_", (t or "").lower()) if w]


def bag(ws, k):
    return Counter(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))


def brute(docs, items, least=0.8, window_ok=lambda s: True):
    """Best similarity of every (document, item) over all item-sized windows."""
    out = {}
    for doc, text in docs:
        ws = words(text)
        for item, t in items:
            it = words(t)
            if not it or not ws:
                continue
            k, n = min(5, len(it)), len(it)
            b = bag(it, k)
            best = 0.0
            for s in range(max(1, len(ws) - n + 1)):
                w = bag(ws[s:s + n], k)
                best = max(best, sum((w & b).values()) / sum((w | b).values()))
            if best >= least:
                out[doc, item] = best
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    items = [(i, prose(rng, rng.randrange(12, 40))) for i in range(15)]
    items += [(20, items[0][1]), (21, None), (22, ""), (23, "zulu yankee xray"), (24, " ".join(["rep eat"] * 20))]
    docs = [(i, prose(rng, rng.randrange(0, 120))) for i in range(60)]
    for i in range(15):
        w = items[i][1].split(" ")
        docs.append((100 + i, prose(rng, 20) + " " + items[i][1].upper() + ", " + prose(rng, 9)))
        docs.append((200 + i, prose(rng, 9) + " " + " ".join(w[2:]) + " " + prose(rng, 9)))  # two words short
        docs.append((300 + i, " ".join(w[:-1])))  # shorter than the item
        half = w[:len(w) // 2]
        docs.append((400 + i, prose(rng, 9) + " " + " ".join(half) + " " + prose(rng, 30)))  # half of it: clean
        docs.append((500 + i, items[i][1] + " other " + items[(i + 1) % 15][1]))
    docs += [(600, "Zulu, Yankee: X-ray! zulu yankee xray"), (601, "so rep eat " * 30), (602, None), (603, "")]
    return docs, items


def frames(spark, data):
    return (spark.createDataFrame(data[0], "doc_id long, text string").repartition(3),
            spark.createDataFrame(data[1], "item_id long, text string"))


def result(docs, items):
    return {(r.doc_id, r.item_id): r.similarity for r in D.matches(docs, items).collect()}


def test_matches_brute_force(spark, data):
    got, exp = result(*frames(spark, data)), brute(*data)
    assert len(exp) > 60 and (500, 1) in exp
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


def test_shuffled_joins(spark, data, monkeypatch):
    from tessera.llm import common
    docs, items = frames(spark, data)
    one, kept = result(docs, items), D.stage(docs, items).count()
    for bound in ("BROADCAST_ROWS", "SEED_ROWS", "ITEM_BYTES"):
        monkeypatch.setattr(D, bound, 0)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert result(docs, items) == one
    assert D.stage(docs, items).count() == kept


def test_stage(spark, data, clashing, corpus):
    docs, items = frames(spark, data)
    bad = {d for d, _ in brute(*data)}
    assert sorted(r.doc_id for r in D.stage(docs, items).collect()) == sorted(d for d, _ in data[0] if d not in bad)
    # null and repeated ids, clashing names
    one = corpus[3]
    out = D.stage(clashing, spark.createDataFrame([(1, one[1])], "item_id long, text string"))
    assert out.columns == clashing.columns
    exp = [r[0] for r in corpus if not brute([(0, r[1])], [(1, one[1])])]
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == sorted(map(str, exp))


def test_blocks_meet_every_pair_within_the_radius():
    masks = [m % (1 << 64) for m in D._blocks(20)]
    assert sum(masks) == (1 << 64) - 1 and len(masks) == 21
    rng = random.Random(1)
    for _ in range(500):
        x = sum(1 << b for b in rng.sample(range(64), 20))
        assert any(x & m == 0 for m in masks)


def test_empty(spark, empty, data):
    docs, items = frames(spark, data)
    none = items.limit(0)
    assert result(docs, none) == {} and result(empty, items) == {}
    assert D.stage(docs, none).count() == docs.count()
    assert D.stage(empty, items).collect() == []


def test_no_python_in_plan(spark, data):
    plan = D.matches(*frames(spark, data))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_recall_of_the_radius(spark):
    """Planted copies of the least similar kinds: what the radius costs, and what a narrower one would."""
    rng = random.Random(8)
    items, docs = [], []
    for i in range(300):
        w = [f"{rng.choice('bcdfgh')}{rng.randrange(100000)}" for _ in range(rng.randrange(50, 90))]
        items.append((i, " ".join(w)))
        copy = list(w)
        if i % 2:
            copy[rng.randrange(6, len(w) - 6)] = "changed"   # five shingles of some 65
        else:
            a = rng.randrange(6, len(w) - 6)                 # six
            copy[a:a + 2] = ["changed", "again"]
        docs.append((i, " ".join(copy)))
    near = {d for d, i in brute_pairs(docs, items) if d == i}
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r: {x.doc_id for x in D.matches(d, b, radius=r).collect() if x.doc_id == x.item_id} for r in (12, D.RADIUS, 63)}
    assert got[63] == near and len(near) > 250
    assert len(got[D.RADIUS]) >= 0.99 * len(near)
    assert len(got[12]) < len(got[D.RADIUS])


def brute_pairs(docs, items):
    """(document, item) of equal ids whose similarity as a whole is 0.8 or more."""
    out = []
    for (d, t), (i, u) in zip(docs, items):
        a, b = bag(words(t), 5), bag(words(u), 5)
        if sum((a & b).values()) >= 0.8 * sum((a | b).values()):
            out.append((d, i))
    return out
