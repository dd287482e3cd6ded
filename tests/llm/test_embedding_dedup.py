import random

import duckdb
import numpy as np
import pytest

from tessera.llm import embedding_dedup as M


def close(rng, x, cosine):
    """A vector at exactly that cosine from ``x``."""
    x = x / np.linalg.norm(x)
    away = rng.standard_normal(len(x))
    away -= away @ x * x
    return cosine * x + (1 - cosine ** 2) ** 0.5 * away / np.linalg.norm(away)


@pytest.fixture(scope="module")
def rows():
    rng, pick, out = np.random.default_rng(5), random.Random(5), []
    for i in range(600):
        out.append((i, rng.standard_normal(24), i % 3))
    for i in range(160):  # around the threshold, in both labels and the other one
        seed = out[pick.randrange(600)]
        out.append((1000 + i, close(rng, seed[1], pick.choice([0.95, 0.979, 0.981, 0.985, 0.99, 0.999])), pick.choice([seed[2], seed[2], 0])))
    hub = rng.standard_normal(24)
    for i in range(90):  # a dense cluster, and copies
        out.append((2000 + i, close(rng, hub, 0.992), 1))
        out.append((3000 + i, hub * (1 + i % 2), 1))
    chain = rng.standard_normal(24)
    for i in range(12):  # linked from one to the next only
        out.append((4000 - i, chain, 2))
        chain = close(rng, chain, 0.983)
    rows = [(i, [float(v) for v in x], l) for i, x, l in out]
    rows += [(5000, None, 0), (5001, [], 0), (5002, [0.0] * 24, 0), (5003, [0.0] * 24, 0), (5004, [1.0, None] * 12, 0),
             (5005, [float("nan")] * 24, 0), (5006, [float("inf")] * 24, 0), (5007, rows[0][1], None), (5008, rows[0][1], None),
             (None, rows[1][1], rows[1][2]), (None, [1.0, 2.0, 3.0], 0), (5009, [1.0, 2.0, 3.0], 0), (5010, [2.0, 4.0, 6.0], 0),
             (5011, [1e300, 0.0, 1e300], 1), (5012, [1e-300, 0.0, 1e-300], 1), (5013, [7.0], 1), (5014, [3.0], 1), (5015, [-3.0], 1),
             (None, [9.0, -1.0], 2)]
    rows += rows[:7]
    pick.shuffle(rows)
    return rows


def brute(rows, least=0.98):
    good = [(k, x, l) for k, (_, x, l) in enumerate(rows) if x and l is not None and all(v is not None and np.isfinite(v) for v in x) and any(x)]
    units = {k: np.array(x) / max(map(abs, x)) for k, x, _ in good}
    units = {k: u / np.linalg.norm(u) for k, u in units.items()}
    links, up = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, (i, _, l) in enumerate(good):
        for j, _, m in good[a + 1:]:
            if l == m and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least:
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    low = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            low[find(k)] = min(low.get(find(k), r[0]), r[0])
    return sorted(((r[0], links[k], low.get(find(k))) for k, r in enumerate(rows)), key=str)


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def result(df, **params):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in M.clustered(df, **params).collect()), key=str)


def test_against_brute_force(spark, rows):
    df = frame(spark, rows).withColumnsRenamed({}).selectExpr("*", "'own' as node", "'own' as key", "'own' as __k").repartition(5)
    got, want = result(df), brute(rows)
    assert len(got) == len(want)
    found = sum(n for _, n, _ in got) / sum(n for _, n, _ in want)
    assert found >= 0.99 and sum(a != b for a, b in zip(got, want)) <= 0.01 * len(want)


@pytest.mark.parametrize("tile", [(7, 11), (40, 5)])
def test_tiles_change_nothing(spark, rows, monkeypatch, tile):
    """Cells of many tiles, and an exact bound: every link is found once."""
    monkeypatch.setattr(M, "TILE_ROWS", tile[0])
    monkeypatch.setattr(M, "TILE_PROBES", tile[1])
    monkeypatch.setattr(M, "CELL_ROWS", 60)
    monkeypatch.setattr(M, "_STEP", 8)
    fitted = M.Index.fitted.__func__

    def exact(cls, *args):
        index = fitted(cls, *args)
        index.bound = 0.04  # 2 - 2 * 0.98
        return index

    monkeypatch.setattr(M.Index, "fitted", classmethod(exact))
    assert result(frame(spark, rows)) == brute(rows)


def test_recall_of_the_traversal():
    rng = np.random.default_rng(2)
    sample = M.unit(rng.standard_normal((4000, 32)))
    index = M.Index.fitted(sample, 100_000)
    assert len(index.books[0]) > 20
    x = M.unit(rng.standard_normal((2000, 32)))
    y = np.array([close(rng, v, 0.98) for v in x])

    def visited(a, b):
        row, cell = index.visits(a)
        own_row, own_cell = index.visits(b)
        own = own_cell[np.searchsorted(own_row, np.arange(len(b)))]
        hit = np.zeros(len(a), bool)
        hit[row[cell == own[row]]] = True
        return hit, len(cell) / len(a)

    (ab, cost), (ba, _) = visited(x, y), visited(y, x)
    assert (ab | ba).mean() >= 0.99 and cost < 0.25 * len(index.books[0]) ** 2


def test_visits_come_nearest_first():
    rng = np.random.default_rng(4)
    index = M.Index.fitted(M.unit(rng.standard_normal((900, 16))), 5000)
    index.bound = 0.05
    x = M.unit(rng.standard_normal((50, 16)))
    row, cell = index.visits(x)
    (m1, m2), (h1, h2) = index._margins(x @ index.rotation)
    k = len(index.books[0])
    for i in range(50):
        total = (m1[i][:, None] + m2[i][None]).ravel()
        mine = cell[row == i]
        assert mine[0] == h1[i] * k + h2[i] and sorted(mine) == np.flatnonzero(total <= 0.05).tolist()
        assert (np.diff(total[mine]) >= 0).all()


def test_sql_agrees(spark, rows, tmp_path):
    few = rows[:250]
    frame(spark, few).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = con.execute(M.SQL).fetchall()
    got = [tuple(r) for r in M.run(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_floats_and_empty(spark, rows):
    few = rows[:200]
    as_float = [(i, None if x is None else [None if v is None else float(np.float32(v)) for v in x], l) for i, x, l in few]
    assert result(frame(spark, few, "float")) == brute(as_float)
    assert result(frame(spark, [])) == []
    assert result(frame(spark, [(1, None, 1), (2, [1.0], None)])) == [(1, 0, 1), (2, 0, 2)]
