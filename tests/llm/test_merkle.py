import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle as M


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves, fanout):
    """(root, siblings of each leaf a level: before, after)."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, p in enumerate(at):
            run = level[p - p % fanout:p - p % fanout + fanout]
            paths[k].append(("".join(run[:p % fanout]), "".join(run[p % fanout + 1:])))
        level = [h(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
        at = [p // fanout for p in at]
    return (level[0] if level else None), paths


def first(v):
    return (v is not None, v if v is not None else 0)


def brute(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, source, lang, n_chars, text) rows."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (first(r[0]), leaf(r)))
        trees.append((own, *tree([leaf(r) for r in own], fanout)))
    root, above = tree([t[1] for t in trees], fanout)
    out = []
    for (own, subroot, paths), up in zip(trees, above):
        for r, path in zip(own, paths):
            path = path + up
            bad = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            d = leaf((*r[:3], r[3] + 1, r[4])) if bad else leaf(r)
            for a, b in path:
                d = h(a, d, b)
            out.append((r[0], leaf(r), subroot, root, h(*(a + b for a, b in path)), d, d == root))
    return sorted(out, key=str)


def rows_of(docs):
    return [tuple(r) for r in docs.select(*M.COLUMNS).collect()]


def written(docs, tmp_path):
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_query_against_brute_force(spark, docs, clashing, tmp_path):
    want = brute(rows_of(docs))
    got = [tuple(r) for r in M.run(spark, written(clashing, tmp_path)).collect()]
    assert sorted(got, key=str) == want
    assert {v for *_, v in got} == {True, False}


def test_sql_agrees(spark, docs, tmp_path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{written(docs, tmp_path)}/documents.parquet/*.parquet')")
    assert sorted(con.execute(M.SQL).fetchall(), key=str) == brute(rows_of(docs))


@pytest.mark.parametrize("fanout,height", [(2, 1), (2, 3), (3, 2), (5, 1), (4, 2)])
def test_other_shapes(spark, docs, fanout, height):
    rows = rows_of(docs)
    leaves = docs.select("lang", "doc_id", M.leaf(*map(F.col, M.COLUMNS)).alias("digest"))
    m = M.manifest(leaves, fanout=fanout, height=height)
    got = m.select("doc_id", "digest", "subroot", "root", M.proof(F.col("path")), M.folded(F.col("digest"), F.col("path"))).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted((r[:5] for r in brute(rows, fanout)), key=str)
    assert all(r[5] == r[3] for r in got)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1023, 1025, 2049])
def test_sizes(spark, n, tmp_path):
    """Around the size of a block; one group, so the subroot is the root."""
    df = spark.range(n).selectExpr("id as doc_id", "'s' as source", "'en' as lang", "id as n_chars", "'t' as text")
    got = sorted((tuple(r) for r in M.run(spark, written(df, tmp_path)).collect()), key=str)
    assert got == brute([(i, "s", "en", i, "t") for i in range(n)])


def test_many_equal_rows_and_groups(spark, tmp_path):
    rows = [(7, "s", "en", 3, "abc")] * 700 + [(i, None, f"l{i}é", None, None) for i in range(40)] + [(None, "s", None, 3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert sorted((tuple(r) for r in M.run(spark, written(df, tmp_path)).collect()), key=str) == brute(rows)
