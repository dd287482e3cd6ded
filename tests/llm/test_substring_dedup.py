import hashlib
import random
import re

import pytest

from tessera.llm import substring_dedup as S


def brute(rows, window):
    texts = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    last = float("inf")
    low = {}
    for d, w in texts:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            low[k] = min(low.get(k, last), last if d is None else d)
    out = []
    for d, w in texts:
        gone = {j for i in range(len(w) - window + 1) if low[tuple(w[i:i + window])] < (last if d is None else d)
                for j in range(i, i + window)}
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def result(df, **kw):
    return order((r.doc_id, r.n_words, r.n_removed, r.kept) for r in S.deduped(df, **kw).collect())


@pytest.mark.parametrize("window,letters,seed", [(2, 4, 1), (5, 2, 2), (7, 3, 3), (10, 2, 4)])
def test_matches_brute_force(spark, monkeypatch, window, letters, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(S, "LEAST_BYTES", 400)
    monkeypatch.setattr(S, "ROW_BYTES", 30)
    rows = [(rng.randrange(60), "  ".join(rng.choice("abcdefgh"[:letters]) for _ in range(rng.randrange(0, 60)))) for _ in range(70)]
    rows += rows[:5] + [(None, rows[3][1]), (None, rows[4][1]), (70, None), (71, ""), (72, rows[9][1] + "\n" + rows[8][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    exp = order(brute(rows, window))
    assert any(r[2] for r in exp)
    assert result(df, window=window) == exp


def test_corpus(clashing, corpus):
    exp = order(brute([r[:2] for r in corpus], 50))
    assert sum(r[2] > 0 for r in exp) >= 10
    assert result(clashing) == exp


def test_shuffled_texts(docs, monkeypatch):
    one = result(docs)
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    assert result(docs) == one


def test_spans(spark):
    a = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(1, a), (2, "x " + a + " y")], "doc_id long, text string")
    (r,) = S.removed(df).collect()
    assert (r.n_removed, r.n_spans, r.kept, r.spans) == (80, 1, "x y", [[1, 81]])


def test_empty(empty):
    assert result(empty) == []


def test_query_digest(spark, tmp_path):
    rows = [(1, " ".join(f"é{i}" for i in range(60))), (2, "a  b")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.kept_sha256 for r in S.run(spark, str(tmp_path)).collect()}
    assert got == {1: hashlib.sha256(rows[0][1].encode()).hexdigest(), 2: hashlib.sha256(b"a b").hexdigest()}


def thue_morse(n, one, other):
    return "".join(one if bin(i).count("1") % 2 else other for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 4096, 200_000])
def test_repetitive_long_words_are_told_apart(spark, n):
    """Words that collide under every polynomial hash modulo a power of two."""
    rest = " ".join(f"w{i}" for i in range(49))
    rows = [(1, f"{thue_morse(n, 'a', 'b')} {rest}"), (2, f"{thue_morse(n, 'b', 'a')} {rest}"), (3, f"{thue_morse(n, 'b', 'a')} {rest}")]
    got = {r.doc_id: r.n_removed for r in S.deduped(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 50}
