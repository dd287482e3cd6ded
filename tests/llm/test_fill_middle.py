import hashlib
import random
import re

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import fill_middle as M

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    w = TOKEN.findall(text)
    n, d = len(w), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(w[:lo]), "".join(w[lo:hi]), "".join(w[hi:])
    assert pre + mid + suf == text
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85\xa0 aéß<>PSM𝄞", max_size=60), st.integers(0, 10 ** 6))
def test_exact_round_trip(text, key):
    got = M.rearranged(text.encode(), str(key))
    assert (*got[:4], got[4].decode()) == brute(key, text)
    assert M.restored_text(got[4], got[1]) == text.encode()


def test_rotation_by_three_reversals():
    for n in range(9):
        for k in range(n + 1):
            block = np.frombuffer(bytearray(range(n)), np.uint8)
            M.rotate(block, k)
            assert block.tolist() == [*range(k, n), *range(k)]


def test_query(spark, docs, clashing, tmp_path):
    rng = random.Random(1)
    extra = [(1000 + i, rng.choice(["a <P> b", "x<", "<S", "<S>", " ", "\n\n", "end \t", "é" * 9, "word " * 50000])) for i in range(60)]
    more = spark.createDataFrame(extra, "doc_id long, text string")
    df = clashing.withColumn("n", F.lit("own")).withColumn("form", F.lit("own")).unionByName(more, allowMissingColumns=True)
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for r in df.collect():
        n, form, p, m, out = brute(r.doc_id, r.text)
        want.append((r.doc_id, n, form, p, m, sha(out), sha(r.text or "")))
    got = [tuple(r) for r in M.run(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.execute(M.SQL).fetchall(), key=str) == sorted(want, key=str)


def test_general_form(docs, clashing, empty):
    out = M.fill_middle(clashing, fim_pct=100, spm_pct=0)
    assert out.columns == [*clashing.columns, "fim_n", "fim_form", "fim_prefix_chars", "fim_middle_chars", "fim_output"]
    back = out.select("text", "fim_form", M.restored(F.col("fim_output").cast("binary"), F.col("fim_form")).cast("string").alias("b"))
    rows = back.collect()
    assert all((r.text or "") == r.b for r in rows) and {r.fim_form for r in rows} == {"plain", "psm"}
    assert M.fill_middle(empty).collect() == []
