import base64
import gzip
import hashlib
import random
import re
from collections import defaultdict
from pathlib import Path

import pytest

from tessera.llm import warc as W


def sha(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(3)
    bits = ["\r\n", "\r", "\n", "\r\n\r\n", "a", "WARC/1.0\r\n", "é", "", "Content-Length: 5\r\n\r\n", " "]
    rows = [(i if i % 11 else None, f"http://x/\r\n y{i}" if i % 7 else None,
             "".join(rng.choice(bits) for _ in range(rng.randrange(0, 7))) if i % 13 else None) for i in range(400)]
    return rows + rows[:50]


@pytest.fixture(scope="module")
def archive(spark, pages, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("warc"))
    W.write(W.crawled(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)), f"{at}/crawl")
    W.deduplicated(spark, f"{at}/crawl", f"{at}/archive")
    return at


def test_round_trip(spark, pages, archive):
    got = sorted((str(r.page_id), r.payload) for r in W.read(spark, f"{archive}/crawl", True).collect())
    assert got == sorted((str(p), h or "") for p, _, h in pages)


def test_revisits(spark, pages, archive):
    got, exp = defaultdict(list), defaultdict(list)
    for r in W.read(spark, f"{archive}/archive", True).collect():
        got[r.payload_digest].append(r)
    for p, _, h in pages:
        exp[sha(h)].append((p, len((h or "").encode())))
    assert got.keys() == exp.keys()
    for k, rows in got.items():
        (one,) = [r for r in rows if r.record_type == "response"]
        assert one.page_id == max((p for p, _ in exp[k] if p is not None), default=None) and sha(one.payload) == k
        assert sorted(str((r.page_id, r.payload_bytes)) for r in rows) == sorted(str(x) for x in exp[k])
        for r in rows:
            if r is not one:
                assert (r.refers_to, r.refers_to_id, r.payload) == (one.page_id, one.record_id, "")
            else:
                assert r.refers_to is None


def test_small_payloads_are_all_responses(spark, pages, archive, tmp_path):
    W.deduplicated(spark, f"{archive}/crawl", str(tmp_path / "b"), min_bytes=5)
    rows = W.read(spark, str(tmp_path / "b")).collect()
    assert all(r.record_type == "response" for r in rows if r.payload_bytes < 5)
    assert any(r.record_type == "revisit" for r in rows)


def test_shuffled_payloads(spark, archive, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "BROADCAST_ROWS", 0)
    W.deduplicated(spark, f"{archive}/crawl", str(tmp_path / "b"))
    columns = ("page_id", "record_type", "refers_to", "payload_digest")
    a, b = (sorted(map(str, W.read(spark, p).select(*columns).collect())) for p in (f"{archive}/archive", str(tmp_path / "b")))
    assert a == b


def test_files_are_warc(archive):
    """An independent reading of the files by their lengths."""
    n = 0
    for f in Path(f"{archive}/archive").glob("*.gz"):
        data = gzip.decompress(f.read_bytes())
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.0\r\n")
            length = int(re.search(rb"Content-Length: (\d+)", head)[1])
            block, data = data[:length], data[length:]
            assert block.startswith(b"HTTP/1.1 200 OK\r\n") and data[:4] == b"\r\n\r\n"
            data = data[4:]
            n += 1
    assert n == 450


def test_damage_is_noticed(spark, tmp_path):
    head = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:X\r\nX-Payload-Bytes: 4\r\n"
    for i, (n, why) in enumerate([(900, "ends within a record"), (12, "does not have its digest")]):
        text = f"{head}Content-Length: {n}\r\n\r\nHTTP\r\n\r\nbody"
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(f"{tmp_path}/{i}")
        with pytest.raises(Exception, match=why):
            W.read(spark, f"{tmp_path}/{i}").collect()


def test_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    W.write(W.crawled(pages), f"{tmp_path}/a")
    W.deduplicated(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    assert W.read(spark, f"{tmp_path}/b").collect() == []


def test_digest(spark):
    rows = [("",), ("a",), ("é" * 1000,)]
    df = spark.createDataFrame(rows, "t string")
    assert [r.d for r in df.select(W.digest(df.t).alias("d")).collect()] == [sha(t) for (t,) in rows]


def test_clashing_names(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "x"), (2, "v", "x")], "page_id long, url string, html string").selectExpr(
        "*", "'own' AS payload", "'own' AS record_type", "7 AS refers_to", "'own' AS record_id")
    W.write(W.crawled(df), f"{tmp_path}/a")
    W.deduplicated(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    got = {(r.page_id, r.record_type, r.refers_to) for r in W.read(spark, f"{tmp_path}/b").collect()}
    assert got == {(2, "response", None), (1, "revisit", 2)}
