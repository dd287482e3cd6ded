"""Substring dedup by fixed-block anchors.

A run of ``window`` words that two documents share holds a whole one of the
reference document's non-overlapping blocks of ``window / 2`` words, wherever
the blocks fall. So the blocks of every document are indexed and every rolling
window of block size probes them; what no probe hits cannot repeat.

1. Anchors. Texts are hashed a chunk at a time, with no row for a word: a chunk
   sends each shard of the hash range one packed row of (hash, position). A
   hash found in several texts of the chunk is a hit at once and sends one
   entry for all, so a passage that a third of all documents hold sends a
   shard one entry a chunk. Shards answer with the positions whose hash is in
   another chunk too, and is a block's there or here.
2. Extension. Around hits every ``window`` of words is hashed to 96 bits and
   the same exchange finds each one's smallest doc_id. Windows of a document
   with a larger one are repeats; adjacent ones merge to maximal repeats, whose
   words are removed. All windows are judged on the input.

Words are hashed by place-dependent random values (``rolling.tabulated``), so
repetitive words do not collide, and windows by powers over those hashes under
two independent tables. Rows are told apart by doc_id and text together. Nothing but hashes and
positions is shuffled for texts without a hit.

Edge cases: a null or empty text has no words; a null doc_id counts as larger
than all others; rows with the same doc_id never remove each other's words; a
text shorter than the window keeps all; words of any length are hashed whole,
those over 128 KB by BLAKE2; of ties in doc_id none is smaller; only ``doc_id``
and the text are read, so clashing names do no harm; an empty table gives an
empty result.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, discard, words_of, written
from tessera.llm.rolling import BASES, Chunk, from_planes, groups, merged, per_group, planes

WINDOW = 50
#: Text bytes behind one packed row of the exchange, and the least of a chunk or shard.
ROW_BYTES = 1 << 10
LEAST_BYTES = 1 << 16
_LAST = np.iinfo(np.int64).max
_ENTRIES, _TABLE, _HITS = 0, 1, 2
_SCHEMA = "kind int, route bigint, chunk bigint, a binary, b binary, c binary"


def exchange_sizes(docs: DataFrame, row_bytes: int, least: int) -> tuple[int, int]:
    """(text bytes of a chunk and of a shard, number of shards).

    Each chunk has a row for each shard, so both sides grow with the square
    root of the text: rows then grow as the text does, each with as much.
    """
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    side = max(least, isqrt(total * row_bytes))
    return side, max(1, -(-total // side))


def _chunks(batches, size: int):
    """(chunk id, columns as lists) for about ``size`` bytes of text at a time."""
    part, seq, rows, held = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            rows.append(row)
            held += len(row[2] or b"")
            if held >= size:
                yield (part << 32) + seq, [list(c) for c in zip(*rows)]
                rows, held, seq = [], 0, seq + 1
    if rows:
        yield (part << 32) + seq, [list(c) for c in zip(*rows)]


def _batch(rows):
    kind, route, chunk, *blobs = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(route, pa.int64()), pa.array(chunk, pa.int64()),
         *(pa.array(b, pa.binary()) for b in blobs)], names=["kind", "route", "chunk", "a", "b", "c"])


def _doc_ids(ids) -> np.ndarray:
    return np.array([_LAST if i is None else i for i in ids], np.int64)


def _table(chunk: int, keys, c: Chunk):
    return _TABLE, -1 - chunk, chunk, b"".join(keys), c.offsets.astype("<u4").tobytes(), b""


def _hits(chunk: int, at: np.ndarray):
    return _HITS, -1 - chunk, chunk, np.sort(at).astype("<u4").tobytes(), b"", b""


def _cuts(shard: np.ndarray):
    """(shard, begin, end) of runs in sorted ``shard``."""
    b = groups(shard) if len(shard) else np.empty(0, np.int64)
    return zip(shard[b].tolist(), b.tolist(), [*b[1:].tolist(), len(shard)])


def _anchors(block: int, size: int, shards: int):
    """Chunks to packed anchor entries; ``a``: counts of the four sections, ``b``: hashes, ``c``: positions."""
    def run(batches):
        for chunk, (keys, _, texts) in _chunks(batches, size):
            c = Chunk([t or b"" for t in texts])
            rows = [_table(chunk, keys, c)]
            h, at = c.windows(block, BASES[0])
            order = np.argsort(h)
            h, at = h[order], at[order]
            if len(h):
                text = c.text_of[at]
                indexed = (at - c.offsets[text]) % block == 0
                g = groups(h)
                several = per_group(np.minimum, text, g) != per_group(np.maximum, text, g)
                rows.append(_hits(chunk, at[several]))
                indexed = np.where(several, per_group(np.logical_or, indexed, g), indexed)
                first = np.zeros(len(h), bool)
                first[g] = True
                sent = first | ~several
                h, at, section = h[sent], at[sent], (~indexed[sent]) + 2 * several[sent]
                shard = ((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
                order = np.lexsort((section, shard))
                h, at, section, shard = h[order], at[order], section[order], shard[order]
                low = h.astype(np.uint32)
                for s, i, j in _cuts(shard):
                    rows.append((_ENTRIES, s, chunk, np.bincount(section[i:j], minlength=4).astype("<u4").tobytes(),
                                 low[i:j].tobytes(), planes(at[i:j].astype("<u4"))))
            yield _batch(rows)
    return run


def _answer_anchors(pdf: pd.DataFrame) -> pd.DataFrame:
    """Positions of single entries whose hash is in another chunk too, given a block among them."""
    if pdf["kind"].iat[0] != _ENTRIES:
        return pdf
    h = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["b"]])
    at = np.concatenate([from_planes(x, "<u4") for x in pdf["c"]])
    counts = [np.frombuffer(x, "<u4") for x in pdf["a"]]
    section = np.concatenate([np.repeat(np.arange(4), n) for n in counts])
    chunk = np.repeat(pdf["chunk"].to_numpy(), [int(n.sum()) for n in counts])
    order = np.argsort(h)
    h, at, section, chunk = h[order], at[order], section[order], chunk[order]
    g = groups(h)
    hit = ((per_group(np.minimum, chunk, g) != per_group(np.maximum, chunk, g))
           & (per_group(np.minimum, section & 1, g) == 0) & (section < 2))
    return _as_hits(chunk[hit], at[hit])


def _as_hits(chunk: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    order = np.lexsort((at, chunk))
    chunk, at = chunk[order], at[order]
    rows = [_hits(c, at[i:j]) for c, i, j in _cuts(chunk)]
    return pd.DataFrame(rows, columns=["kind", "route", "chunk", "a", "b", "c"])


def _by_key(spread):
    """Hits of a chunk, from all shards, to (key, blob) by ``spread(positions in the text, words)``."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        at = pdf.loc[pdf["kind"] == _HITS, "a"]
        at = np.unique(np.concatenate([np.frombuffer(x, "<u4") for x in at] or [np.empty(0, "<u4")])).astype(np.int64)
        out = []
        if len(at):
            t = pdf[pdf["kind"] == _TABLE].iloc[0]
            offsets = np.frombuffer(t["b"], "<u4").astype(np.int64)
            text = np.searchsorted(offsets, at, "right") - 1
            for k, i, j in _cuts(text):
                blob = spread(at[i:j] - offsets[k], int(offsets[k + 1] - offsets[k]))
                if blob:
                    out.append((t["a"][16 * k:16 * k + 16], blob))
        return pd.DataFrame(out, columns=["key", "blob"])
    return run


def _around(window: int, block: int):
    """Ranges of the first words of windows that hold a hit block."""
    def spread(at, words):
        b, e = np.maximum(0, at + block - window), np.minimum(at + 1, words - window + 1)
        b, e = merged(b[b < e], e[b < e])
        return np.stack([b, e], 1).astype("<u4").tobytes()
    return spread


def _expanded(blobs) -> np.ndarray:
    r = np.concatenate([np.frombuffer(x, "<u4").reshape(-1, 2) for x in blobs]).astype(np.int64)
    b, e = merged(r[:, 0], r[:, 1])
    n = e - b
    return np.repeat(b - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())


def _repeats(window: int, size: int, shards: int):
    """Chunks of hit texts to packed window entries; ``a``: doc_ids, ``b``: hashes, ``c``: positions."""
    def run(batches):
        for chunk, (keys, ids, texts, blobs) in _chunks(batches, size):
            c, ids = Chunk([t or b"" for t in texts]), _doc_ids(ids)
            rows = [_table(chunk, keys, c)]
            at = np.concatenate([_expanded(b) + o for b, o in zip(blobs, c.offsets)])
            h1, every = c.windows(window, BASES[0])
            h2, _ = c.windows(window, BASES[1])
            pick = np.searchsorted(every, at)
            h1, h2 = h1[pick], h2[pick].astype(np.uint32)
            order = np.lexsort((h2, h1))
            h1, h2, at = h1[order], h2[order], at[order]
            if len(at):
                doc = ids[c.text_of[at]]
                least = per_group(np.minimum, doc, groups(h1, h2))
                rows.append(_hits(chunk, at[doc > least]))
                sent = doc == least
                h1, h2, at, doc = h1[sent], h2[sent], at[sent], doc[sent]
                shard = ((h1 >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
                for s, i, j in _cuts(shard):
                    rows.append((_ENTRIES, s, chunk, planes(doc[i:j].astype("<i8")),
                                 h1[i:j].tobytes() + h2[i:j].tobytes(), planes(at[i:j].astype("<u4"))))
            yield _batch(rows)
    return run


def _answer_repeats(pdf: pd.DataFrame) -> pd.DataFrame:
    """Positions of windows that a smaller doc_id has too."""
    if pdf["kind"].iat[0] != _ENTRIES:
        return pdf
    h1, h2, at, doc, sizes = [], [], [], [], []
    for a, b, c in zip(pdf["a"], pdf["b"], pdf["c"]):
        p = from_planes(c, "<u4").astype(np.int64)
        h1.append(np.frombuffer(b[: 8 * len(p)], np.uint64))
        h2.append(np.frombuffer(b[8 * len(p):], np.uint32))
        at.append(p)
        doc.append(from_planes(a, "<i8"))
        sizes.append(len(p))
    h1, h2, at, doc = (np.concatenate(x) for x in (h1, h2, at, doc))
    chunk = np.repeat(pdf["chunk"].to_numpy(), sizes)
    order = np.lexsort((h2, h1))
    h1, h2, at, doc, chunk = (x[order] for x in (h1, h2, at, doc, chunk))
    hit = doc > per_group(np.minimum, doc, groups(h1, h2))
    return _as_hits(chunk[hit], at[hit])


def _removal(window: int):
    """Texts with the first words of their repeated windows to what is left of them."""
    def run(batches):
        for batch in batches:
            out = []
            for key, text, blob in zip(*(c.to_pylist() for c in batch.columns)):
                words = (text or b"").split()
                at = np.frombuffer(blob, "<u4").astype(np.int64)
                b, e = merged(at, at + window)
                gone = np.zeros(len(words) + 1, np.int64)
                np.add.at(gone, b, 1), np.add.at(gone, e, -1)
                gone = np.cumsum(gone)[:-1] > 0
                kept = b" ".join(w for w, g in zip(words, gone) if not g)
                out.append((key, int(gone.sum()), len(b), kept.decode(), np.stack([b, e], 1).tolist()))
            key, n, k, kept, spans = zip(*out) if out else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.binary()), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(spans, pa.list_(pa.list_(pa.int64())))], names=["key", "n_removed", "n_spans", "kept", "spans"])
    return run


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, doc_id, text as bytes); key is a digest of doc_id and text."""
    t = F.col(text).cast("string")
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), t)
    return docs.select(F.unhex(F.md5(key.cast("binary"))).alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                       t.cast("binary").alias("text"))


def with_blobs(docs: DataFrame, blobs: DataFrame) -> DataFrame:
    """``docs`` (key, doc_id, text) that have blobs, with an array of them; counted before it is broadcast."""
    blobs = blobs.groupBy(F.col("key").alias("__key")).agg(F.collect_list("blob").alias("blobs"))
    if blobs.count() <= BROADCAST_ROWS:
        # only the keys are broadcast, 16 bytes each: texts without a hit are not shuffled
        ids = F.broadcast(blobs.select(F.col("__key").alias("__id")))
        docs = docs.join(ids, F.col("key") == F.col("__id"), "left_semi")
    return docs.join(blobs, F.col("key") == F.col("__key")).drop("__key")


def removed(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, n_removed, n_spans, kept, spans) of the rows that lose words; spans are word ranges."""
    spark, block = docs.sparkSession, max(1, window // 2)
    d = keyed(docs, text)
    found, at = written(d.mapInArrow(_anchors(block, *exchange_sizes(d, ROW_BYTES, LEAST_BYTES)), _SCHEMA).groupBy("route").applyInPandas(
        _answer_anchors, _SCHEMA), "anchors")
    near, at2 = written(found.groupBy("chunk").applyInPandas(
        _by_key(_around(window, block)), "key binary, blob binary"), "around")
    hit, at3 = written(with_blobs(d, near).dropDuplicates(["key"]), "hit")
    discard(spark, at, at2)
    found, at = written(hit.mapInArrow(_repeats(window, *exchange_sizes(hit, ROW_BYTES, LEAST_BYTES)), _SCHEMA).groupBy("route").applyInPandas(
        _answer_repeats, _SCHEMA), "repeats")
    starts = found.groupBy("chunk").applyInPandas(
        _by_key(lambda p, words: p.astype("<u4").tobytes()), "key binary, blob binary")
    starts, at2 = written(starts, "starts")
    out = hit.select("key", "text").join(starts.withColumnRenamed("key", "__key"), F.col("key") == F.col("__key"))
    out, _ = written(out.select("key", "text", "blob").mapInArrow(
        _removal(window), "key binary, n_removed bigint, n_spans bigint, kept string, spans array<array<bigint>>"), "removed")
    discard(spark, at, at2, at3)
    return out


def deduped(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each of ``docs``: doc_id, n_words, n_removed, n_spans, kept (words joined by one space)."""
    lost = removed(docs, text, window).withColumnRenamed("key", "__key")
    d = keyed(docs, text).withColumn("ws", words_of(F.col("text").cast("string")))
    d = d.select("key", "doc_id", F.size("ws").cast("long").alias("n_words"), F.array_join("ws", " ").alias("all"))
    d = d.join(lost, F.col("key") == F.col("__key"), "left")
    return d.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
                    F.coalesce("kept", "all").alias("kept"))


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # digests on both sides of the join, so that no text takes part in it
    lost = removed(docs).select(F.col("key").alias("__key"), "n_removed", "n_spans",
                                F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    d = keyed(docs).withColumn("ws", words_of(F.col("text").cast("string")))
    d = d.select("key", "doc_id", F.size("ws").cast("long").alias("n_words"),
                 F.sha2(F.array_join("ws", " ").cast("binary"), 256).alias("whole"))
    d = d.join(lost, F.col("key") == F.col("__key"), "left")
    return d.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
                    F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"))


SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
  list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT rid, doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) AS h
      FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
r AS (SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY h) AS low FROM w) WHERE doc_id > low),
s AS (SELECT rid, i, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i), 1000) > 50 AS fresh FROM r),
t AS (SELECT rid, i, sum(fresh::INT) OVER (PARTITION BY rid ORDER BY i) AS k FROM s),
u AS (SELECT rid, k, min(i) AS b, max(i) + 49 AS e FROM t GROUP BY rid, k),
g AS (SELECT rid, list(struct_pack(b := b, e := e)) AS spans, count(*) AS n_spans, sum(e - b + 1) AS n FROM u GROUP BY rid),
k AS (SELECT d.rid, array_to_string(list_filter(ws, lambda x, j: len(list_filter(spans, lambda y: j BETWEEN y.b AND y.e)) = 0), ' ') AS kept
      FROM d JOIN g USING (rid))
SELECT d.doc_id, len(ws) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, array_to_string(ws, ' '))) AS kept_sha256, coalesce(n_spans, 0) AS n_spans
FROM d LEFT JOIN g USING (rid) LEFT JOIN k USING (rid)
"""
