"""SimHash near-dedup over a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two fingerprints that differ in at
most ``d`` bits differ in at most ``d`` bytes, so they share at least
``T = 8 - d`` of them: the guaranteed minimum of matches. The index has one
posting for each group of T - 1 positions (56 a fingerprint for d = 4, of 24
bits), so a pair with T shared bytes meets in T lists or more, and one with
T - 1 still in one. Inside a list each pair's shared positional bytes are
tallied from the exclusive or of the two; the tally drops pairs below T, and
those that reach it are verified by their differing bits. For d = 7 a group is
one position and every pair of a list reaches T = 1.

Copies never meet: equal fingerprints are one entry of the index. A posting
list never gives all its pairs. It is walked from link to link, each popped
member compared with those not yet reached, so it yields a spanning forest of
its links: the same components, one row a member at most. A list longer than
``max_list`` is not held in a task: its members stream through and are linked
instead through the fingerprints at most d / 2 bits from each (two that differ
in d bits or less always share one), which is exact and linear too.

Edge cases: a null or empty text has fingerprint zero, linked like any other;
a null doc_id is never the smallest unless its component has no other;
repeated rows give repeated results; an empty table gives an empty result. A
very long text is one Python object in one task, its hashes eight bytes a
word. Other columns are never read, save by ``stage``, which boxes them: any
name may clash.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tessera.llm.common import boxed, discard, unboxed, written
from tessera.llm.components import components

SHINGLE = 4
MAX_BITS = 4
MAX_LIST = 50_000
_SEED = 42
_CHUNK = 1 << 16


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one text, as a signed integer.

    A-Z is lower-cased; ``bytes.split`` takes words between U+0009..U+000D and space.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, _SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], _SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())]
    h = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), _CHUNK):
        part = h[i:i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    @arrow_udf("bigint")
    def fp(texts: pa.Array) -> pa.Array:
        # one text at a time is a Python object, not a batch of them
        return pa.array((simhash(t.as_py(), shingle) for t in texts), pa.int64(), size=len(texts))
    return fp(text.cast("string").cast("binary"))


def _forest(fps: np.ndarray, max_bits: int, least: int):
    """Spanning forest of the links within one posting list, as (member, root) pairs.

    Unreached members are compared with each reached one, never all pairs in a
    list whose members are linked.
    """
    left = fps
    while len(left) > 1:
        root, left, queue = left[0], left[1:], [left[0]]
        while queue and len(left):
            x = left ^ queue.pop()
            # the tally: positional bytes that are the same in both
            shared = np.count_nonzero(x.view(np.uint8).reshape(-1, 8) == 0, axis=1)
            linked = (shared >= least) & (np.bitwise_count(x) <= max_bits)
            found, left = left[linked], left[~linked]
            for f in found:
                yield f, root
            queue.extend(found)


def _scan_lists(max_bits: int, max_list: int):
    least = max(1, 8 - max_bits)

    def scan(batches):
        held: list[np.ndarray] = []  # members of the list that the batch before left open
        key, size, hot = None, 0, False

        def close():
            if not hot and size > 1:
                yield from _forest(np.concatenate(held).astype(np.uint64), max_bits, least)

        out_u: list[int] = []
        out_v: list[int] = []
        out_hot: list[int] = []

        def flush():
            u = np.array(out_u, np.uint64).view(np.int64)
            v = np.array(out_v, np.uint64).view(np.int64)
            b = pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([u, np.array(out_hot, np.int64)])),
                 pa.array(np.concatenate([v, np.array(out_hot, np.int64)])),
                 pa.array(np.r_[np.zeros(len(u), bool), np.ones(len(out_hot), bool)])],
                names=["u", "v", "hot"])
            out_u.clear(), out_v.clear(), out_hot.clear()
            return b

        for batch in batches:
            if not batch.num_rows:
                continue
            group, masked, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cuts = np.flatnonzero((group[1:] != group[:-1]) | (masked[1:] != masked[:-1])) + 1
            begins, ends = np.r_[0, cuts], np.r_[cuts, len(fp)]
            # lists of one member need no look, save the first and last of a batch
            many = np.flatnonzero(ends - begins > 1)
            for i in sorted({0, len(begins) - 1, *many.tolist()}):
                k = (int(group[begins[i]]), int(masked[begins[i]]))
                if k != key:
                    for f, r in close():
                        out_u.append(int(f)), out_v.append(int(r))
                    key, size, hot, held = k, 0, False, []
                part = fp[begins[i]:ends[i]].view(np.uint64)
                size += len(part)
                if size > max_list and not hot:
                    hot = True
                    for h in held:
                        out_hot.extend(h.view(np.int64).tolist())
                    held = []
                if hot:
                    out_hot.extend(part.view(np.int64).tolist())
                else:
                    held.append(part.copy())
                if len(out_u) + len(out_hot) > _CHUNK:
                    yield flush()
        for f, r in close():
            out_u.append(int(f)), out_v.append(int(r))
        yield flush()

    return scan


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_list: int = MAX_LIST) -> tuple[DataFrame, list[str]]:
    """Edges (u, v) with the same components as all pairs of ``fps`` (distinct ``fp``) within ``max_bits``."""
    if not 0 <= max_bits <= 7:
        raise ValueError("eight byte positions guarantee a shared byte for 0 to 7 differing bits")
    groups = list(combinations(range(8), max(1, 8 - max_bits - 1)))
    masks = [_signed(sum(0xFF << (8 * p) for p in g)) for g in groups]
    postings = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("g"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
        for i, m in enumerate(masks)])).alias("p"))
    postings = postings.select("p.g", "p.k", "fp").repartition("g", "k").sortWithinPartitions("g", "k")
    found = postings.mapInArrow(_scan_lists(max_bits, max_list), "u bigint, v bigint, hot boolean")
    found, path = written(found, "links")
    edges = found.filter("NOT hot").select("u", "v").distinct()
    if found.filter("hot").limit(1).count():
        edges = edges.union(_through_middles(
            found.filter("hot").select(F.col("u").alias("fp")).distinct(), max_bits))
    return edges, [path]


def _through_middles(hot: DataFrame, max_bits: int) -> DataFrame:
    """Edges between fingerprints that share a middle, at most max_bits / 2 bits from each.

    For odd ``max_bits`` one of two may be a bit further from the middle, so
    members of the wider reach are linked to the least of the narrower.
    """
    near, far = max_bits // 2, max_bits - max_bits // 2

    def middles(r):
        flips = [_signed(sum(1 << b for b in c)) for k in range(r + 1) for c in combinations(range(64), k)]
        return hot.select("fp", F.explode(F.array(*[F.lit(m) for m in flips])).alias("m")).select(
            "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("middle"))

    low = middles(near).groupBy("middle").agg(F.min("fp").alias("v"))
    return middles(far).join(low, "middle").select(F.col("fp").alias("u"), "v").filter("u <> v").distinct()


def classes(fps: DataFrame, max_bits: int = MAX_BITS, max_list: int = MAX_LIST) -> DataFrame:
    """(fp, component_id, keeper_fp) for (doc_id, fp) rows.

    component_id is the smallest doc_id of the component, keeper_fp the
    fingerprint that this document has.
    """
    reps, at = written(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprints")
    edges, paths = links(reps.select("fp"), max_bits, max_list)
    found, more = components(edges)
    roots = reps.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    # nulls last: a struct with a null doc_id must not win
    best = roots.groupBy("root").agg(F.min(F.struct(
        F.col("low").isNull().alias("n"), F.col("low"), F.col("fp"))).alias("b"))
    out, done = written(roots.join(best, "root").select(
        "fp", F.col("b.low").alias("component_id"), F.col("b.fp").alias("keeper_fp")), "classes")
    discard(fps.sparkSession, at, *paths, *more)
    return out


def assigned(docs: DataFrame, text: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS, max_list: int = MAX_LIST) -> DataFrame:
    """One row a document: doc_id, fp, component_id, keeper_fp."""
    fps, _ = written(docs.select("doc_id", fingerprint(F.col(text), shingle).alias("fp")), "fps")
    return fps.join(classes(fps, max_bits, max_list), "fp")


def stage(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, and one of its repeated rows."""
    a = assigned(docs, text, shingle, max_bits)
    keep = a.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("keeper_fp")))
    # one key, null or not, for the join and for repeated rows after it, so that texts are dealt once
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.hex("fp"))
    keep = keep.select(key.alias("key")).distinct()
    d = boxed(docs, doc_id=F.col("doc_id"), fp=fingerprint(F.col(text), shingle)).withColumn("key", key)
    return unboxed(d.join(keep, "key", "left_semi").dropDuplicates(["key"]))


def run(spark, sf_dir: str) -> DataFrame:
    a = assigned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return a.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
