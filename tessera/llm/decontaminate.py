"""Benchmark decontamination by SimHash windows (DataFrame functions only).

A window of a document is compared with the benchmark items of its own length
in words. Shingles are five words (all words of a shorter item), words are
runs of letters, marks and digits, lower-cased.

1. Seeds. A window without a shingle of an item has similarity zero with it,
   so only windows that an item's shingle lines up with one of its own are
   cut: item-sized, starting where that item would start. This drops nothing
   that could pass step 4.
2. Each window gets a 64-bit SimHash of its shingles, as each item has one.
3. Multi-index Hamming search: ``radius + 1`` bit blocks; two fingerprints
   within ``radius`` have a block in common, so joining on (length, block,
   value) finds every one. A pair is kept at its first common block alone,
   then tested on its differing bits.
4. Exact weighted-shingle similarity: shingles weighted by how often they
   occur, sum of minima over sum of maxima, at least ``min_similarity``.

``radius`` is wide for that reason: at similarity 0.8 a ninth of the shingles
differ, about 9.7 of 64 bits are expected to (standard deviation 2.9), so 20
leaves out fewer than one in a thousand of the least similar pairs, and none
that is nearly equal.

The benchmark's shingles (narrow rows of a hash and three integers) are
broadcast up to ``SEED_ROWS`` counted rows, items with their bags up to
``ITEM_BYTES`` summed bytes, and both are shuffled beyond; documents are
shuffled only if their hits exceed ``BROADCAST_ROWS``.

At radius 20 a block has three bits, so it is the seeds that spare work, and
the Hamming search that sets the fingerprint test; a radius whose blocks
selected more would lose pairs of similarity 0.8 to 0.85 (measured in the tests).

Edge cases: null or empty texts and items never match; a document shorter than
an item is one window; documents are told apart by doc_id and text together,
so null or repeated doc_ids do no harm; repeated items give one row; empty
tables give an empty result; a very long text is one row, its words and
shingle hashes arrays of one task; other columns, whatever their names, are
boxed by ``stage`` and not read by ``matches``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, boxed, cut, lookup, unboxed

SHINGLE = 5
RADIUS = 20
MIN_SIMILARITY = 0.8
SEED_ROWS = 2_000_000     # some 100 MB in a task's lookup table
ITEM_BYTES = 64 << 20
_NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), _NOT_WORD), "")


def _shingles(words: Column, k: Column) -> Column:
    """Hashes of the k-word shingles, in order of position."""
    n = F.size(words)
    return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1),
                                      lambda i: F.xxhash64(F.slice(words, i, k)))).otherwise(
        F.array().cast("array<bigint>"))


def _simhash(hashes: str) -> Column:
    """Bit b is set if it is set in over half the hashes."""
    bits = F.sequence(F.lit(0), F.lit(63))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(F.when(
        2 * F.size(F.filter(hashes, lambda h: F.getbit(h, b) == 1)) > F.size(hashes),
        F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))))


def _bag(sorted_hashes: str) -> Column:
    """A multiset as a set: the hash of each shingle with the number of its occurrence."""
    return F.transform(sorted_hashes, lambda h, i: F.xxhash64(
        h, i - F.array_position(sorted_hashes, h)))


def _with_fingerprint(df: DataFrame, hashes: str) -> DataFrame:
    return df.withColumn("fp", _simhash(hashes)).withColumn(hashes, F.sort_array(hashes)).withColumn(
        "bag", _bag(hashes)).drop(hashes)


def _blocks(radius: int) -> list[int]:
    """Masks of radius + 1 bit blocks that share out the 64 bits evenly."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _posted(df: DataFrame, masks: list[int]) -> DataFrame:
    return df.withColumn("__p", F.explode(F.array(*[
        F.struct(F.lit(i).alias("b"), F.col("fp").bitwiseAND(F.lit(m)).alias("v"))
        for i, m in enumerate(masks)])))


def prepared_items(benchmark: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, n, k, hashes, fp, bag) of the items that have words."""
    items = benchmark.select("item_id", _words(F.col("text")).alias("ws")).withColumn("n", F.size("ws"))
    items = items.filter("n > 0").withColumn("k", F.least(F.lit(shingle), F.col("n")))
    items = items.withColumn("hashes", _shingles(F.col("ws"), F.col("k"))).drop("ws")
    return cut(_with_fingerprint(items.withColumn("hs", F.col("hashes")), "hs"))


def _windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(key, doc_id, start, n, k, fp, bag): the windows that some item's shingle lines up with."""
    seeds = items.select("n", "k", F.posexplode("hashes").alias("at", "h")).distinct()
    seeds = cut(seeds.select(F.col("h").alias("__h"), F.col("k").alias("__k"), "n", "at"))
    few = seeds.count() <= SEED_ROWS
    sizes = [r[0] for r in seeds.select("__k").distinct().collect()]  # at most ``shingle`` of them
    d = docs.withColumn("ws", _words(F.col("text"))).drop("text")
    hits = None
    for k in sorted(sizes):
        s = d.select("key", F.posexplode(_shingles(F.col("ws"), F.lit(k))).alias("pos", "h"))
        of_k = seeds.filter(F.col("__k") == k)
        s = s.join(F.broadcast(of_k) if few else of_k, F.col("h") == F.col("__h"))
        s = s.select("key", (F.col("pos") - F.col("at")).alias("start"), "n", F.lit(k).alias("k"))
        hits = s if hits is None else hits.union(s)
    if hits is None:
        hits = docs.limit(0).select("key", F.lit(0).alias("start"), F.lit(0).alias("n"), F.lit(0).alias("k"))
    hits = cut(hits.distinct()).withColumnRenamed("key", "__key")
    if hits.count() <= BROADCAST_ROWS:
        hits = F.broadcast(hits)
    w = docs.join(hits, F.col("key") == F.col("__key")).withColumn("ws", _words(F.col("text")))
    # a window that would hang over an end is moved inside
    w = w.withColumn("start", F.greatest(F.lit(0), F.least("start", F.size("ws") - F.col("n"))))
    w = w.select("key", "doc_id", "start", "n", "k", F.slice("ws", F.col("start") + 1, F.col("n")).alias("ws"))
    w = w.distinct().withColumn("hs", _shingles(F.col("ws"), F.col("k"))).drop("ws")
    return _with_fingerprint(w, "hs")


def _key(text: str) -> Column:
    """Digest of doc_id and text: rows with the same key have the same result."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")),
                                     F.col(text).cast("string")).cast("binary")))


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(_key(text).alias("key"), "doc_id", F.col(text).cast("string").alias("text"))


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", shingle: int = SHINGLE,
            radius: int = RADIUS, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """(key, doc_id, item_id, similarity, hamming, start_word, n_words): the best window for each pair."""
    items = prepared_items(benchmark, shingle)
    masks = _blocks(radius)
    # cut, so that no fingerprint is worked out again for each of its blocks
    w = _posted(cut(_windows(_keyed(docs, text), items)), masks)
    i = _posted(items.select("item_id", F.col("n").alias("__n"), F.col("fp").alias("__fp"),
                             F.col("bag").alias("__bag"), F.col("fp")), masks)
    i = i.select("item_id", "__n", "__fp", "__bag", F.col("__p").alias("__q")).distinct()
    i = cut(i)
    # a bag is eight bytes a shingle; 64 for the rest of a row
    if (i.agg(F.sum(8 * F.size("__bag") + 64)).first()[0] or 0) <= ITEM_BYTES:
        i = F.broadcast(i)
    pairs = w.join(i, (F.col("n") == F.col("__n")) & (F.col("__p.b") == F.col("__q.b"))
                   & (F.col("__p.v") == F.col("__q.v")))
    x = F.col("fp").bitwiseXOR(F.col("__fp"))
    first = F.coalesce(*[F.when(x.bitwiseAND(F.lit(m)) == 0, F.lit(b)) for b, m in enumerate(masks)])
    pairs = pairs.withColumn("hamming", F.bit_count(x)).filter(
        (F.col("hamming") <= radius) & (first == F.col("__p.b")))
    both = F.size(F.array_intersect("bag", "__bag"))
    pairs = pairs.withColumn("similarity", both / (F.size("bag") + F.size("__bag") - both))
    best = F.max(F.struct("similarity", (-F.col("hamming")).alias("h"), (-F.col("start")).alias("s"), "n"))
    return pairs.filter(F.col("similarity") >= min_similarity).groupBy("key", "doc_id", "item_id").agg(
        best.alias("x")).select("key", "doc_id", "item_id", F.col("x.similarity"), (-F.col("x.h")).alias("hamming"),
                                (-F.col("x.s")).cast("long").alias("start_word"), F.col("x.n").cast("long").alias("n_words"))


def stage(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, with their columns unchanged."""
    found = cut(matches(docs, benchmark, text).select("key").distinct().withColumnRenamed("key", "doc"))
    return unboxed(lookup(boxed(docs, doc=_key(text)), found, "doc", "left_anti", ["doc"]))


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("key")
