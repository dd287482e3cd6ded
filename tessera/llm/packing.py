"""Best-fit packing into sequences of several permitted lengths.

A document is ``octet_length`` byte tokens long (any length column may be
given). One longer than the largest permitted sequence is cut into full
sequences and a rest, so nothing is truncated. Pieces are dealt to shards of
about ``shard_pieces`` by hash, whatever their number; a shard is packed in
one task, from narrow rows without text, and its last bins are downsized, so
sharding costs a shard less than one short sequence of each size. Repeated rows
are counted first and their copies dealt evenly over the shards.

In a shard, pieces go in order of falling length to the open bin with the
least room that still holds them. Where none does, a bin is opened of the size
that costs least for each token it can expect: (size + ``overhead``) over the
tokens that are left for it, or the size if there are more. This is done for
each upper limit on the sizes to open (longer pieces open the least size that
holds them), the plan of least total cost is kept, and in it each bin shrinks
to the least permitted length that holds its contents.

Edge cases: null and empty texts take no room and have no bin; repeated rows
are pieces of their own; a null doc_id is kept; ties go by doc_id and piece;
an empty table gives an empty result; a very long text is as many pieces as it
fills; other columns are not read, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut

CAPACITIES = (2048, 8192, 32768)
OVERHEAD = 64
SHARD_PIECES = 2000


def plan(lengths: list[int], capacities: tuple[int, ...], overhead: int = OVERHEAD):
    """(bin, offset) for each of ``lengths`` (falling), and the capacity of each bin."""
    sizes = sorted(capacities)
    best = None
    for top in sizes:
        placed, used, caps, room = [], [], [], []  # room: (space left, bin), ascending
        rest = sum(lengths)
        for n in lengths:
            at = bisect_left(room, (n, -1))
            if at < len(room):
                space, b = room.pop(at)
            else:
                fits = [c for c in sizes if n <= c <= top] or [next(c for c in sizes if n <= c)]
                space = min(fits, key=lambda c: ((c + overhead) / min(c, rest), c))
                b = len(caps)
                caps.append(space)
                used.append(0)
            placed.append((b, used[b]))
            used[b] += n
            rest -= n
            if space > n:
                insort(room, (space - n, b))
        caps = [next(c for c in sizes if u <= c) for u in used]
        cost = sum(caps) + overhead * len(caps)
        if best is None or cost < best[0]:
            best = cost, placed, caps
    return best[1], best[2]


def pieces(docs: DataFrame, length, largest: int, spread) -> DataFrame:
    """(doc_id, spread, copies, piece, start, length), one piece at least for each distinct row."""
    d = docs.select("doc_id", spread.alias("spread"), F.coalesce(length, F.lit(0)).cast("long").alias("total"))
    d = d.groupBy("doc_id", "spread", "total").agg(F.count(F.lit(1)).alias("copies"))
    last = F.greatest(F.lit(0), F.ceil(F.col("total") / largest) - 1).cast("long")
    d = d.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = F.col("piece") * largest
    return d.select("doc_id", "spread", "copies", "piece", start.alias("start"),
                    F.least(F.lit(largest), F.col("total") - start).cast("long").alias("length"))


def dealt(p: DataFrame, shards: int) -> DataFrame:
    """``p`` by shard: one row for each shard that copies of a piece go to, with their number there."""
    many = F.least(F.col("copies"), F.lit(shards))
    p = p.withColumn("__i", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)))
    at = F.pmod(F.pmod(F.xxhash64("spread", "piece"), F.lit(shards)) + F.col("__i"), F.lit(shards))
    share = F.floor(F.col("copies") / shards) + (F.col("__i") < F.col("copies") % shards).cast("long")
    return p.withColumns({"shard": at, "copies": share.cast("long")}).drop("__i")


def packed(docs: DataFrame, text: str = "text", capacities: tuple[int, ...] = CAPACITIES,
           overhead: int = OVERHEAD, shard_pieces: int = SHARD_PIECES, length=None,
           keyed: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, offset, capacity, used), one row a piece.

    ``keyed`` adds ``row_hash``, by which (with doc_id) a piece finds its text.
    """
    t = F.col(text).cast("string")
    p = pieces(docs, F.octet_length(t) if length is None else length, max(capacities), F.xxhash64("doc_id", t))
    p = cut(p)
    shards = max(1, -(-(p.agg(F.sum("copies")).first()[0] or 0) // shard_pieces))
    p = dealt(p, shards)
    id_type = p.schema["doc_id"].dataType.simpleString()

    def pack(key, rows):
        rows = rows.loc[rows.index.repeat(rows["copies"])]
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        full = rows["length"].to_numpy() > 0
        at, caps = plan(rows["length"][full].tolist(), capacities, overhead)
        used = [0] * len(caps)
        for (b, o), n in zip(at, rows["length"][full]):
            used[b] = max(used[b], o + int(n))
        out = rows[["doc_id", "piece", "start", "length"]].reset_index(drop=True)
        hashes = rows["spread"].to_numpy()
        columns = {"bin_id": [(int(key[0]) << 32) + b for b, _ in at], "offset": [o for _, o in at],
                   "capacity": [caps[b] for b, _ in at], "used": [used[b] for b, _ in at]}
        for c, v in columns.items():
            out[c] = v + [None] * (len(out) - len(v))
            out[c] = out[c].astype("Int64")
        if keyed:
            out["row_hash"] = hashes
        out["doc_id"] = out["doc_id"].astype("Int64") if id_type in ("bigint", "int") else out["doc_id"]
        return out

    schema = (f"doc_id {id_type}, piece bigint, start bigint, length bigint, bin_id bigint, "
              "offset bigint, capacity bigint, used bigint" + (", row_hash bigint" if keyed else ""))
    return p.groupBy("shard").applyInPandas(pack, schema)


def stage(docs: DataFrame, text: str = "text") -> DataFrame:
    """``packed`` rows with ``content``: the UTF-8 bytes of each piece (a cut may fall inside a character).

    Pieces and texts meet by one shuffle on (doc_id, hash of doc_id and text).
    """
    def key(h):
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.hex(h))

    t = F.col(text).cast("string")
    p = packed(docs, text, keyed=True)
    texts = docs.select(key(F.xxhash64("doc_id", t)).alias("__key"), t.alias("__text")).dropDuplicates(["__key"])
    p = p.withColumn("__key", key(F.col("row_hash"))).join(texts, "__key", "left")
    content = F.substring(F.col("__text").cast("binary"), (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    return p.withColumn("content", F.coalesce(content, F.lit("").cast("binary"))).drop("__key", "__text", "row_hash")


def run(spark, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
