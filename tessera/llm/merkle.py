"""Merkle manifest of a dataset by lag and lead windows.

A row's leaf is the SHA-256 of its columns. Leaves of a group, in order, are
joined ``fanout`` at a time to their parent's digest until one is left, the
group's subroot; subroots, in the order of the groups, likewise give the root.

1. Positions. Leaves (no text) are sorted by Spark's range partitioning and
   written; a row's position is its place in its file plus a shift from the
   row counts of the files before. Equal rows are ordered by a row number, so
   that a row repeated in a third of the table still spreads over the ranges.
2. Bands. ``height`` levels are worked out by windows over aligned blocks of
   ``fanout ** height`` leaves, with one shuffle and one sort for all of them.
   A node's digest stands on the row of its first leaf. Per level, lag and lead
   columns at fixed offsets of the node size, masked by the node's slot in its
   run and the run's length, are its siblings, and rows of first children hash
   the parent. Each sibling is carried on to the other leaves of its node. The
   first rows of the blocks are the leaves of the next band; no block is larger
   than ``fanout ** height`` rows, whatever the size of a group.
3. Proofs. A leaf's siblings are its band's, then those of its block in the
   bands above (a table ``fanout ** height`` times smaller), then its group's
   among the groups. Folding any leaf digest with them gives the root it proves.

Edge cases: null columns enter a leaf as ``-``; a null group is one of its own
and comes first; null keys come first, equal keys are ordered by leaf, and
repeated rows have equal leaves and a position each; a lone leaf is the
subroot, a lone subroot the root, and a row without siblings has the digest of
the empty string as its proof; a row whose key or counter is null is not
tampered with; text of any length is hashed where it is read; clashing names
are not touched, as only the named columns are read; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, lookup, scratch_path, table, written

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
FANOUT = 2
HEIGHT = 10
#: Rows of a proof table (at most about 5 KB each) up to which it is broadcast, by its count.
BROADCAST_PROOFS = 8_192
TAMPERED_ONE_IN = 7


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def leaf(*columns: Column) -> Column:
    """SHA-256 of the columns, each ``-`` if null, else its UTF-8 length, a colon and itself."""
    text = [c.cast("string") for c in columns]
    return sha256(F.concat(*[F.coalesce(F.concat(F.octet_length(c), F.lit(":"), c), F.lit("-")) for c in text]))


def positioned(df: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, int, str]:
    """``df`` with ``pos`` and ``n``, each row's place in its group and the group's size; the largest n; the scratch table."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ordered")
    df.withColumn("__at", F.monotonically_increasing_id()).orderBy(group, *order, "__at").drop("__at").write.parquet(path)
    name = F.col("_metadata.file_name")
    file = F.regexp_extract(name, r"^part-(\d+)", 1).cast("long") * (1 << 20) + F.coalesce(
        F.regexp_extract(name, r"-c(\d+)\.", 1).try_cast("long"), F.lit(0))
    t = spark.read.schema(df.schema).parquet(path).select("*", file.alias("__f"), F.col("_metadata.row_index").alias("__i"))
    # a row for each file and group in it: as many as there are files and groups
    counts = t.groupBy("__f", group).agg(F.count(F.lit(1)).alias("c"))
    of = Window.partitionBy(group)
    earlier = F.sum("c").over(of.orderBy("__f")) - F.col("c")
    before = F.sum("c").over(Window.partitionBy("__f").orderBy(F.col(group).asc_nulls_first())) - F.col("c")
    shifts, at = written(counts.select(F.col("__f").alias("__g"), F.col(group).alias("__k"), (earlier - before).alias("__s"),
                                       F.sum("c").over(of).alias("n")), "shifts")
    rows, largest = shifts.agg(F.count(F.lit(1)), F.max("n")).first()
    s = F.broadcast(shifts) if rows <= 16 * BROADCAST_PROOFS else shifts  # 40 bytes a row and the group's name
    t = t.join(s, (F.col("__f") == F.col("__g")) & F.col(group).eqNullSafe(F.col("__k")))
    t, out = written(t.select(*df.columns, (F.col("__i") + F.col("__s")).alias("pos"), "n"), "positions")
    discard(spark, path, at)
    return t, largest or 0, out


def band(nodes: DataFrame, group: str, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """``nodes`` (group, pos, n, digest and others) after ``height`` levels.

    ``top`` is the digest of the block on its first row; ``path`` has the
    concatenated siblings before and after the row's ancestor, a level each.
    """
    block = fanout ** height
    d = nodes.withColumn("block", F.floor(F.col("pos") / block)).withColumn("top", F.col("digest"))
    w = Window.partitionBy(group, "block").orderBy("pos")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = []
    for level in range(height):
        step = fanout ** level
        node = F.floor(F.col("pos") / step)
        slot, live, first = node % fanout, F.col("n") > step, F.col("pos") % step == 0
        run = F.least(F.lit(fanout), F.ceil(F.col("n") / step) - (node - slot))
        lags = [F.when(slot >= j, F.lag("top", j * step).over(w)) for j in range(fanout - 1, 0, -1)]
        leads = [F.when(slot + j < run, F.lead("top", j * step).over(w)) for j in range(1, fanout)]
        before, after = f"__l{level}", f"__r{level}"
        d = d.withColumns({before: F.when(live & first, F.concat_ws("", *lags)),
                           after: F.when(live & first, F.concat_ws("", *leads))})
        parent = F.when(F.col("pos") % (step * fanout) == 0, sha256(F.concat("top", after)))
        d = d.withColumn("top", F.when(live, parent).otherwise(F.col("top")))
        names.append((before, after))
    carried = {c: F.last(c, ignorenulls=True).over(so_far) for pair in names for c in pair}
    d = d.withColumns(carried)
    steps = F.array(*[F.struct(F.col(a).alias("l"), F.col(b).alias("r")) for a, b in names])
    return d.withColumn("path", F.filter(steps, lambda x: x["l"].isNotNull())).drop(*carried)


def climb(nodes: DataFrame, group: str, largest: int, fanout: int = FANOUT, height: int = HEIGHT):
    """(``nodes`` with ``path`` to its group's root and that ``root``, the table of (group, root), scratch tables)."""
    block = fanout ** height
    rows, at = written(band(nodes, group, fanout, height), "band")
    tops = rows.filter(F.col("pos") == F.col("block") * block).select(
        F.col(group), F.col("block").alias("pos"), F.ceil(F.col("n") / block).alias("n"), F.col("top").alias("digest"))
    used = [at]
    if largest > block:
        above, roots, more = climb(tops, group, -(-largest // block), fanout, height)
        used += more
    else:
        roots = tops.select(group, F.col("digest").alias("root"))
        above = tops.withColumns({"path": F.expr("cast(array() as array<struct<l:string,r:string>>)"), "root": F.col("digest")})
    above = above.select(F.col(group).alias("__g"), F.col("pos").alias("__p"), F.col("path").alias("__above"), "root")
    if tops.count() <= BROADCAST_PROOFS:
        above = F.broadcast(above)
    joined = rows.join(above, F.col(group).eqNullSafe(F.col("__g")) & (F.col("block") == F.col("__p")))
    joined = joined.withColumn("path", F.concat("path", "__above")).drop("__g", "__p", "__above", "block", "top")
    return joined, roots, used


def manifest(leaves: DataFrame, group: str = "lang", order: tuple[str, ...] = ("doc_id",), fanout: int = FANOUT,
             height: int = HEIGHT) -> DataFrame:
    """``leaves`` (group, order columns, ``digest`` and others) with ``subroot``, ``root`` and ``path``: all siblings up to the root."""
    spark = leaves.sparkSession
    placed, largest, at = positioned(leaves, group, [*order, "digest"])
    rows, roots, _ = climb(placed, group, largest, fanout, height)
    discard(spark, at)
    subroots = roots.select(F.lit(0).alias("__all"), F.col(group).alias("__group"), F.col("root").alias("digest"))
    placed, largest, at = positioned(subroots, "__all", ["__group"])
    tree, _, _ = climb(placed, "__all", largest, fanout, height)
    tree, _ = written(tree.select("__group", F.col("path").alias("__path"), F.col("root").alias("__root")), "groups")
    discard(spark, at)
    rows = rows.withColumnRenamed("root", "subroot")
    rows = lookup(rows.withColumnRenamed(group, "__group"), tree, "__group", "inner", ["digest", "pos"], most=BROADCAST_PROOFS)
    return rows.select(F.col("__group").alias(group), *[c for c in leaves.columns if c != group],
                       "subroot", F.col("__root").alias("root"), F.concat("path", "__path").alias("path"))


def proof(path: Column) -> Column:
    """SHA-256 of a path's siblings, from the leaf to the root."""
    return sha256(F.concat_ws("", F.transform(path, lambda x: F.concat(x["l"], x["r"]))))


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf digest and its siblings prove."""
    return F.aggregate(path, digest, lambda d, x: sha256(F.concat(x["l"], d, x["r"])))


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_ONE_IN == 0
    leaves = docs.select("lang", "doc_id", leaf(*map(F.col, COLUMNS)).alias("digest"),
                         F.when(hit & F.col("n_chars").isNotNull(), leaf(*changed)).alias("tampered"))
    m = manifest(leaves)
    m = m.withColumn("folded_root", folded(F.coalesce("tampered", "digest"), F.col("path")))
    return m.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


SQL = """
WITH RECURSIVE e AS (SELECT row_number() OVER () AS rid, doc_id, lang, n_chars,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail,
    list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
        lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(0, 8), lambda z: CAST(z AS BIGINT))),
        lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS crc FROM documents),
l AS (SELECT rid, doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 7 = 0 THEN sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS bad FROM e),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
t AS (SELECT lang, 0 AS lvl, pos, n, leaf AS d FROM o UNION ALL
      SELECT lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
s AS (SELECT lang, d AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, pos, n, subroot AS d FROM s UNION ALL
      SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lvl, pos // 2, n),
p AS (SELECT rid, lang, 0 AS lvl, pos, n, coalesce(bad, leaf) AS cur, '' AS sib FROM o UNION ALL
      SELECT p.rid, p.lang, p.lvl + 1, p.pos // 2, (p.n + 1) // 2,
             sha256(CASE WHEN p.pos % 2 = 1 THEN t.d || p.cur ELSE p.cur || coalesce(t.d, '') END), p.sib || coalesce(t.d, '')
      FROM p LEFT JOIN t ON t.lang IS NOT DISTINCT FROM p.lang AND t.lvl = p.lvl AND t.pos = xor(p.pos, 1) WHERE p.n > 1),
q AS (SELECT p.rid, s.subroot, 0 AS lvl, s.pos, s.n, p.cur, p.sib FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang WHERE p.n = 1 UNION ALL
      SELECT q.rid, q.subroot, q.lvl + 1, q.pos // 2, (q.n + 1) // 2,
             sha256(CASE WHEN q.pos % 2 = 1 THEN u.d || q.cur ELSE q.cur || coalesce(u.d, '') END), q.sib || coalesce(u.d, '')
      FROM q LEFT JOIN u ON u.lvl = q.lvl AND u.pos = xor(q.pos, 1) WHERE q.n > 1)
SELECT o.doc_id, o.leaf, q.subroot, r.d AS root, sha256(q.sib) AS proof_sha256, q.cur AS folded_root, q.cur = r.d AS verified
FROM o JOIN q USING (rid) CROSS JOIN (SELECT d FROM u WHERE n = 1) r WHERE q.n = 1
"""
