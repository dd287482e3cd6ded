"""Boilerplate lines by site-relative frequency.

A line of a host (``source``) is boilerplate if the pages of the host that
hold it exceed ``max_ratio`` of all pages of the host, and are at least
``min_pages``. Pages with the same text count as one page, so that a group of
copies does not make its own prose boilerplate. Lines are compared without
the white space around them; lines without a word are never counted and never
dropped.

In the pipeline's stage near copies count as one page too, or each line of a
large group of them would go from all its copies. A page is shared if
``shared_pct`` of its characters lie in lines that ``min_pages`` pages of the
host hold; all shared pages with the same rarest such line are one page. Near
copies with one line changed have the same rarest line, except those that
changed that one. The query counts distinct texts, as its SQL does.

Only (host, digest of the line, digest of the page) travels: duplicates are
dropped and counts combined on the map side, so neither a hot host nor a hot
line gathers in a task. A host has at most (mean lines a page / max_ratio)
boilerplate lines; their digests come back as one array for each host that has
any, and every document drops its own lines in place.

Edge cases: a null text stays null, with no lines; a null host is a host of
its own; repeated rows are pages with the same text; an empty table gives an
empty result; a document of nothing but boilerplate is left with an empty text;
a very long text is one row, its lines an array of one task; other columns are
boxed, so any name may clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_CHARS, boxed, cut, lookup

MAX_RATIO_PCT = 5
MIN_PAGES = 5
#: Share of a page's characters in common lines from which it may be a near copy (the stage).
SHARED_PCT = 80


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(SPACE_CHARS)).cast("binary")))


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate(docs: DataFrame, text: str = "text", host: str = "source",
                max_ratio_pct: int = MAX_RATIO_PCT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): digests of the boilerplate lines of each host that has any."""
    d = docs.select(F.col(host).cast("string").alias("host"), F.col(text).cast("string").alias("t"))
    d = d.filter(F.col("t").isNotNull()).withColumn("page", F.unhex(F.md5(F.col("t").cast("binary"))))
    pages = d.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    pages = pages.withColumnRenamed("host", "__h")
    lines = d.select("host", "page", F.explode(F.array_distinct(F.transform(
        F.filter(F.split("t", "\n"), _has_word), _digest))).alias("line"))
    counts = lines.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.filter(F.col("n") >= min_pages)
    over = counts.join(pages, F.col("host").eqNullSafe(F.col("__h"))).filter(
        F.col("n") * 100 > F.col("pages") * max_ratio_pct)
    return over.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def boilerplate_near(docs: DataFrame, text: str = "text", host: str = "source", max_ratio_pct: int = MAX_RATIO_PCT,
                     min_pages: int = MIN_PAGES, shared_pct: int = SHARED_PCT) -> DataFrame:
    """As ``boilerplate``, with near copies counted as one page."""
    d = docs.select(F.col(host).cast("string").alias("host"), F.col(text).cast("string").alias("t"))
    d = d.filter(F.col("t").isNotNull()).withColumn("page", F.unhex(F.md5(F.col("t").cast("binary"))))
    # a page without a line of words has one null line, so that it is still counted
    lines = d.select("host", "page", F.explode_outer(F.array_distinct(F.transform(
        F.filter(F.split("t", "\n"), _has_word), lambda x: F.struct(
            _digest(x).alias("line"), F.length(F.btrim(x, F.lit(SPACE_CHARS))).alias("size"))))).alias("l"))
    lines = cut(lines.select("host", "page", "l.line", "l.size", F.struct("host", "l.line").alias("at")).distinct())
    common = lines.filter(F.col("line").isNotNull()).groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    common = cut(common.filter(F.col("n") >= min_pages))
    j = lookup(lines, common, "at", "left", ["page"])
    held = F.col("n").isNotNull()
    pages = j.groupBy("host", "page").agg(
        F.sum("size").alias("size"), F.sum(F.when(held, F.col("size"))).alias("shared"),
        F.min(F.when(held, F.struct("n", "line"))).alias("rarest"), F.collect_list(F.when(held, F.col("line"))).alias("lines"))
    near = F.col("shared") * 100 >= F.col("size") * shared_pct
    pages = cut(pages.select(
        "host", "lines", F.when(near, F.struct(F.lit(True).alias("near"), F.col("rarest.line").alias("id"))).otherwise(
            F.struct(F.lit(False).alias("near"), F.col("page").alias("id"))).alias("page")))
    total = pages.select("host", "page").distinct().groupBy(F.col("host").alias("__h")).agg(F.count(F.lit(1)).alias("pages"))
    n = pages.select("host", "page", F.explode("lines").alias("line")).distinct()
    n = n.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    over = n.join(total, F.col("host").eqNullSafe(F.col("__h"))).filter(
        F.col("n") * 100 > F.col("pages") * max_ratio_pct)
    return over.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def stripped(docs: DataFrame, text: str = "text", host: str = "source", max_ratio_pct: int = MAX_RATIO_PCT,
             min_pages: int = MIN_PAGES, found=boilerplate) -> DataFrame:
    """(__row, text, n_lines, n_removed): each row of ``docs`` beside its text without boilerplate lines."""
    hosts = cut(found(docs, text, host, max_ratio_pct, min_pages))
    # bytes count, not hosts: 16 for each digest
    cost = hosts.agg(F.sum(F.size("lines"))).first()[0] or 0
    d = boxed(docs, text=F.col(text).cast("string"), host=F.col(host).cast("string"))
    d = lookup(d, hosts, "host", "left", ["text"], rows=cost)
    d = d.withColumn("all", F.split("text", "\n"))
    keep = F.filter("all", lambda x: ~(_has_word(x) & F.array_contains("lines", _digest(x))))
    d = d.withColumn("kept", F.when(F.col("lines").isNull(), F.col("all")).otherwise(keep))
    n_all, n_kept = (F.coalesce(F.size(c), F.lit(0)).cast("long") for c in ("all", "kept"))
    return d.select("__row", F.array_join("kept", "\n").alias("text"), n_all.alias("n_lines"),
                    (n_all - n_kept).alias("n_removed"))


def stage(docs: DataFrame) -> DataFrame:
    """The documents with their boilerplate lines dropped; n_chars follows the text."""
    d = stripped(docs, found=boilerplate_near)
    out = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars")}
    return d.select(*[out.get(c, F.col(f"__row.`{c}`")) for c in docs.columns])


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return stripped(docs).select("__row.doc_id", "n_lines", "n_removed", "text")


SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
l AS (SELECT rid, doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d WHERE text IS NOT NULL),
x AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
c AS (SELECT source, key, count(DISTINCT text) AS n FROM x WHERE key <> '' GROUP BY source, key),
p AS (SELECT source, count(DISTINCT text) AS pages FROM d WHERE text IS NOT NULL GROUP BY source),
b AS (SELECT c.source, c.key FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source
      WHERE n >= 5 AND n * 100 > pages * 5),
k AS (SELECT x.rid, count(*) AS n_lines, count(b.key) AS n_removed,
             string_agg(CASE WHEN b.key IS NULL THEN line END, chr(10) ORDER BY pos) AS kept
      FROM x LEFT JOIN b ON x.source IS NOT DISTINCT FROM b.source AND x.key = b.key GROUP BY x.rid)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.kept, '') END AS text
FROM d LEFT JOIN k USING (rid)
"""
