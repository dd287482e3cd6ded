"""Exact quantiles (linear interpolation) by refinement of value ranges.

For columns of a table (``column_quantiles``) a sketch of all rows gives a narrow
range about each wanted rank, one aggregate counts the rows below and in each,
and only the values in these ranges are grouped and ranked; where a range
misses its rank or is too wide, refinement does the rest.

Otherwise input is a value-count table ``(name, x, cnt)``: one row per distinct value
(map-side combined when it was built, so hot values cost one row per task).
Each wanted rank starts in a range that holds all values of its column. A round
cuts every range at sketch quantiles of its distinct values, counts the values
of each part, and keeps the parts that hold a wanted rank: a sixty-fourth of
the range, whatever its size. Ranges of at most ``SMALL`` distinct values are
ranked by a window over themselves. So no window sees more than that, and the
number of rounds, not the size of a task, grows with the data. The driver sees
range bounds, counts, and the rows at the wanted ranks (two per quantile);
the interpolation ``x[lo] + (h - lo) * (x[lo+1] - x[lo])`` with ``h = (n-1)q``
equals ``percentile`` / ``quantile_cont`` exactly.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTS = 64        # parts a range is cut into in a round
SMALL = 100_000   # distinct values of a range that a window ranks
SKETCHED = 200    # distinct values a part that its bounds are sketched from
SKETCH = 5_000    # accuracy of the sketch of all rows: its ranks are off by one part of so many


def _targets(n: int, probs) -> list[int]:
    idx = set()
    for p in probs:
        h = (n - 1) * p
        lo = math.floor(h)
        idx.add(lo)
        idx.add(min(lo + 1, n - 1))
    return sorted(idx)


def bucket_expr(x, bounds: list):
    """How many of the sorted ``bounds`` lie below ``x``, as a balanced tree of
    comparisons (their logarithm a row, within generated code)."""
    def tree(lo, hi):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x > F.lit(bounds[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))
    return tree(0, len(bounds))


def count_below(bounds, x, steps: int):
    """How many of the sorted array ``bounds`` lie below ``x``, by ``steps`` halvings: for more bounds than code can hold."""
    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = F.get(bounds, mid) < x
        inside = s["lo"] < s["hi"]
        return F.struct(F.when(inside & below, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(inside & ~below, mid).otherwise(s["hi"]).alias("hi"))
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, steps))), start, halve)["lo"]


def _in_range(r):
    """(name, lo, hi]: None is open."""
    return (F.col("name") == r["name"]) & _between(F.col("x"), r)


def _tagged(vc: DataFrame, ranges: list[dict]) -> DataFrame:
    """Rows of ``ranges`` (disjoint) with the number of theirs."""
    tag = F.coalesce(*[F.when(_in_range(r), F.lit(i)) for i, r in enumerate(ranges)])
    return vc.select(tag.alias("r"), "x", "cnt").where(F.col("r").isNotNull())


def _refined(vc: DataFrame, ranges: list[dict]) -> list[dict]:
    """The parts of ``ranges`` that hold their targets."""
    probs = [i / PARTS for i in range(1, PARTS)]
    tagged = _tagged(vc, ranges)

    def sketched(rows):
        return {r["r"]: sorted(set(r["b"])) for r in rows.groupBy("r").agg(
            F.percentile_approx("x", probs, 2_000).alias("b")).collect()}
    # some of the values are enough to cut a range about evenly; its parts are counted over all of them
    every = min(r["distinct"] for r in ranges) // (PARTS * SKETCHED)
    bounds = sketched(tagged.where(F.pmod(F.xxhash64("x"), F.lit(every)) == 0)) if every > 1 else {}
    if len(bounds) < len(ranges):
        bounds = sketched(tagged)
    part = F.coalesce(*[F.when(F.col("r") == i, bucket_expr(F.col("x"), b)) for i, b in bounds.items()])
    rows = tagged.groupBy("r", part.alias("p")).agg(
        F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("d")).collect()
    out = []
    for i, r in enumerate(ranges):
        before, edges = r["before"], [r["lo"], *bounds.get(i, []), r["hi"]]
        for row in sorted((x for x in rows if x["r"] == i), key=lambda x: x["p"]):
            held = [t for t in r["targets"] if before <= t < before + row["n"]]
            if held:
                out.append({"name": r["name"], "lo": edges[row["p"]], "hi": edges[row["p"] + 1],
                            "before": before, "targets": held, "distinct": row["d"]})
            before += row["n"]
    return out


def quantiles_from_counts(vc: DataFrame, probs, sizes: dict | None = None) -> dict:
    """{name: [q for q in probs]} from ``(name, x double, cnt)`` (x not NULL).

    ``sizes`` ({name: (values, distinct values)}) saves a small job when the
    caller has them; an upper bound of the distinct values will do.
    """
    if sizes is None:
        sizes = {r["name"]: (r["n"], r["d"]) for r in vc.groupBy("name").agg(
            F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("d")).collect()}
    todo = [{"name": k, "lo": None, "hi": None, "before": 0, "targets": _targets(int(n), probs), "distinct": d}
            for k, (n, d) in sizes.items() if n]
    return _interpolated({k: n for k, (n, _) in sizes.items()}, probs, _values_at(vc, todo))


def _values_at(vc: DataFrame, todo: list[dict]) -> dict:
    """{(name, rank): value} of the targets of the ranges ``todo``."""
    done = [r for r in todo if r["distinct"] <= SMALL]
    todo = [r for r in todo if r["distinct"] > SMALL]
    while todo:
        todo = _refined(vc, todo)
        done += [r for r in todo if r["distinct"] <= SMALL]
        todo = [r for r in todo if r["distinct"] > SMALL]
    at = {}
    if done:
        w = Window.partitionBy("r").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
        by = lambda f: F.element_at(F.array(*[f(r) for r in done]), F.col("r") + 1)
        end = by(lambda r: F.lit(r["before"]).cast("bigint")) + F.sum("cnt").over(w)
        wanted = by(lambda r: F.array(*[F.lit(t) for t in r["targets"]]).cast("array<bigint>"))
        ranked = _tagged(vc, done).select("r", "x", "cnt", end.alias("stop"))
        start, stop = F.col("stop") - F.col("cnt"), F.col("stop")
        # plain comparisons find the few rows at a wanted rank among all that are ranked
        most = max(len(r["targets"]) for r in done)
        nth = [by(lambda r, j=j: F.lit(r["targets"][j] if j < len(r["targets"]) else None).cast("bigint")) for j in range(most)]
        at_rank = F.lit(False)
        for t in nth:
            at_rank = at_rank | F.coalesce((t >= start) & (t < stop), F.lit(False))
        hits = ranked.where(at_rank).select("r", "x", F.explode(F.filter(
            wanted, lambda t: (t >= F.col("stop") - F.col("cnt")) & (t < F.col("stop")))).alias("t"))
        for h in hits.collect():                                   # <= 2 rows per quantile
            at[(done[h["r"]]["name"], h["t"])] = h["x"]
    return at


def _interpolated(sizes: dict, probs, at: dict) -> dict:
    """{name: [q for q in probs]} from the number of values of each name and the values at the ranks."""
    out = {}
    for k, n in sizes.items():
        if not n:
            out[k] = None
            continue
        vals = []
        for p in probs:
            h = (n - 1) * p
            lo = math.floor(h)
            hi = min(lo + 1, n - 1)
            a, b = at[(k, lo)], at[(k, hi)]
            vals.append(a if hi == lo or h == lo else a + (h - lo) * (b - a))
        out[k] = vals
    return out


def sketches(x, probs):
    """Values on either side of each wanted rank, a little beyond the error of the sketch."""
    return F.percentile_approx(x, [min(1.0, max(0.0, p + e * 2 / SKETCH)) for p in probs for e in (-1, 1)], SKETCH)


def _near(name: str, n: int, probs, points) -> list[dict]:
    """Disjoint ranges that should hold the wanted ranks of a column of ``n`` values; ``points`` are its ``sketches``."""
    whole = {"name": name, "lo": None, "hi": None, "targets": _targets(n, probs), "before": 0, "distinct": n}
    if n <= SMALL:
        return [whole]
    out = []
    for p, lo, hi in sorted((p, points[2 * i], points[2 * i + 1]) for i, p in enumerate(probs)):
        # a range is open below: the next smaller double stands before its least value
        r = {"name": name, "lo": None if p <= 2 / SKETCH else math.nextafter(lo, -math.inf),
             "hi": None if p >= 1 - 2 / SKETCH else hi, "targets": _targets(n, [p])}
        last = out[-1] if out else None
        if last and (last["hi"] is None or r["lo"] is None or r["lo"] <= last["hi"]):
            last["hi"] = None if last["hi"] is None or r["hi"] is None else max(last["hi"], r["hi"])
            last["targets"] = sorted({*last["targets"], *r["targets"]})
        else:
            out.append(r)
    return out


def _between(x, r):
    """(lo, hi]: None is open."""
    c = x.isNotNull()
    if r["lo"] is not None:
        c = c & (x > F.lit(r["lo"]))
    if r["hi"] is not None:
        c = c & (x <= F.lit(r["hi"]))
    return c


def column_quantiles(wide: DataFrame, sizes: dict, points: dict, probs, aggs=()) -> tuple[dict, dict]:
    """({column: [quantiles]}, row of ``aggs``) of the double columns of ``wide``, exactly.

    NULLs are left out, NaN and infinities must be NULL. ``sizes`` has the number
    of values and ``points`` the ``sketches`` of each column; ``aggs`` are
    further aggregates for the pass that counts.
    """
    ranges = [r for c, n in sizes.items() if n for r in _near(c, n, probs, points.get(c))]
    todo = [(i, r) for i, r in enumerate(ranges) if "distinct" not in r]
    counts = [e for i, r in todo for e in (
        F.count_if(F.col(f"`{r['name']}`") <= F.lit(r["lo"])).alias(f"before{i}") if r["lo"] is not None else F.lit(0).alias(f"before{i}"),
        F.count_if(_between(F.col(f"`{r['name']}`"), r)).alias(f"within{i}"))]
    row = wide.agg(*aggs, *counts).collect()[0].asDict() if counts or aggs else {}
    missed = set()
    for i, r in todo:
        r["before"], r["distinct"] = row[f"before{i}"], row[f"within{i}"]
        if not all(r["before"] <= t < r["before"] + r["distinct"] for t in r["targets"]):
            missed.add(r["name"])
    ranges = [r for r in ranges if r["name"] not in missed] + [
        {"name": c, "lo": None, "hi": None, "before": 0, "targets": _targets(sizes[c], probs), "distinct": sizes[c]} for c in missed]

    def single(r):
        return r["lo"] is not None and r["hi"] is not None and math.nextafter(r["lo"], math.inf) == r["hi"]
    at = {(r["name"], t): r["hi"] for r in ranges if single(r) for t in r["targets"]}
    ranges = [r for r in ranges if not single(r)]
    if ranges:
        cols = {r["name"]: [q for q in ranges if q["name"] == r["name"]] for r in ranges}
        kept = wide.select(*[F.when(reduce(or_, [_between(F.col(f"`{c}`"), r) for r in rs]), F.col(f"`{c}`")).alias(c)
                             for c, rs in cols.items()])
        near = kept.unpivot([], [F.col(f"`{c}`") for c in cols], "name", "x").where(F.col("x").isNotNull()) \
            .groupBy("name", "x").agg(F.count(F.lit(1)).alias("cnt")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            many = [r for r in ranges if r["distinct"] > SMALL]      # rows so far: they may be few values
            if many:
                found = {r["r"]: r["d"] for r in _tagged(near, many).groupBy("r").agg(F.count(F.lit(1)).alias("d")).collect()}
                for i, r in enumerate(many):
                    r["distinct"] = found[i]
            at.update(_values_at(near, ranges))
        finally:
            near.unpersist()
    return _interpolated(sizes, probs, at), row


def value_count_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(name, x, cnt) of the numeric columns as doubles, NULL/NaN/inf dropped."""
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    long = wide.unpivot([], [F.col(f"`{c}`") for c in cols], "name", "x")
    ok = F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") != float("inf"))
    return long.where(ok).groupBy("name", "x").agg(F.count(F.lit(1)).alias("cnt"))


def exact_quantiles(df: DataFrame, cols: list[str], probs) -> dict:
    """{column: [quantiles]} exactly, for any table size (NULL, NaN and infinities left out)."""
    if not cols:
        return {}
    x = [F.col(f"`{c}`").cast("double") for c in cols]
    wide = df.select(*[F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v).alias(c) for c, v in zip(cols, x)])
    row = wide.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(F.col(f"`{c}`")).alias(f"n{i}"), sketches(F.col(f"`{c}`"), probs).alias(f"s{i}"))]).collect()[0]
    sizes = {c: row[f"n{i}"] for i, c in enumerate(cols) if row[f"n{i}"]}
    return column_quantiles(wide, sizes, {c: row[f"s{i}"] for i, c in enumerate(cols)}, probs)[0]


ROWS_PER_BUCKET = 4_000_000
#: Bounds that fit into generated code; more are searched by halving an array of them.
CODE_BOUNDS = 512


def range_buckets(df: DataFrame, col: str, min_buckets: int = 8):
    """Expression giving each row a value-range bucket of ``col``, sized from
    the data: a count, then sketch quantiles, as many as ROWS_PER_BUCKET rows a
    bucket ask for. Bounds are literals, so every branch of a plan and every
    retried task buckets identically. Returns (expr, n_buckets)."""
    n = df.agg(F.count(F.col(col))).first()[0]
    want = max(min_buckets, math.ceil(n / ROWS_PER_BUCKET))
    at = [i / want for i in range(1, want)]
    # the sketches of all tasks are merged in one: no finer than even buckets ask for
    pts = df.agg(F.percentile_approx(F.col(col), at, max(2_000, 20 * want))).first()[0]
    bounds = sorted(set(pts or []))
    if not bounds:
        return F.lit(0), 1
    if len(bounds) < CODE_BOUNDS:
        return bucket_expr(F.col(col), bounds), len(bounds) + 1
    return count_below(F.array(*[F.lit(b) for b in bounds]), F.col(col), len(bounds).bit_length()), len(bounds) + 1
