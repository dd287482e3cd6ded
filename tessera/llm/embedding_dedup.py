"""Embedding near-dedup over an inverted multi-index.

Vectors of equal labels are linked if their cosine reaches ``least``.

1. Classes. Equal vectors of a label are one class with its size and smallest
   id, found by digest; copies never meet, however many there are.
2. Codebooks. A fixed rotation spreads every direction over both halves of a
   vector. Each half has a codebook of its own, fitted on at most
   ``SAMPLE_ROWS`` classes (the least digests); the two codes of a vector name
   its cell in the product grid. Every class is indexed.
3. Traversal. In one half the distance of a vector to the border of another
   code's region is a lower bound for moving there, and the squares of both
   halves add up. The cells of the grid are visited in ascending order of that
   sum (multi-sequence: two sorted lists) up to a bound. The bound is fitted
   on the sample: partners are drawn at exactly the least cosine, and it is the
   smallest for which ``RECALL`` of them are found from either side. With the
   squared distance at that cosine as the bound the search would be exact.
4. Verification. A cell is cut into tiles of at most about ``TILE_ROWS`` indexed
   and ``TILE_PROBES`` visiting rows (by its counts, so a cell that holds a
   third of all rows is many tasks), and each tile computes all its cosines in
   double precision. A pair that both sides find counts in the smaller cell
   alone. Tiles return sums of links and a spanning forest, never all pairs.
5. Components of the forest give each class its smallest id.

Edge cases: a vector that is null, empty, zero or holds a null or non-finite
component, or whose label is null, links with nothing and is kept; vectors of
different length do not link (the index pads or cuts to the commonest length,
verification never); a null id counts as larger than all others, its component
is null if it has no other, and it is kept then only; repeated rows are copies
and each counts as a link of the others; only the three named columns are
read, so names cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, discard, lookup, table, written
from tessera.llm.components import components

LEAST = 0.98
RECALL = 0.999
#: Classes that the codebooks and the bound are fitted on: these at most, and SAMPLE_BYTES of doubles.
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 64 << 20
#: Classes a cell of the grid is meant to have, and the most codes of a half.
CELL_ROWS = 128
MAX_CODES = 1024
TILE_ROWS = 4096
TILE_PROBES = 1 << 16
_STEP = 512
_SEED = 42


def _codebook(sample: np.ndarray, codes: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(_SEED)
    centres = sample[rng.permutation(len(sample))[:codes]].copy()
    for _ in range(rounds):
        code = _squares(sample, centres).argmin(1)
        size = np.bincount(code, minlength=len(centres))
        for j in range(sample.shape[1]):
            total = np.bincount(code, sample[:, j], len(centres))
            centres[:, j] = np.where(size > 0, total / np.maximum(size, 1), centres[:, j])
    return centres


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x ** 2).sum(1)[:, None] + (centres ** 2).sum(1) - 2 * x @ centres.T


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square leaves the range of doubles."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x ** 2).sum(1, keepdims=True))


@dataclass
class Index:
    """Rotation, the codebooks of both halves and the bound of the traversal."""

    rotation: np.ndarray
    books: tuple[np.ndarray, np.ndarray]
    bound: float = 0.0

    @classmethod
    def fitted(cls, sample: np.ndarray, classes: int, least: float = LEAST, recall: float = RECALL) -> Index:
        rng = np.random.default_rng(_SEED)
        n, d = sample.shape
        rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
        x = sample @ rotation
        codes = int(min(MAX_CODES, max(1, n // 8), max(1, round((classes / CELL_ROWS) ** 0.5))))
        index = cls(rotation, (_codebook(x[:, :d // 2], codes), _codebook(x[:, d // 2:], codes)))
        # partners at exactly the least cosine, in directions drawn at random
        away = rng.standard_normal(x.shape)
        away -= (away * x).sum(1, keepdims=True) * x
        away /= np.maximum(np.sqrt((away ** 2).sum(1, keepdims=True)), 1e-300)
        y = least * x + np.sqrt(max(0.0, 1 - least ** 2)) * away
        found = []
        for i in range(0, n, _STEP):
            (a1, a2), home_a = index._margins(x[i:i + _STEP])
            (b1, b2), home_b = index._margins(y[i:i + _STEP])
            row = np.arange(len(a1))
            found.append(np.minimum(a1[row, home_b[0]] + a2[row, home_b[1]], b1[row, home_a[0]] + b2[row, home_a[1]]))
        index.bound = float(np.quantile(np.concatenate(found), recall, method="higher"))
        return index

    def _margins(self, x: np.ndarray):
        """By half: squared distances of rotated ``x`` to the regions of all codes, and the own code."""
        margins, homes, half = [], [], self.books[0].shape[1]
        for part, book in ((x[:, :half], self.books[0]), (x[:, half:], self.books[1])):
            squares = _squares(part, book)
            home = squares.argmin(1)
            apart = np.sqrt(np.maximum(_squares(book, book), 1e-300))
            m = (squares - squares[np.arange(len(x)), home][:, None]) / (2 * apart[home])
            m[np.arange(len(x)), home] = 0
            margins.append(np.maximum(m, 0) ** 2)
            homes.append(home)
        return margins, homes

    def visits(self, vectors: np.ndarray):
        """(row, cell) of every cell to visit, by row and then in the order of the traversal; the own cell is first."""
        d, codes = len(self.rotation), len(self.books[0])
        x = np.zeros((len(vectors), d))
        x[:, :min(d, vectors.shape[1])] = vectors[:, :d]
        rows, cells = [], []
        for i in range(0, len(x), _STEP):
            (m1, m2), (h1, h2) = self._margins(x[i:i + _STEP] @ self.rotation)
            r1, c1 = np.nonzero(m1 <= self.bound)
            r2, c2 = np.nonzero(m2 <= self.bound)
            n2 = np.bincount(r2, minlength=len(m1))
            begin = np.cumsum(n2) - n2
            # every code of the first half with every one of the second, row by row
            take = np.repeat(np.arange(len(r1)), n2[r1])
            within = np.arange(len(take)) - np.repeat(np.cumsum(n2[r1]) - n2[r1], n2[r1])
            row, a, b = r1[take], c1[take], c2[begin[r1[take]] + within]
            total = m1[row, a] + m2[row, b]
            near = total <= self.bound
            row, a, b, total = row[near], a[near], b[near], total[near]
            own = (a == h1[row]) & (b == h2[row])
            order = np.lexsort((total, ~own, row))
            rows.append(row[order] + i)
            cells.append(a[order] * codes + b[order])
        return np.concatenate(rows), np.concatenate(cells)


def _vectors(column: pa.Array):
    """(rows, matrix) for each length of vector in an Arrow list column without nulls."""
    lengths = np.asarray(column.value_lengths())
    begins = np.cumsum(lengths) - lengths
    flat = np.asarray(column.flatten()).astype(np.float64)
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[begins[rows][:, None] + np.arange(d)]


def _assigned(index: Index):
    """Classes with the cells that each visits, its own first."""
    def run(batches):
        for batch in batches:
            cells: list = [None] * batch.num_rows
            for rows, x in _vectors(batch.column("e")):
                row, cell = index.visits(unit(x))
                cuts = np.searchsorted(row, np.arange(len(rows) + 1))
                for k, r in enumerate(rows):
                    cells[r] = cell[cuts[k]:cuts[k + 1]].astype(np.int32)
            columns = [batch.column(c) for c in ("node", "key", "label", "id", "n", "e")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cells, pa.list_(pa.int32()))],
                                             names=["node", "key", "label", "id", "n", "e", "cells"])
    return run


class _Forest:
    """Union-find over the indexed rows of a tile; only unions that join two trees are told."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, a: np.ndarray, b: np.ndarray):
        for i, j in zip(a.tolist(), b.tolist()):
            i, j = self.find(i), self.find(j)
            if i != j:
                self.up[i] = j
                yield i, j


class _Tile:
    """Indexed rows of one tile, held; visiting rows stream past them."""

    def __init__(self, rows: dict, cell: int, first: bool, least: float):
        self.x, self.node, self.n, self.cell, self.least = unit(rows["e"]), rows["node"], rows["n"], cell, least
        counts = np.array([len(c) for c in rows["cells"]])
        back = np.concatenate(rows["cells"]).astype(np.int64) if len(counts) else np.empty(0, np.int64)
        self.width = 1 + int(max(back.max(initial=0), cell))
        self.back = np.sort(np.repeat(np.arange(len(counts)), counts) * self.width + back)
        self.sums, self.forest = np.zeros(len(self.n), np.int64), _Forest(len(self.n))
        self.edges: list[tuple[int, int]] = []
        self.visitors: list[tuple[int, int]] = []
        if first:
            self._own()

    def _own(self):
        for i in range(0, len(self.x), _STEP):
            a, b = np.nonzero(self.x[i:i + _STEP] @ self.x[i:].T >= self.least)
            a, b = a[b > a] + i, b[b > a] + i
            np.add.at(self.sums, a, self.n[b])
            np.add.at(self.sums, b, self.n[a])
            self.edges += [(int(self.node[p]), int(self.node[q])) for p, q in self.forest.join(a, b)]

    def visit(self, rows: dict):
        home = np.array([c[0] for c in rows["cells"]], np.int64)
        x = unit(rows["e"])
        for i in range(0, len(x), _STEP):
            a, b = np.nonzero(x[i:i + _STEP] @ self.x.T >= self.least)
            a += i
            # found from the other side too, there if that cell is the smaller one; in the own cell from one side only
            there = self._has(b, home[a])
            own = (home[a] == self.cell) | ~there | (self.cell < home[a])
            a, b = a[own], b[own]
            if not len(a):
                continue
            np.add.at(self.sums, b, rows["n"][a])
            row, lead = np.unique(a, return_index=True)
            total = np.add.reduceat(self.n[b], lead)
            self.visitors += list(zip(rows["node"][row].tolist(), total.tolist()))
            self.edges += list(zip(rows["node"][row].tolist(), self.node[b[lead]].tolist()))
            first = np.repeat(b[lead], np.diff(np.r_[lead, len(a)]))
            both = np.unique(first * len(self.n) + b)
            self.edges += [(int(self.node[p]), int(self.node[q])) for p, q in
                           self.forest.join(both // len(self.n), both % len(self.n))]

    def _has(self, row: np.ndarray, cell: np.ndarray) -> np.ndarray:
        code = row * self.width + cell
        at = np.minimum(np.searchsorted(self.back, code), max(0, len(self.back) - 1))
        return (cell < self.width) & (self.back[at] == code)

    def told(self):
        """(node, other node or null, links) rows so far, which are then forgotten."""
        hit = np.flatnonzero(self.sums)
        rows = [(u, None, n) for u, n in self.visitors] + [(u, v, 0) for u, v in self.edges]
        rows += list(zip(self.node[hit].tolist(), [None] * len(hit), self.sums[hit].tolist()))
        self.sums[:], self.edges, self.visitors = 0, [], []
        return rows


def _verified(least: float):
    """Rows sorted by tile, indexed ones first, to sums of links and a spanning forest."""
    keys = ["label", "dim", "cell", "block", "slice", "visitor"]

    def batch(rows):
        u, v, n = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(n, pa.int64())],
                                          names=["u", "v", "n"])

    def run(batches):
        tile, tile_key, held = None, None, []
        for b in batches:
            if not b.num_rows:
                continue
            key = list(zip(*(b.column(k).to_pylist() for k in keys)))
            cuts = [i for i in range(1, len(key)) if key[i] != key[i - 1]]
            for i, j in zip([0, *cuts], [*cuts, len(key)]):
                part, k = b.slice(i, j - i), key[i]
                rows = {"node": part.column("node").to_numpy(), "n": part.column("n").to_numpy(),
                        "cells": [np.asarray(c.values) for c in part.column("cells")],
                        "e": next(iter(_vectors(part.column("e"))))[1]}
                if k[:-1] != tile_key:
                    if held:  # indexed rows that nothing visits
                        yield batch(_Tile(_together(held), tile_key[2], tile_key[4] == 0, least).told())
                    elif tile:
                        yield batch(tile.told())
                    tile, tile_key, held = None, k[:-1], []
                if not k[-1]:
                    held.append(rows)
                    continue
                if tile is None:
                    if not held:
                        continue
                    tile, held = _Tile(_together(held), tile_key[2], tile_key[4] == 0, least), []
                tile.visit(rows)
                if len(tile.edges) > 1 << 16:
                    yield batch(tile.told())
        if held:
            yield batch(_Tile(_together(held), tile_key[2], tile_key[4] == 0, least).told())
        elif tile:
            yield batch(tile.told())
    return run


def _together(parts: list[dict]) -> dict:
    return {k: sum((p[k] for p in parts), []) if k == "cells" else np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _tiles(assigned: DataFrame) -> DataFrame:
    """Every class as an indexed row of its cell's tiles, and as a visitor of those that it visits."""
    d = assigned.select("node", "label", F.size("e").alias("dim"), "n", "e", "cells", F.posexplode("cells").alias("rank", "cell"))
    own = F.col("rank") == 0
    counts = d.groupBy("label", "dim", "cell").agg(
        F.count(F.when(own, 1)).alias("m"), F.count(F.lit(1)).alias("p")).filter("m > 0")  # empty cells answer nobody
    counts = counts.select(F.col("label").alias("__l"), F.col("dim").alias("__d"), F.col("cell").alias("__c"),
                           F.ceil(F.col("m") / TILE_ROWS).cast("int").alias("blocks"),
                           F.ceil(F.col("p") / TILE_PROBES).cast("int").alias("slices"))
    if counts.count() <= BROADCAST_ROWS // 4:
        counts = F.broadcast(counts)
    d = d.join(counts, (F.col("label") == F.col("__l")) & (F.col("dim") == F.col("__d")) & (F.col("cell") == F.col("__c")))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("slices")).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    tile = lambda b, s, v: F.struct(b.alias("block"), s.alias("slice"), F.lit(v).alias("visitor"))
    indexed = F.transform(every("slices"), lambda s: tile(block, s, 1 == 0))
    visiting = F.transform(F.filter(every("blocks"), lambda b: ~own | (b > block)), lambda b: tile(b, part, 1 == 1))
    t = d.withColumn("t", F.explode(F.when(own, F.concat(indexed, visiting)).otherwise(visiting)))
    t = t.select("label", "dim", "cell", "t.block", "t.slice", "t.visitor", "node", "n", "e", "cells")
    keys = ["label", "dim", "cell", "block", "slice"]
    return t.repartition(*keys).sortWithinPartitions(*keys, "visitor")


def _key(e: Column, label: Column) -> Column:
    """Digest of a label and a vector that can link; null for others."""
    good = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = good & F.exists(e, lambda x: x != 0)
    name = label.cast("string")
    return F.when(good & label.isNotNull(), F.unhex(F.sha2(F.concat(
        F.octet_length(name), F.lit(":"), name, e.cast("string")).cast("binary"), 256)))


def _sample(classes: DataFrame) -> tuple[np.ndarray, int]:
    """Unit vectors of the classes with the least digests, cut or padded to the commonest length; how many classes there are."""
    sizes = classes.groupBy(F.size("e").alias("d")).agg(F.count(F.lit(1)).alias("c"))
    total, common = sizes.agg(F.sum("c"), F.max(F.struct("c", "d"))).first()
    if not total:
        return np.empty((0, 1)), 0
    d = max(2, common["d"])
    rows = max(2, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * d)))
    vectors = F.slice("e", 1, d).alias("e")
    picked = classes.orderBy("key").limit(rows).select("key", vectors).orderBy("key").collect()
    out = np.zeros((len(picked), d))
    for i, r in enumerate(picked):
        out[i, :len(r["e"])] = r["e"]
    out = out[np.abs(out).max(1) > 0]
    return unit(out) if len(out) else np.ones((1, d)) / d ** 0.5, total


def clustered(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
              least: float = LEAST, recall: float = RECALL) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id."""
    spark = df.sparkSession
    e = F.col(f"`{embedding}`")
    d = df.select(F.col(f"`{vec_id}`").alias("vec_id"), _key(e, F.col(f"`{label}`")).alias("key"),
                  F.col(f"`{label}`").cast("string").alias("label"), e.alias("e"))
    classes = d.filter("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("e").alias("e"))
    # numbered where it is written: every later reader sees the same numbers
    classes, at = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    sample, total = _sample(classes)
    if not total:
        discard(spark, at)
        return d.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    index = Index.fitted(sample, total, least, recall)
    kind = dict(classes.dtypes)
    schema = ", ".join(f"{c} {kind[c]}" for c in ("node", "key", "label", "id", "n", "e")) + ", cells array<int>"
    assigned, at2 = written(classes.select("node", "key", "label", "id", "n", "e").mapInArrow(_assigned(index), schema), "assigned")
    discard(spark, at)
    found, at = written(_tiles(assigned).mapInArrow(_verified(least), "u bigint, v bigint, n bigint"), "found")
    sums = found.filter("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("links"))
    roots, more = components(found.filter("v is not null").select("u", "v"))
    c = assigned.select("node", "key", "id", "n").join(sums, "node", "left").join(roots, "node", "left")
    c = c.withColumn("root", F.coalesce("root", "node"))
    # copies and links: all other classes are their own component
    linked = c.filter("n > 1 or links is not null")
    low = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    linked, _ = written(linked.join(low, "root").select(
        F.col("key").alias("k"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"), "linked")
    discard(spark, at, at2, *more)
    out = lookup(d.select("vec_id", F.col("key").alias("__k")), linked.withColumnRenamed("k", "__k"), "__k", "left", ["vec_id"])
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))


def run(spark, sf_dir: str) -> DataFrame:
    out = clustered(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT a.rid AS a, b.rid AS b FROM g a JOIN g b ON a.label = b.label AND a.rid <> b.rid AND len(a.e) = len(b.e)
      WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.98 END),
r AS (SELECT a AS rid, a AS to_rid FROM p UNION SELECT r.rid, p.b FROM r JOIN p ON p.a = r.to_rid),
c AS (SELECT r.rid, min(v.vec_id) AS component_id FROM r JOIN v ON v.rid = r.to_rid GROUP BY r.rid),
n AS (SELECT a AS rid, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, CASE WHEN n_links IS NULL THEN vec_id ELSE component_id END AS component_id,
       vec_id IS NOT DISTINCT FROM CASE WHEN n_links IS NULL THEN vec_id ELSE component_id END AS kept
FROM v LEFT JOIN c USING (rid) LEFT JOIN n USING (rid)
"""
