"""Random search over linear and boosted models from sufficient statistics.

All trials of all folds are scored together, in a number of passes that does
not depend on how many trials there are:

* Linear and ridge regression: one aggregation of the moments by fold (count,
  sums and products of the centred features and label). Every fit, and its
  held-out R2, follows from sums of these; no fit reads the rows.
* Logistic regression: Newton steps for all (trial, fold) columns at once. A
  pass adds up loss, gradient and Hessian of every column, two small matrix
  products for each batch of rows; the steps are solved on the driver, in as
  many dimensions as there are selected features. L1 penalties are
  solved by coordinate descent on the same quadratic model.
* Boosted trees of two classes: MLlib's trees see of a row only its bin of each
  feature and its label. One pass counts values and one the rows by bins and
  label; the fit of a trial without a fold is then one task over the counts.

What reaches the driver is a few numbers for each fold or column, of boosted
trees the counts, up to MAX_VALUES and MAX_CELL_BYTES. Rows are dealt as the
input is; nothing but sums is shuffled. NULL or non-finite features make the
scores NaN, which the caller counts as failed trials.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PASSES = 60
#: Bins of a feature, MLlib's default.
MAX_BINS = 32
#: Distinct values of the features by fold, and bytes of the rows by bins, up to which
#: boosted trees are fitted from counts.
MAX_VALUES, MAX_CELL_BYTES = 1_000_000, 16 << 20
#: Rows of a cell up to which each is drawn by itself; of more, their number is.
FEW_ROWS = 32
#: Largest relative change of a coefficient at which a fit counts as done.
TOLERANCE = 1e-10


# ---- linear and ridge regression ---------------------------------------------------------

class Moments:
    """Count, sums and products of (features, label) by fold, about a common centre."""

    def __init__(self, centre: np.ndarray, by_fold: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        self.centre, self.by_fold = centre, by_fold

    def train(self, held: int):
        parts = [m for f, m in self.by_fold.items() if f != held]
        return tuple(sum(p[i] for p in parts) for i in range(3))

    def fit(self, alpha: float, held: int | None = None) -> tuple[np.ndarray, float]:
        """(coefficients, intercept) of ridge regression with penalty ``alpha`` on the sum of squares."""
        n, s, p = self.train(held)
        c = p - np.outer(s, s) / n
        a = c[:-1, :-1] + alpha * np.eye(len(s) - 1)
        w = np.linalg.lstsq(a, c[:-1, -1], rcond=None)[0] if alpha == 0 else np.linalg.solve(a, c[:-1, -1])
        mean = self.centre + s / n
        return w, float(mean[-1] - w @ mean[:-1])

    def r2(self, w: np.ndarray, intercept: float, fold: int) -> float:
        """R2 on a fold, from its moments alone."""
        n, s, p = self.by_fold[fold]
        v = np.r_[-w, 1.0]                    # residual = v . (x, y) - intercept
        b = intercept - v @ self.centre       # about the centre
        sse = v @ p @ v - 2 * b * (v @ s) + n * b * b
        sst = p[-1, -1] - s[-1] ** 2 / n
        return float(1 - sse / sst) if sst > 0 else float("nan")


def moments_by_fold(df: DataFrame, features: list[str], label: str = "label", fold: str = "fold") -> Moments:
    """One aggregation by fold, after one for the centre."""
    cols = [F.col(f"`{c}`").cast("double") for c in [*features, label]]
    centre = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    centre = np.array([0.0 if v is None else v for v in centre])
    x = [c - F.lit(float(m)) for c, m in zip(cols, centre)]
    k = len(x)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    # a NULL makes the sums NaN instead of dropping out of some of them
    x = [F.coalesce(c, F.lit(float("nan"))) for c in x]
    rows = df.groupBy(F.col(f"`{fold}`").alias("f")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(x)],
        *[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs]).collect()
    by_fold = {}
    for r in rows:
        p = np.empty((k, k))
        for i, j in pairs:
            p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        by_fold[r["f"]] = float(r["n"]), np.array([r[f"s{i}"] for i in range(k)]), p
    return Moments(centre, by_fold)


def ridge_scores(moments: Moments, alphas: list[float]) -> list[float]:
    """Mean held-out R2 over the folds for each penalty."""
    out = []
    for a in alphas:
        try:
            out.append(float(np.mean([moments.r2(*moments.fit(a, f), f) for f in sorted(moments.by_fold)])))
        except np.linalg.LinAlgError:
            out.append(float("nan"))
    return out


# ---- logistic regression -----------------------------------------------------------------

def _matrix(batch, d: int):
    cols = [np.asarray(batch.column(i).to_numpy(zero_copy_only=False), float) for i in range(d + 1)]
    x = np.column_stack([*cols[:d], np.ones(batch.num_rows)])
    return x, cols[d], np.asarray(batch.column(d + 1).to_numpy(zero_copy_only=False))


def _sums_pass(w: np.ndarray, held: np.ndarray):
    """Batches of rows to (place, value): loss, gradient and upper Hessian of each column, summed over the batches."""
    d = w.shape[1] - 1
    upper = np.triu_indices(d + 1)

    def run(batches):
        total = np.zeros((len(w), 1 + (d + 1) + len(upper[0])))
        for batch in batches:
            x, y, fold = _matrix(batch, d)
            z = x @ w.T
            inside = fold[:, None] != held[None, :]
            loss = np.logaddexp(0, z) - y[:, None] * z
            prob = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            weight = np.where(inside, prob * (1 - prob), 0)
            total[:, 0] += np.where(inside, loss, 0).sum(0)
            total[:, 1:d + 2] += np.where(inside, prob - y[:, None], 0).T @ x
            total[:, d + 2:] += weight.T @ (x[:, upper[0]] * x[:, upper[1]])
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "v"])
    return run


def _hits_pass(w: np.ndarray, held: np.ndarray):
    """Batches of rows to (place, value): right predictions and rows of the fold that each column holds out."""
    d = w.shape[1] - 1

    def run(batches):
        total = np.zeros((len(w), 2))
        for batch in batches:
            x, y, fold = _matrix(batch, d)
            own = fold[:, None] == held[None, :]
            total[:, 0] += (own & ((x @ w.T > 0) == (y[:, None] > 0.5))).sum(0)
            total[:, 1] += own.sum(0)
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "v"])
    return run


def _summed(df: DataFrame, run, shape) -> np.ndarray:
    out = np.zeros(int(np.prod(shape)))
    for r in df.mapInArrow(run, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out.reshape(shape)


def _step(w, grad, hess, l2, l1):
    """Minimum of the quadratic model about ``w`` with penalties ``l2`` (squared, halved) and ``l1`` by coordinate."""
    d = len(w)
    h = hess + np.diag(l2)
    g = grad + l2 * w
    h[np.diag_indices(d)] += 1e-12 * max(1.0, float(np.trace(h)) / d)
    if not l1.any():
        return w - np.linalg.solve(h, g)
    v = w.copy()
    for _ in range(1000):
        before = v.copy()
        for j in range(d):
            r = g[j] + h[j] @ (v - w) - h[j, j] * (v[j] - w[j])
            target = w[j] - r / h[j, j]
            v[j] = np.sign(target) * max(0.0, abs(target) - l1[j] / h[j, j])
        if np.abs(v - before).max() <= 1e-13 * (1 + np.abs(v).max()):
            break
    return v


def logistic_fits(df: DataFrame, features: list[str], columns: list[tuple[float, str, int]], label: str = "label",
                  fold: str = "fold") -> np.ndarray:
    """Coefficients, intercept last, for each (C, penalty, fold held out) of ``columns``; -1 holds out none.

    The objective is C times the summed loss plus half the squares (``l2``) or
    the absolute values (``l1``) of the coefficients; the intercept is free.
    """
    cols = [F.col(f"`{c}`").cast("double") for c in features]
    stats = df.agg(*[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols]).first()
    d = len(features)
    mean = np.array([float("nan") if v is None else v for v in stats[:d]])
    scale = np.array([v if v else 1.0 for v in stats[d:]])
    data = scaled(df, features, mean, scale, label, fold)
    held = np.array([f for _, _, f in columns])
    # penalties of the scaled coefficients, for the summed loss
    l2 = np.array([np.r_[(1 / c if p == "l2" else 0.0) / scale ** 2, 0.0] for c, p, _ in columns])
    l1 = np.array([np.r_[(1 / c if p == "l1" else 0.0) / scale, 0.0] for c, p, _ in columns])
    w, done = np.zeros((len(columns), d + 1)), np.zeros(len(columns), bool)
    best, at, proposal = np.full(len(columns), np.inf), w.copy(), w.copy()
    upper = np.triu_indices(d + 1)
    for _ in range(MAX_PASSES):
        sums = _summed(data, _sums_pass(proposal, held), (len(columns), 1 + (d + 1) + len(upper[0])))
        for k in np.flatnonzero(~done):
            v = proposal[k].copy()
            value = sums[k, 0] + 0.5 * (l2[k] * v * v).sum() + (l1[k] * np.abs(v)).sum()
            if not np.isfinite(value):
                done[k], at[k] = True, np.nan
            elif value <= best[k] + 1e-12 * abs(best[k]) or not np.isfinite(best[k]):
                hess = np.zeros((d + 1, d + 1))
                hess[upper] = sums[k, d + 2:]
                hess = hess + np.triu(hess, 1).T
                best[k], at[k] = value, v
                proposal[k] = _step(v, sums[k, 1:d + 2], hess, l2[k], l1[k])
                done[k] = np.abs(proposal[k] - v).max() <= TOLERANCE * (1 + np.abs(v).max())
                if done[k]:
                    at[k] = proposal[k]
            else:
                proposal[k] = (proposal[k] + at[k]) / 2  # the step was too long
                done[k] = np.abs(proposal[k] - at[k]).max() <= TOLERANCE * (1 + np.abs(at[k]).max())
        if done.all():
            break
    out = at[:, :d] / scale
    return np.column_stack([out, at[:, d] - out @ mean])


def scaled(df: DataFrame, features: list[str], mean, scale, label: str, fold: str) -> DataFrame:
    x = [((F.col(f"`{c}`").cast("double") - F.lit(float(m))) / F.lit(float(s))).alias(f"x{i}")
         for i, (c, m, s) in enumerate(zip(features, mean, scale))]
    return df.select(*x, F.col(f"`{label}`").cast("double").alias("y"), F.col(f"`{fold}`").cast("int").alias("f"))


def logistic_scores(df: DataFrame, features: list[str], trials: list[tuple[float, str]], folds: int, label: str = "label",
                    fold: str = "fold") -> list[float]:
    """Mean held-out accuracy over the folds for each (C, penalty)."""
    columns = [(c, p, f) for c, p in trials for f in range(folds)]
    w = logistic_fits(df, features, columns, label, fold)
    data = scaled(df, features, np.zeros(len(features)), np.ones(len(features)), label, fold)
    hits = _summed(data, _hits_pass(w, np.array([f for _, _, f in columns])), (len(columns), 2))
    share = np.where(np.isfinite(w).all(1) & (hits[:, 1] > 0), hits[:, 0] / np.maximum(hits[:, 1], 1), np.nan)
    return share.reshape(len(trials), folds).mean(1).tolist()


# ---- boosted trees -----------------------------------------------------------------------

def split_points(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MLlib's candidate splits of a feature, from the rows of each value in order.

    Midpoints of all neighbours, or of those where the rows so far are nearest to even shares.
    """
    rows = int(counts.sum())
    bins = min(MAX_BINS, rows)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) >= bins:
        at, target, so_far = [], rows / bins, counts.cumsum()
        for i in range(len(middle)):
            if abs(so_far[i] - target) < abs(so_far[i + 1] - target):
                at.append(i)
                target += rows / bins
        middle = middle[at]
    return middle


def _cells_pass(points: list[list[np.ndarray]]):
    """Batches of rows to rows by bins, for the splits of each held-out fold: in training and held out, by label."""
    d = len(points[0])

    def run(batches):
        for batch in batches:
            x, y, fold = _matrix(batch, d)
            for held, edges in enumerate(points):
                bins = np.column_stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)]).astype(np.uint8)
                cells, at = np.unique(bins, axis=0, return_inverse=True)
                kind = 2 * (fold == held) + (y > 0.5)
                n = np.bincount(4 * at.reshape(-1) + kind, minlength=4 * len(cells)).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cells), held)), pa.array([c.tobytes() for c in cells], pa.binary()),
                     *[pa.array(n[:, i]) for i in range(4)]], names=["held", "cell", "n0", "n1", "n2", "n3"])
    return run


def _counted(df: DataFrame, most: int):
    """The rows of a table as Arrow, None if there are more than ``most``."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.toArrow() if df.count() <= most else None
    finally:
        df.unpersist()


def cells_by_fold(df: DataFrame, features: list[str], folds: int, label: str = "label", fold: str = "fold") -> list | None:
    """(bins, rows) for each held-out fold: distinct bins of the features, rows in training and held out by label 0 and 1.

    None if there are too many values or cells; empty tables if a feature is not finite somewhere, which MLlib does not fit.
    """
    d = len(features)
    data = scaled(df, features, np.zeros(d), np.ones(d), label, fold)
    x = [F.coalesce(f"x{i}", F.lit(float("nan"))).alias(str(i)) for i in range(d)]
    values = _counted(data.select("f", *x).unpivot(["f"], [F.col(f"`{i}`") for i in range(d)], "feature", "x")
                      .groupBy(F.col("feature").cast("int").alias("feature"), "x", "f").agg(F.count(F.lit(1)).alias("n")), MAX_VALUES)
    if values is None:
        return None
    feature, value, own, n = (values.column(i).to_numpy() for i in range(4))
    if not np.isfinite(value).all():
        return [(np.zeros((0, d), np.uint8), np.zeros((0, 4), np.int64))] * folds
    points = []
    for held in range(folds):
        points.append([])
        for i in range(d):
            at = (feature == i) & (own != held)
            distinct, inverse = np.unique(value[at], return_inverse=True)
            points[-1].append(split_points(distinct, np.bincount(inverse, n[at], len(distinct)).astype(np.int64)))
    kinds = ["n0", "n1", "n2", "n3"]
    cells = _counted(data.mapInArrow(_cells_pass(points), "held bigint, cell binary, n0 bigint, n1 bigint, n2 bigint, n3 bigint")
                     .groupBy("held", "cell").agg(*[F.sum(k).alias(k) for k in kinds]), MAX_CELL_BYTES // (d + 40))
    if cells is None:
        return None
    held = cells.column("held").to_numpy()
    bins = np.frombuffer(b"".join(cells.column("cell").to_pylist()), np.uint8).reshape(-1, d)
    rows = np.column_stack([cells.column(k).to_numpy() for k in kinds])
    # in order, so that draws do not depend on how rows were dealt
    order = np.lexsort((*bins.T[::-1], held))
    held, bins, rows = held[order], bins[order], rows[order]
    return [(bins[held == k], rows[held == k]) for k in range(folds)]


def _draws(counts: np.ndarray, share: float, rng):
    """Function that draws how many of the rows of each cell come into a tree, each row with probability ``share``."""
    if share >= 1:
        return lambda: counts
    few, many = np.flatnonzero((counts > 0) & (counts <= FEW_ROWS)), np.flatnonzero(counts > FEW_ROWS)
    starts = np.cumsum(counts[few]) - counts[few]

    def draw():
        out = np.zeros(len(counts))
        if len(few):
            out[few] = np.add.reduceat((rng.random(counts[few].sum()) < share).astype(np.int64), starts)
        out[many] = rng.binomial(counts[many], share)
        return out
    return draw


class _Bins:
    """Cells by the places of their bins in one row of all features' bins."""

    def __init__(self, bins: np.ndarray):
        size = bins.max(0).astype(np.int64) + 1
        ends = size.cumsum()
        self.spans = list(zip(ends - size, ends))
        self.at, self.width = bins + (ends - size), int(ends[-1])
        self.feature = np.repeat(np.arange(len(size)), size)

    def tree(self, n: np.ndarray, s: np.ndarray, q: np.ndarray, depth: int) -> np.ndarray:
        """Value of each cell in a regression tree as MLlib grows it, from rows, sum and sum of squares of the target."""
        value, eps = np.zeros(len(n)), np.finfo(float).eps
        rows, node, m = np.arange(len(n)), np.zeros(len(n), np.int64), 1
        here, each = self.at, np.repeat(np.stack([n, s]), len(self.spans), 1)
        for level in range(depth + 1):
            size, total = np.bincount(node, n[rows], m), np.bincount(node, s[rows], m)
            mean = total / size
            if level == depth:
                value[rows] = mean[node]
                break
            key = (here + node[:, None] * self.width).ravel()
            left = np.stack([np.bincount(key, w, m * self.width).reshape(m, -1) for w in each])
            for a, b in self.spans:
                left[:, :, a:b].cumsum(2, out=left[:, :, a:b])
            right = np.stack([size, total])[:, :, None] - left
            none = (left[0] < 1) | (right[0] < 1)
            for x, y in (left, right):
                np.multiply(y, y, out=y)
                np.divide(y, x, out=y, where=x >= 1)
            gain = np.add(left[1], right[1], out=left[1])
            gain[none] = -np.inf
            best, base = gain.argmax(1), total * mean
            parted = gain[np.arange(m), best] - base > 1e-14 * base
            if level:       # MLlib does not part a child without variance
                parted &= np.abs(np.bincount(node, q[rows], m) - base) >= eps * size
            if not parted.all():
                on, off = np.flatnonzero(parted[node]), np.flatnonzero(~parted[node])
                value[rows[off]] = mean[node[off]]
                each = each.reshape(2, len(rows), -1).take(on, 1).reshape(2, -1)
                rows, node, here = rows[on], node[on], here.take(on, 0)
                if not len(rows):
                    break
            cut = best[node]
            far = here[np.arange(len(rows)), self.feature[cut]] > cut
            node, m = 2 * (parted.cumsum() - 1)[node] + far, 2 * int(parted.sum())
        return value


def boosted_margins(bins: np.ndarray, rows: np.ndarray, trees: int, depth: int, rate: float, share: float, seed: int) -> np.ndarray:
    """Margin of each cell under boosting for the log loss as MLlib does it, trained on ``rows`` of labels 0 and 1.

    The first tree is fitted to labels of -1 and 1, each other one to the
    negative gradient and weighted by ``rate``; each takes a ``share`` of the rows.
    """
    shape, margin, k = _Bins(bins), np.zeros(len(bins)), len(bins)
    draw = _draws(np.r_[rows[:, 0], rows[:, 1]], share, np.random.default_rng(seed))
    for i in range(trees):
        drawn = draw()
        no, yes = drawn[:k], drawn[k:]
        with np.errstate(over="ignore"):
            down, up = (-4 / (1 + np.exp(-2 * margin)), 4 / (1 + np.exp(2 * margin))) if i else (-1.0, 1.0)
        margin += (rate if i else 1.0) * shape.tree(no + yes, no * down + yes * up, no * down ** 2 + yes * up ** 2, depth)
    return margin


def boosted_scores(df: DataFrame, features: list[str], trials: list[tuple[int, int, float, float]], folds: int, seed: int,
                   label: str = "label", fold: str = "fold") -> list[float]:
    """Mean held-out accuracy over the folds for each (trees, depth, rate, share); empty if there are too many cells."""
    tables = cells_by_fold(df, features, folds, label, fold)
    if tables is None:
        return []

    def accuracy(fit):
        trial, held = fit
        bins, rows = tables[held]
        if not rows[:, :2].sum() or not rows[:, 2:].sum():
            return fit, float("nan")
        margin = boosted_margins(bins, rows[:, :2], *trials[trial], seed)
        return fit, float(np.where(margin > 0, rows[:, 3], rows[:, 2]).sum() / rows[:, 2:].sum())

    sc = df.sparkSession.sparkContext
    # the longest first, dealt like cards
    fits = sorted(((t, f) for t in range(len(trials)) for f in range(folds)), key=lambda x: -trials[x[0]][0] * trials[x[0]][1])
    tasks = min(len(fits), 4 * sc.defaultParallelism)
    found = dict(sc.parallelize([x for i in range(tasks) for x in fits[i::tasks]], tasks).map(accuracy).collect())
    return [float(np.mean([found[t, f] for f in range(folds)])) for t in range(len(trials))]
