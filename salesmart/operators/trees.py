"""Boosted trees and forests of a series.

Every (series, fold, candidate) is one Arrow group: its months are few, so a
whole fit runs inside one task and no boosting round costs a Spark job; Spark
deals the groups to the tasks.  Features are binned by quantiles of the training
rows.  Trees grow level by level: one histogram over (node, feature, bin) gives
the gain of every split of the level, for one boosted tree or for a block of a
forest's trees at once.

Gain and leaf values are those of regularised least squares: with G and H the
sums of residuals and weights and S the residual sum shrunk towards 0 by the L1
penalty, a node scores S^2 / (H + L2) and a leaf predicts S / (H + L2).

Draws (rows, columns, bootstrap counts) are hashes of the series, the candidate,
the row's month and the tree, so they depend on no partitioning or row order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.forecast import SERIES, WEIGHTED_GROUPS, feature_mask, regime_weight

BLOCK = 50        # trees of a forest that grow at once
UNLIMITED = 64    # depth of a tree without a limit: no series has 2^64 months

# The parameters of the candidates
BOOSTING = {
    "boost_300": {"rounds": 300, "rate": 0.05, "depth": 3, "rows": 0.8, "columns": 0.8, "l1": 2.0, "l2": 10.0},
    "boost_200_tight": {"rounds": 200, "rate": 0.03, "depth": 2, "rows": 0.7, "columns": 0.7, "l1": 5.0, "l2": 20.0},
    "boost_600": {"rounds": 600, "rate": 0.03, "depth": 4, "rows": 0.9, "columns": 0.9, "l1": 0.0, "l2": 1.0},
    "boost_hist": {"rounds": 100, "rate": 0.05, "depth": 4, "rows": 1.0, "columns": 1.0, "l1": 0.0, "l2": 0.0, "leaf": 20},
}
FORESTS = {
    "forest_300_d4": {"trees": 300, "depth": 4, "leaf": 3},
    "forest_300_d3": {"trees": 300, "depth": 3, "leaf": 4},
    "forest_500": {"trees": 500, "depth": None, "leaf": 1},
}
# Target modes of each candidate, and those that are fitted with regime weights as well
MODES = {m: ("raw", "log1p", "yoy_ratio") for m in ("boost_300", "boost_200_tight", "forest_300_d4", "forest_300_d3")} | \
    {m: ("raw", "log1p") for m in ("boost_600", "boost_hist", "forest_500")}
WEIGHTED_MODES = {m: ("raw", "log1p") for m in ("boost_300", "boost_200_tight", "forest_300_d4", "forest_300_d3")}

OUT = (f"{SERIES} string, fold string, fold_kind string, candidate string, part string, report_year int, "
       "report_month int, y double, pred double, feature string, value double")


def candidates(names=None, modes=None) -> list[tuple[str, str, str, bool]]:
    """(candidate, model, target mode, regime weights) of the grid, or of some of
    its models and target modes."""
    grid = [(m, mode, w) for m in [*BOOSTING, *FORESTS] if names is None or m in names
            for w, own in ((False, MODES[m]), (True, WEIGHTED_MODES.get(m, ()))) for mode in own
            if modes is None or mode in modes]
    return [(f"{'rw_' if w else ''}{m}_{mode}", m, mode, w) for m, mode, w in grid]


# --- draws --------------------------------------------------------------------------
def _uniform(key: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) by hash of a key and two integers."""
    with np.errstate(over="ignore"):
        h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        h ^= np.uint64(key * 0x165667B19E3779F9 & (1 << 64) - 1)
        for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(mul)
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(11)).astype(np.float64) / (1 << 53)


_POISSON = np.exp(-1.0) * np.cumsum(1.0 / np.concatenate([[1.0], np.cumprod(np.arange(1.0, 20.0))]))


def bootstrap_counts(key: int, rows: np.ndarray, trees: np.ndarray) -> np.ndarray:
    """How often each tree (first axis) draws each row: Poisson counts of mean 1."""
    return np.searchsorted(_POISSON, _uniform(key, rows[None, :], trees[:, None]), side="right")


# --- trees ----------------------------------------------------------------------------
class Bins:
    """Quantile bins of the training rows: a value falls into the bin of the
    first border that is not below it."""

    def __init__(self, x: np.ndarray, most: int = 255):
        self.borders = []
        for column in x.T:
            own = np.unique(column)
            if len(own) > most:
                own = np.unique(np.quantile(column, np.linspace(0, 1, most), method="nearest"))
            self.borders.append((own[1:] + own[:-1]) / 2)
        self.size = max((len(b) for b in self.borders), default=0) + 1

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, c, side="left") for b, c in zip(self.borders, x.T)], 1) if len(self.borders) \
            else np.zeros((len(x), 0), np.int64)


def _shrink(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _score(g: np.ndarray, h: np.ndarray, l1: float, l2: float) -> np.ndarray:
    return np.divide(_shrink(g, l1) ** 2, h + l2, out=np.zeros_like(g), where=h + l2 > 0)


def grow(codes: np.ndarray, bins: int, row: np.ndarray, root: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int,
         leaf: int = 1, l1: float = 0.0, l2: float = 0.0, allowed: np.ndarray | None = None):
    """Trees over the entries (row, root, g, h): an entry is a row of ``codes`` in
    the tree ``root`` with its weighted residual and weight.  Returns the splits
    as arrays (feature, bin, left child; feature -1: a leaf), the leaf values and
    the gain of every split.  ``allowed``: (tree, feature) flags.  ``leaf``: rows
    that a leaf holds at least."""
    trees, width = int(root.max()) + 1, codes.shape[1]
    feature, cut, left, value, gains = (list(np.full(trees, v)) for v in (-1, 0, 0, 0.0, 0.0))
    node = root.copy()
    tree_of = np.arange(trees)
    first = 0                                # nodes of the level are first .. len(feature) - 1
    for level in range(depth + 1):
        n = len(feature) - first
        own = node - first
        live = own >= 0
        tg = np.bincount(own[live], g[live], n)
        th = np.bincount(own[live], h[live], n)
        value[first:] = np.divide(_shrink(tg, l1), th + l2, out=np.zeros(n), where=th + l2 > 0).tolist()
        large = np.flatnonzero(np.bincount(own[live], minlength=n) >= 2 * leaf)     # nodes that a split leaves enough rows
        if level == depth or width == 0 or len(large) == 0:
            break
        slot = np.full(n, -1)
        slot[large] = np.arange(len(large))
        use = np.flatnonzero(live)
        use = use[slot[own[use]] >= 0]
        at = ((slot[own[use]][:, None] * width + np.arange(width)) * bins + codes[row[use]]).ravel()
        shape, cells = (len(large), width, bins), len(large) * width * bins
        gl = np.cumsum(np.bincount(at, np.repeat(g[use], width), cells).reshape(shape), 2)
        hl = np.cumsum(np.bincount(at, np.repeat(h[use], width), cells).reshape(shape), 2)
        cl = np.cumsum(np.bincount(at, minlength=cells).reshape(shape), 2)
        tg, th = tg[large], th[large]
        gain = _score(gl, hl, l1, l2) + _score(tg[:, None, None] - gl, th[:, None, None] - hl, l1, l2) \
            - _score(tg, th, l1, l2)[:, None, None]
        fits = (cl >= leaf) & (cl[:, :1, -1:] - cl >= leaf)
        if allowed is not None:
            fits &= allowed[tree_of[large]][:, :, None]
        gain = np.where(fits, gain, -np.inf).reshape(len(large), -1)
        top = gain.max(1)
        # equal splits differ in their last digits with the order of the sums: the first of them counts
        best = (gain >= (top - 1e-9 * np.abs(top))[:, None]).argmax(1)
        split, f, b, most = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
        split[large] = top > 1e-12 * np.maximum(_score(tg, th, 0.0, 0.0), 1.0)
        f[large], b[large], most[large] = best // bins, best % bins, top
        begin = len(feature)
        child = begin + 2 * (np.cumsum(split) - 1)
        for i in np.flatnonzero(split).tolist():
            feature[first + i], cut[first + i], left[first + i], gains[first + i] = int(f[i]), int(b[i]), int(child[i]), float(most[i])
        grown = int(split.sum())
        for store, empty in ((feature, -1), (cut, 0), (left, 0), (value, 0.0), (gains, 0.0)):
            store.extend([empty] * (2 * grown))
        goes = live.copy()
        goes[live] = split[own[live]]
        right = codes[row[goes], f[own[goes]]] > b[own[goes]]
        node = np.where(goes, 0, -1)
        node[goes] = child[own[goes]] + right
        tree_of = np.repeat(tree_of[split], 2)
        first = begin
        if grown == 0:
            break
    return np.array(feature), np.array(cut), np.array(left), np.array(value), np.array(gains)


def walk(tree, codes: np.ndarray, root: int) -> np.ndarray:
    """The leaf values of rows in the tree that begins at node ``root``."""
    feature, cut, left, value, _ = tree
    at = np.full(len(codes), root)
    while True:
        inner = feature[at] >= 0
        if not inner.any():
            return value[at]
        own = at[inner]
        at[inner] = left[own] + (codes[inner, feature[own]] > cut[own])


def importances(tree, width: int) -> np.ndarray:
    feature, _, _, _, gains = tree
    return np.bincount(feature[feature >= 0], gains[feature >= 0], width) if width else np.zeros(0)


def boost(x: np.ndarray, t: np.ndarray, w: np.ndarray, months: np.ndarray, x_new: np.ndarray, key: int, rounds: int, rate: float,
          depth: int, rows: float, columns: float, l1: float, l2: float, leaf: int = 1):
    """(predictions of new rows, of training rows, importances, loss of each
    round's rows before and after it)."""
    bins = Bins(x)
    codes, new = bins(x), bins(x_new)
    width = x.shape[1]
    base = float(np.average(t, weights=w))
    fit, out = np.full(len(t), base), np.full(len(x_new), base)
    gain, loss = np.zeros(width), []
    take = max(1, round(columns * width))
    for r in range(rounds):
        drawn = np.flatnonzero(_uniform(key, months, np.full(len(t), r)) < rows) if rows < 1 else np.arange(len(t))
        if len(drawn) == 0:
            continue
        allowed = np.zeros((1, width), bool)
        allowed[0, np.argsort(_uniform(key + 1, np.arange(width), np.full(width, r)), kind="stable")[:take]] = True
        residual = (t - fit) * w
        tree = grow(codes, bins.size, drawn, np.zeros(len(drawn), np.int64), residual[drawn], w[drawn], depth, leaf, l1, l2, allowed)
        before = float((w[drawn] * (t - fit)[drawn] ** 2).sum())
        fit += rate * walk(tree, codes, 0)
        out += rate * walk(tree, new, 0)
        loss.append((before, float((w[drawn] * (t - fit)[drawn] ** 2).sum())))
        gain += importances(tree, width)
    return out, fit, gain, loss


def forest(x: np.ndarray, t: np.ndarray, w: np.ndarray, months: np.ndarray, x_new: np.ndarray, key: int, trees: int,
           depth: int | None, leaf: int):
    """(predictions of new rows, out-of-bag predictions of training rows,
    importances).  A tree's rows weigh their bootstrap count times ``w``."""
    bins = Bins(x)
    codes, new = bins(x), bins(x_new)
    total, gain = np.zeros(len(x_new)), np.zeros(x.shape[1])
    bag, bags = np.zeros(len(t)), np.zeros(len(t))
    centre = float(np.average(t, weights=w))       # residuals to the mean: no digits are lost in the sums
    for begin in range(0, trees, BLOCK):
        counts = bootstrap_counts(key, months, np.arange(begin, min(begin + BLOCK, trees)))
        counts[counts.sum(1) == 0] = 1             # a tree that drew no row takes all
        root, row = np.nonzero(counts)
        h = counts[root, row] * w[row]
        tree = grow(codes, bins.size, row, root, h * (t[row] - centre), h, UNLIMITED if depth is None else depth, leaf)
        gain += importances(tree, x.shape[1])
        for i in range(len(counts)):
            total += walk(tree, new, i)
            outside = np.flatnonzero(counts[i] == 0)
            bag[outside] += walk(tree, codes[outside], i)
            bags[outside] += 1
    out_of_bag = centre + np.divide(bag, bags, out=np.full(len(t), np.nan), where=bags > 0)
    return centre + total / trees, out_of_bag, gain


# --- Spark ------------------------------------------------------------------------------
def _fit_group(features: list[str]):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        series, fold, name, model, mode, _ = (k.as_py() for k in key)
        kind = t.column("fold_kind")[0].as_py()
        col = {c: t.column(c).to_numpy(zero_copy_only=False) for c in ("report_year", "report_month", "y", "lag", "w")}
        on = [f for f, m in zip(features, t.column("mask")[0].as_py()) if m]
        x = np.column_stack([t.column(f).to_numpy() for f in on]) if on else np.zeros((t.num_rows, 0))
        order = np.lexsort((col["report_month"], col["report_year"]))
        role = np.array(t.column("role").to_pylist())
        y = col["y"].astype(float)
        train = order[(role[order] == "train") & np.isfinite(y[order])]
        new = order[role[order] == "eval"]
        rows: list[tuple] = []
        if len(train) and len(new):
            lag = np.where(np.isnan(col["lag"].astype(float)), 1.0, col["lag"].astype(float))
            safe = np.where(lag > 0, lag, y[train].mean())
            target = {"raw": lambda i: y[i], "log1p": lambda i: np.log1p(np.maximum(y[i], 0.0)),
                      "yoy_ratio": lambda i: np.log(np.maximum(y[i], 1.0) / safe[i])}[mode](train)
            months = col["report_year"][train].astype(np.int64) * 12 + col["report_month"][train]
            seed = zlib.crc32(f"{series}|{fold}|{name}".encode())
            args = (x[train], target, col["w"][train].astype(float), months, x[new], seed)
            if model in BOOSTING:
                out, _, gain, loss = boost(*args, **BOOSTING[model])
                facts = {"rounds": len(loss), "rises": sum(b > a * (1 + 1e-12) + 1e-12 for a, b in loss)}
            else:
                out, bag, gain = forest(*args, **FORESTS[model])
                seen = np.isfinite(bag)
                facts = {"trees": FORESTS[model]["trees"], "lowest": float(target.min()), "highest": float(target.max()),
                         "oob_rmse": float(np.sqrt(np.mean((bag[seen] - target[seen]) ** 2))) if seen.any() else None,
                         "in_range": float(((out >= target.min() - 1e-9 * abs(target.min()) - 1e-9)
                                            & (out <= target.max() + 1e-9 * abs(target.max()) + 1e-9)).all())}
            pred = {"raw": lambda: out, "log1p": lambda: np.expm1(out), "yoy_ratio": lambda: np.exp(out) * safe[new]}[mode]()
            for i, p in zip(new.tolist(), np.maximum(pred, 0.0).tolist()):
                own = float(y[i]) if np.isfinite(y[i]) else None
                rows.append(("pred", int(col["report_year"][i]), int(col["report_month"][i]), own, p, None, None))
            share = gain / gain.sum() if gain.sum() > 0 else gain
            rows += [("importance", None, None, None, None, f, float(v)) for f, v in zip(on, share)]
            rows += [("fit", None, None, None, None, f, None if v is None else float(v)) for f, v in facts.items()]
        n = len(rows)
        parts = list(zip(*rows)) if rows else [()] * 7
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.string(), pa.float64()]
        return pa.table([pa.array([v] * n, pa.string()) for v in (series, fold, kind, name)] + [pa.array(p, k) for p, k in zip(parts, kinds)],
                        names=[c.split()[0] for c in OUT.split(", ")])
    return run


def fit_trees(folded: DataFrame, features: list[str], names=None, modes=None, mask: Column | None = None) -> DataFrame:
    """Rows of three parts for every (series, fold, candidate): 'pred' (report_year,
    report_month, y, pred), 'importance' (feature, value; they sum to 1 unless no
    tree splits) and 'fit' (facts about the fit in feature, value).  Features that
    the frame lacks or ``mask`` leaves out are not offered to the trees."""
    grid = F.array(*[F.struct(F.lit(c).alias("candidate"), F.lit(m).alias("model"), F.lit(mode).alias("mode"), F.lit(w).alias("weighted"))
                     for c, m, mode, w in candidates(names, modes)])
    mask = feature_mask(features, folded.columns) if mask is None else mask
    own = [(F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in folded.columns else F.lit(0.0)).alias(f) for f in features]
    base = folded.select(SERIES, "fold", "fold_kind", "role", "report_year", "report_month", F.col("y").cast("double").alias("y"),
                         F.col("sales_lag_12m").cast("double").alias("lag"), mask.alias("mask"), regime_weight().alias("regime"),
                         *[c.alias(f"f_{f}") for c, f in zip(own, features)], F.explode(grid).alias("c"))
    base = base.where(~F.col("c.weighted") | F.col(SERIES).isin(*WEIGHTED_GROUPS))
    base = base.select(SERIES, "fold", "fold_kind", "role", "report_year", "report_month", "y", "lag", "mask",
                       F.when(F.col("c.weighted"), F.col("regime")).otherwise(F.lit(1.0)).alias("w"),
                       *[F.col(f"f_{f}").alias(f) for f in features], "c.*")
    keys = [SERIES, "fold", "candidate", "model", "mode", "weighted"]
    tasks = 4 * folded.sparkSession.sparkContext.defaultParallelism    # rows are few, fits are long: deal them widely
    return base.repartition(tasks, *keys).groupBy(*keys).applyInArrow(_fit_group(features), OUT)


def tree_predictions(fits: DataFrame) -> DataFrame:
    return fits.where("part = 'pred'").select(SERIES, "fold", "fold_kind", "report_year", "report_month", "y", "candidate", "pred")


def tree_importances(fits: DataFrame) -> DataFrame:
    """(series, fold, candidate, feature, importance)."""
    return fits.where("part = 'importance'").select(SERIES, "fold", "candidate", "feature", F.col("value").alias("importance"))


def fit_facts(fits: DataFrame) -> DataFrame:
    return fits.where("part = 'fit'").select(SERIES, "fold", "candidate", F.col("feature").alias("fact"), "value")


def first_split(rows: DataFrame, feature: str = "x", target: str = "y") -> DataFrame:
    """(series, fold, border, gain_share): the first split of a tree over one
    feature, and the share of the squared error to the mean that it explains."""
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        x, y = t.column("x").to_numpy()[:, None], t.column("y").to_numpy()
        own = np.isfinite(y)
        x, r = x[own], y[own] - y[own].mean() if own.any() else y[own]
        bins = Bins(x, len(x))
        feature, cut, _, _, gains = grow(bins(x), bins.size, np.arange(len(r)), np.zeros(len(r), np.int64), r, np.ones(len(r)), 1) \
            if len(r) else (np.array([-1]), None, None, None, None)
        found = feature[0] >= 0
        return pa.table([pa.array([key[0].as_py()]), pa.array([key[1].as_py()]),
                         pa.array([float(bins.borders[0][cut[0]]) if found else None], pa.float64()),
                         pa.array([float(gains[0] / (r @ r)) if found else None], pa.float64())],
                        names=[SERIES, "fold", "border", "gain_share"])
    own = rows.select(SERIES, "fold", F.col(feature).cast("double").alias("x"), F.col(target).cast("double").alias("y"))
    return own.groupBy(SERIES, "fold").applyInArrow(run, f"{SERIES} string, fold string, border double, gain_share double")
