"""Boosted trees and forests of a series against plain searches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.operators import forecast as K
from salesmart.operators import trees as T


def data(seed=0, n=60, width=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)), 1)          # ties
    return x, 3 * x[:, 0] - 2 * (x[:, 1] > 0.3) + rng.normal(size=n) * 0.2, rng.choice([1.0, 2.0, 4.0], n), np.arange(n) + 24000


def plain_tree(x, r, h, rows, depth, leaf, l1=0.0, l2=0.0):
    """Recursive search over every feature and border; None or (feature, border, left, right), value."""
    def shrink(g):
        return np.sign(g) * max(abs(g) - l1, 0.0)

    def score(own):
        g, w = (r[own]).sum(), h[own].sum()
        return shrink(g) ** 2 / (w + l2) if w + l2 > 0 else 0.0
    value = shrink(r[rows].sum()) / (h[rows].sum() + l2)
    best = None
    if depth > 0:
        for f in range(x.shape[1]):
            own = np.unique(x[:, f])
            for border in (own[1:] + own[:-1]) / 2:
                a, b = rows[x[rows, f] <= border], rows[x[rows, f] > border]
                if len(a) >= leaf and len(b) >= leaf:
                    gain = score(a) + score(b) - score(rows)
                    if gain > 1e-12 * max(r[rows].sum() ** 2 / h[rows].sum(), 1.0) and (best is None or gain > best[0] * (1 + 1e-9)):   # ties: the first
                        best = (gain, f, border, a, b)
    if best is None:
        return value
    return best[1], best[2], plain_tree(x, r, h, best[3], depth - 1, leaf, l1, l2), plain_tree(x, r, h, best[4], depth - 1, leaf, l1, l2)


def plain_walk(tree, x):
    return np.array([_walk_one(tree, row) for row in x])


def _walk_one(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("depth,leaf,l1,l2", [(1, 1, 0.0, 0.0), (3, 1, 2.0, 10.0), (3, 4, 0.0, 1.0), (6, 1, 0.0, 0.0)])
def test_tree_equals_a_search_over_all_borders(depth, leaf, l1, l2):
    x, t, w, _ = data()
    r = (t - np.average(t, weights=w)) * w
    bins = T.Bins(x)
    tree = T.grow(bins(x), bins.size, np.arange(60), np.zeros(60, np.int64), r, w, depth, leaf, l1, l2)
    want = plain_tree(x, r, w, np.arange(60), depth, leaf, l1, l2)
    assert np.allclose(T.walk(tree, bins(x), 0), plain_walk(want, x))


def test_leaves_hold_weighted_means():
    x, t, w, _ = data(3)
    bins = T.Bins(x)
    tree = T.grow(bins(x), bins.size, np.arange(60), np.zeros(60, np.int64), t * w, w, 4, 3)
    out = T.walk(tree, bins(x), 0)
    for v in np.unique(out):
        own = out == v
        assert own.sum() >= 3 and np.isclose(np.average(t[own], weights=w[own]), v)


def test_boosting_of_separable_rows_finds_the_border_and_never_gets_worse():
    x, _, w, months = data(5)
    t = np.where(x[:, 2] > 0.25, 10.0, -10.0)
    for cfg in T.BOOSTING.values():
        full = cfg | {"columns": 1.0}
        out, fit, gain, loss = T.boost(x, t, w, months, x, 9, **full)
        assert len(loss) == cfg["rounds"] and all(b <= a * (1 + 1e-12) + 1e-12 for a, b in loss)
        assert gain[2] > 0.999 * gain.sum() and (np.sign(out) == np.sign(t)).all() and np.allclose(out, fit)


def test_forest_is_the_mean_of_trees_over_its_draws():
    x, t, w, months = data(7, 40, 3)
    out, bag, gain = T.forest(x, t, w, months, x, 11, 60, 3, 2)
    counts = T.bootstrap_counts(11, months, np.arange(60))
    assert 0.9 < counts.mean() < 1.1 and 0.3 < (counts == 0).mean() < 0.44
    want, inside, n = np.zeros(40), np.zeros(40), np.zeros(40)
    centre = np.average(t, weights=w)
    for c in counts:
        rows = np.flatnonzero(c)
        own = centre + plain_walk(plain_tree(x, c * w * (t - centre), c * w, rows, 3, 2), x)
        want += own / 60
        inside[c == 0] += own[c == 0]
        n[c == 0] += 1
    assert np.allclose(out, want) and np.allclose(bag, inside / n) and gain.argmax() == 0


def test_draws_do_not_depend_on_row_order():
    x, t, w, months = data(8)
    p = np.random.default_rng(1).permutation(60)
    for run in (lambda i: T.boost(x[i], t[i], w[i], months[i], x, 3, **T.BOOSTING["boost_200_tight"])[0],
                lambda i: T.forest(x[i], t[i], w[i], months[i], x, 3, 70, 4, 3)[0]):
        assert np.allclose(run(np.arange(60)), run(p))


def test_bins_of_many_values_and_of_one():
    x = np.column_stack([np.arange(1000.0), np.ones(1000)])
    bins = T.Bins(x, 16)
    codes = bins(x)
    assert bins.size <= 16 and codes[:, 1].max() == 0 and np.bincount(codes[:, 0]).max() <= 2 * 1000 / 15
    out, _, gain, _ = T.boost(np.zeros((5, 0)), np.arange(5.0), np.ones(5), np.arange(5), np.zeros((2, 0)), 1, **T.BOOSTING["boost_200_tight"])
    assert np.allclose(out, 2.0) and len(gain) == 0


def frame(spark, groups=("GIFT_LOW", "GIFT_HIGH", "C"), years=range(1999, 2005)):
    rng = np.random.default_rng(2)
    rows = [(g, y, m, float(1000 + 50 * m + 10 * (y - 1999) + rng.normal()), float(m), None if m == 5 else float(950 + 50 * m))
            for g in groups for y in years for m in range(1, 13)]
    rows += [("D", 2004, 1, 5.0, 1.0, None), ("D", 2003, 1, None, 1.0, None)]       # a series of one month, without a target before it
    return spark.createDataFrame(rows, "canonical_group string, report_year int, report_month int, y double, month double, sales_lag_12m double")


def test_fits_by_group_with_masks_and_absent_features(spark):
    folded = K.explode_folds(frame(spark))
    fits = T.fit_trees(folded, ["month", "sales_lag_12m", "nowhere"], ["boost_200_tight", "forest_300_d3"]).collect()
    pred = [r for r in fits if r.part == "pred"]
    names = {r.candidate for r in pred if r.canonical_group == "C"}
    assert names == {f"{m}_{t}" for m in ("boost_200_tight", "forest_300_d3") for t in ("raw", "log1p", "yoy_ratio")}
    assert {r.candidate for r in pred if r.canonical_group == "GIFT_LOW"} == names | {
        f"rw_{m}_{t}" for m in ("boost_200_tight", "forest_300_d3") for t in ("raw", "log1p")}
    assert len(pred) == 12 * 3 * (6 + 10 + 10) and not [r for r in fits if r.canonical_group == "D"]
    # a missing month of last year counts as 1 in the ratio to it, which makes that target wild
    assert all(abs(r.pred / r.y - 1) < 0.6 for r in pred if not r.candidate.endswith("yoy_ratio"))
    used = {}
    for r in fits:
        if r.part == "importance":
            used.setdefault((r.canonical_group, r.fold, r.candidate), {})[r.feature] = r.value
    # on logarithms the tight penalty leaves no split, and no importance
    assert all(abs(sum(v.values()) - 1) < 1e-9 or (c.endswith("boost_200_tight_log1p") and not any(v.values())) for (_, _, c), v in used.items())
    assert {tuple(sorted(v)) for (g, *_), v in used.items() if g == "GIFT_HIGH"} == {("month",)}
    assert {tuple(sorted(v)) for (g, *_), v in used.items() if g == "C"} == {("month", "sales_lag_12m")}
    facts = {(r.canonical_group, r.fold, r.candidate, r.feature): r.value for r in fits if r.part == "fit"}
    assert facts[("C", "val_2003", "boost_200_tight_raw", "rises")] == 0 and facts[("C", "val_2003", "forest_300_d3_raw", "in_range")] == 1
    assert facts[("C", "val_2003", "forest_300_d3_raw", "oob_rmse")] < 300


def test_fits_of_nothing(spark):
    folded = K.explode_folds(frame(spark).limit(0))
    assert T.fit_trees(folded, ["month"], ["boost_hist"]).count() == 0
    assert T.first_split(folded.select(K.SERIES, "fold", F.col("month").alias("x"), "y")).count() == 0
