"""Holt-Winters and the LOESS decomposition against plain versions."""

import numpy as np
import pytest

from salesmart.operators import smoothing as S
from salesmart.operators import stats

SEASON = np.array([5, -3, 2, 8, -6, 1, 0, 4, -2, -7, 3, -5.0])


def series(seed, n=60, noise=1.0):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 100 + 0.5 * t + 3 * SEASON[t % 12] * (1 + 0.01 * t) + rng.normal(size=n) * noise


def grid_error(y, a, b, g):
    """One pass of the recursion from heuristic initial states."""
    mean, trend = y[:12].mean(), (y[12:24].mean() - y[:12].mean()) / 12
    level, season, sse = mean - trend * 6.5, list(y[:12] - (mean + (np.arange(12) - 5.5) * trend)), 0.0
    for t, v in enumerate(y):
        s = season[t % 12]
        sse += (v - level - trend - s) ** 2
        new = a * (v - s) + (1 - a) * (level + trend)
        trend, season[t % 12], level = b * (new - level) + (1 - b) * trend, g * (v - new) + (1 - g) * s, new
    return sse


@pytest.mark.parametrize("seed,noise", [(1, 1.0), (2, 8.0), (3, 0.0), (4, 40.0)])
def test_error_is_never_above_the_grid(seed, noise):
    y = series(seed, noise=noise)
    sse, smoothing, _ = S.holt_winters_fit(y)
    assert sse <= min(grid_error(y, *p) for p in S.GRID) * (1 + 1e-9) + 1e-12
    assert (smoothing >= 0).all() and (smoothing <= 1).all()


def test_errors_are_the_recursion_from_the_fitted_states():
    y, p, states = series(5), (0.3, 0.2, 0.4), np.concatenate([[90.0, 0.7], SEASON])
    errors, final = S._errors(y, p, 12)
    level, trend, season = states[0], states[1], list(states[2:])
    for t, v in enumerate(y):
        s = season[t % 12]
        assert np.isclose(errors[t, :-1] @ states + errors[t, -1], v - level - trend - s)
        new = p[0] * (v - s) + (1 - p[0]) * (level + trend)
        trend, season[t % 12], level = p[1] * (new - level) + (1 - p[1]) * trend, p[2] * (v - new) + (1 - p[2]) * s, new
    assert np.allclose(final[:, :-1] @ states + final[:, -1], [level, trend, *season])


def test_known_continuations_are_exact():
    t = np.arange(60)
    for scale in (1e-3, 1.0, 1e9):
        y = scale * (100 + 0.5 * t + SEASON[t % 12])
        for n in (24, 30, 48):
            assert np.allclose(S.holt_winters_forecast(y[:n], 12), y[n:n + 12], rtol=1e-9)
    assert (S.holt_winters_forecast(np.zeros(30), 5) == 0).all()
    assert (S.holt_winters_forecast(100.0 - 4 * t[:26], 6) == 0).all()      # never below 0


def test_simplex_stays_in_its_box_and_finds_the_least_value():
    p, v = S.nelder_mead(lambda p: (p[0] - 0.3) ** 2 + 3 * (p[1] - 2.0) ** 2, np.array([0.9, 0.1]), np.zeros(2), np.ones(2))
    assert np.allclose(p, [0.3, 1.0], atol=1e-4) and np.isclose(v, 3.0)


def plain_loess(y, x0, q, weights):
    n = len(y)
    d = sorted((abs(i - x0), i) for i in range(n))
    reach = d[min(q, n) - 1][0] + max(q - n, 0) // 2
    w = np.zeros(n)
    for dist, i in d:
        w[i] = weights[i] * (1.0 if dist <= 0.001 * reach else max(1 - (dist / max(reach, 1e-9)) ** 3, 0) ** 3)
    if w.sum() == 0:
        w[:] = 1.0
    x = np.arange(n)
    a = np.column_stack([np.ones(n), x - x0]) * np.sqrt(w)[:, None]
    if np.linalg.matrix_rank(a) < 2:
        return np.average(y, weights=w)
    return np.linalg.lstsq(a, y * np.sqrt(w), rcond=None)[0][0]


@pytest.mark.parametrize("q", [3, 7, 13, 40])
def test_loess_equals_local_least_squares(q):
    rng = np.random.default_rng(q)
    y, w, at = rng.normal(size=25), rng.uniform(0.1, 1, 25), np.arange(-1.0, 26.0)
    assert np.allclose(S.loess(y, at, q, w), [plain_loess(y, a, q, w) for a in at])


def plain_stl(y, period=12, seasonal=7, inner=2, outer=3):
    n, low, span = len(y), period + 1 - period % 2, 23
    trend, robust = np.zeros(n), np.ones(n)
    for _ in range(outer + 1):
        for _ in range(inner):
            cycle = np.zeros(n + 2 * period)
            for m in range(period):
                own = [i for i in range(n) if i % period == m]
                for k in range(-1, len(own) + 1):
                    cycle[(k + 1) * period + m] = plain_loess((y - trend)[own], k, seasonal, robust[own])
            smooth = cycle
            for k in (period, period, 3):
                smooth = np.array([smooth[i:i + k].mean() for i in range(len(smooth) - k + 1)])
            season = np.array([cycle[period + i] - plain_loess(smooth, i, low, np.ones(n)) for i in range(n)])
            trend = np.array([plain_loess(y - season, i, span, robust) for i in range(n)])
        rest = np.abs(y - trend - season)
        u = rest / (6 * np.median(rest))
        robust = np.where(u <= 0.001, 1.0, np.where(u >= 0.999, 0.0, np.clip(1 - u * u, 0, None) ** 2))
    return np.stack([trend, season, y - trend - season, robust], 1)


def test_stl_equals_a_plain_version():
    for y in (series(6, 53), np.where(np.arange(48) == 20, 400.0, series(7, 48))):
        assert np.allclose(S.stl(y, outer=3), plain_stl(y), atol=1e-8)


def test_parts_add_up_and_an_outlier_stays_in_the_remainder():
    t = np.arange(72)
    y = 100 + 0.5 * t + 10 * np.sin(2 * np.pi * t / 12)
    y[30] += 60
    trend, season, rest, robust = S.stl(y).T
    assert np.allclose(trend + season + rest, y) and abs(rest[30] - 60) < 0.1 and robust[30] == 0
    assert np.abs(np.delete(rest, 30)).max() < 0.1 and np.abs(trend - 100 - 0.5 * t).max() < 0.2


def test_short_gapped_and_empty_series(spark):
    rows = [("a", 2000 + i // 12, i % 12 + 1, float(i)) for i in range(30)] + [("b", 2000, m, 1.0) for m in range(1, 13)] \
        + [("c", 2000 + i // 12, i % 12 + 1, None if i == 7 else 3.0) for i in range(30)]
    df = spark.createDataFrame(rows, "canonical_group string, report_year int, report_month int, sales_result double")
    got = stats.loess_parts(df).collect()
    assert {(g, sum(r.canonical_group == g for r in got)) for g in "abc"} == {("a", 30), ("b", 0), ("c", 29)}
    assert all(abs(r.trend + r.seasonal + r.remainder - r.value) < 1e-9 for r in got)
    assert stats.loess_parts(df.limit(0)).count() == 0
