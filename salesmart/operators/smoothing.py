"""Numeric helpers for one bounded series: Holt-Winters with optimised smoothing
and initial states (K7) and a seasonal decomposition by LOESS (K22).

Both run on the months of one series inside an ``applyInPandas`` group.
"""

from __future__ import annotations

import numpy as np

GRID = [(a, b, g) for a in (0.1, 0.3, 0.5, 0.7, 0.9) for b in (0.01, 0.1, 0.3) for g in (0.05, 0.2, 0.5)]


# --- Holt-Winters ---------------------------------------------------------------------
def _errors(y: np.ndarray, smoothing, period: int) -> tuple[np.ndarray, np.ndarray]:
    """One-step errors of additive Holt-Winters as a linear function of the initial
    states: errors = c + D @ states, where states are the level, the trend and the
    seasonal terms before the first point; and the same for the final states
    (rows: level, trend, seasonal terms; last column: the constant part)."""
    alpha, beta, gamma = smoothing
    k = period + 2
    states = np.zeros((k, k + 1))
    states[np.arange(k), np.arange(k)] = 1.0
    out = np.empty((len(y), k + 1))
    for t in range(len(y)):
        season = 2 + t % period
        e = -(states[0] + states[1] + states[season])
        e[k] += y[t]
        out[t] = e
        states[0] += states[1] + alpha * e
        states[1] += alpha * beta * e
        states[season] += gamma * (1 - alpha) * e
    return out, states


def _least_squares(y: np.ndarray, smoothing, period: int) -> tuple[float, np.ndarray, np.ndarray]:
    """(squared error, best initial states, final states as a function of them)."""
    errors, final = _errors(y, smoothing, period)
    first = -np.linalg.lstsq(errors[:, :-1], errors[:, -1], rcond=1e-12)[0]
    rest = errors[:, -1] + errors[:, :-1] @ first
    return float(rest @ rest), first, final


def nelder_mead(f, start: np.ndarray, low: np.ndarray, high: np.ndarray, step: float = 0.1, rounds: int = 200,
                restarts: int = 8, tol: float = 1e-10) -> tuple[np.ndarray, float]:
    """Least value of ``f`` in a box by the downhill simplex; points are clipped
    to the box, the best point never gets worse.  A simplex that clipping has
    flattened against a side is built anew around its best point."""
    point, value = _simplex(f, start, low, high, step, rounds, tol)
    for _ in range(restarts):
        again, less = _simplex(f, point, low, high, step, rounds, tol)
        point, value, gained = again, less, value - less
        if gained <= 1e-6 * (abs(value) + 1e-300):
            break
    return point, value


def _simplex(f, start, low, high, step, rounds, tol) -> tuple[np.ndarray, float]:
    points = [np.clip(start, low, high)]
    for i in range(len(start)):
        p = points[0].copy()
        p[i] = p[i] + step if p[i] + step <= high[i] else p[i] - step
        points.append(np.clip(p, low, high))
    values = [f(p) for p in points]
    for _ in range(rounds):
        order = np.argsort(values, kind="stable")
        points, values = [points[i] for i in order], [values[i] for i in order]
        if values[-1] - values[0] <= tol * (abs(values[0]) + 1e-300):
            break
        centre, worst = np.mean(points[:-1], axis=0), points[-1]
        moved = np.clip(centre + (centre - worst), low, high)
        v = f(moved)
        if v < values[0]:
            far = np.clip(centre + 2 * (centre - worst), low, high)
            w = f(far)
            points[-1], values[-1] = (far, w) if w < v else (moved, v)
        elif v < values[-2]:
            points[-1], values[-1] = moved, v
        else:
            near = np.clip(centre + 0.5 * ((moved if v < values[-1] else worst) - centre), low, high)
            w = f(near)
            if w < min(v, values[-1]):
                points[-1], values[-1] = near, w
            else:
                points = [points[0]] + [points[0] + 0.5 * (p - points[0]) for p in points[1:]]
                values = [values[0]] + [f(p) for p in points[1:]]
    i = int(np.argmin(values))
    return points[i], values[i]


def holt_winters_fit(y: np.ndarray, period: int = 12) -> tuple[float, np.ndarray, np.ndarray]:
    """(squared error, smoothing, final states): smoothing weights by a bounded
    search from the best grid point, initial states by least squares for each of
    them, as the errors are linear in the states.  Never worse than the grid."""
    scale = float(np.abs(y).max()) or 1.0
    z = y / scale

    def loss(p):
        return _least_squares(z, p, period)[0]
    start = min(GRID, key=loss)
    smoothing, _ = nelder_mead(loss, np.array(start), np.zeros(3), np.ones(3))
    sse, first, final = _least_squares(z, smoothing, period)
    return sse * scale * scale, smoothing, (final[:, :-1] @ first + final[:, -1]) * scale


def holt_winters_forecast(y: np.ndarray, h: int, period: int = 12) -> np.ndarray:
    _, _, states = holt_winters_fit(y, period)
    steps = np.arange(1, h + 1)
    return np.maximum(states[0] + steps * states[1] + states[2 + (len(y) + steps - 1) % period], 0.0)


# --- LOESS ----------------------------------------------------------------------------
def loess(y: np.ndarray, at: np.ndarray, q: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Local lines through (0, y0), (1, y1), ... at the places ``at``: tricube
    weights over the ``q`` nearest points (a wider reach if there are fewer),
    times ``weights``."""
    n = len(y)
    x = np.arange(n, dtype=float)
    d = np.abs(at[:, None] - x)
    reach = np.sort(d, axis=1)[:, min(q, n) - 1] + max(q - n, 0) // 2
    w = np.clip(1 - (d / np.maximum(reach, 1e-9)[:, None]) ** 3, 0, None) ** 3
    w[d <= 0.001 * reach[:, None]] = 1.0
    if weights is not None:
        w = w * weights
    total = w.sum(1)
    w = np.divide(w, total[:, None], out=np.full_like(w, 1.0 / n), where=total[:, None] > 0)
    mx = w @ x
    spread = w @ (x * x) - mx * mx
    slope = np.divide((w * (x - mx[:, None])) @ y, spread, out=np.zeros(len(at)), where=spread > 1e-6 * (n - 1) ** 2 + 1e-12)
    return w @ y + slope * (at - mx)


def _odd(v: float) -> int:
    v = int(np.ceil(v))
    return v + 1 - v % 2


def _means(v: np.ndarray, k: int) -> np.ndarray:
    return np.convolve(v, np.full(k, 1.0 / k), "valid")


def stl(y: np.ndarray, period: int = 12, seasonal: int = 7, inner: int = 2, outer: int = 15) -> np.ndarray:
    """(trend, seasonal, remainder, robustness weight) of each point.  Inner loop:
    LOESS over each month's own series, less its low pass, then LOESS of the
    rest as the trend; outer loop: bisquare weights of the remainders."""
    n = len(y)
    low, trend_span = _odd(period), _odd(1.5 * period / (1 - 1.5 / seasonal))
    trend, season, robust = np.zeros(n), np.zeros(n), np.ones(n)
    everywhere = np.arange(n, dtype=float)
    for _ in range(outer + 1):
        for _ in range(inner):
            cycle = np.zeros(n + 2 * period)
            for m in range(period):
                own = (y - trend)[m::period]
                cycle[m::period] = loess(own, np.arange(-1.0, len(own) + 1), seasonal, robust[m::period])
            smooth = _means(_means(_means(cycle, period), period), 3)
            season = cycle[period:period + n] - loess(smooth, everywhere, low)
            trend = loess(y - season, everywhere, trend_span, robust)
        rest = np.abs(y - trend - season)
        size = 6 * np.median(rest)
        if size <= 1e-12 * max(float(np.abs(y).max()), 1e-300):
            break                  # most points fit exactly: the weights can tell nothing more
        robust = np.clip(1 - (rest / size) ** 2, 0, None) ** 2
        robust[rest <= 0.001 * size] = 1.0
        robust[rest >= 0.999 * size] = 0.0
    return np.stack([trend, season, y - trend - season, robust], 1)
