"""Small numeric optimisers for functions of one or two variables, made for use within tasks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_GOLD = (3 - 5**0.5) / 2


def minimise_interval(f: Callable[[float], float], a: float, b: float, tolerance: float = 1e-10, steps: int = 200) -> tuple[float, float]:
    """(argument, value) of a minimum within [a, b]: parabolas through the three best points, golden section otherwise."""
    x = w = v = a + _GOLD * (b - a)
    fx = fw = fv = f(x)
    d = e = 0.0
    for _ in range(steps):
        middle, small = (a + b) / 2, tolerance * abs(x) + 1e-14
        if abs(x - middle) <= 2 * small - (b - a) / 2:
            break
        p = q = r = 0.0
        if abs(e) > small:
            r, q = (x - w) * (fx - fv), (x - v) * (fx - fw)
            p, q = (x - v) * q - (x - w) * r, 2 * (q - r)
            p, q = (-p, q) if q > 0 else (p, -q)
        if q and abs(p) < abs(q * e / 2) and q * (a - x) < p < q * (b - x):
            e, d = d, p / q
        else:
            e = (b if x < middle else a) - x
            d = _GOLD * e
        u = x + (d if abs(d) >= small else small if d > 0 else -small)
        fu = f(u)
        if fu <= fx:
            a, b = (x, b) if u >= x else (a, x)
            v, fv, w, fw, x, fx = w, fw, x, fx, u, fu
        else:
            a, b = (u, b) if u < x else (a, u)
            if fu <= fw or w == x:
                v, fv, w, fw = w, fw, u, fu
            elif fu <= fv or v in (x, w):
                v, fv = u, fu
    return x, fx


def minimise_box(f: Callable[[np.ndarray], float], starts: np.ndarray, low: np.ndarray, high: np.ndarray, rounds: int = 400, tolerance: float = 1e-10) -> tuple[np.ndarray, float]:
    """Best of several runs of a simplex search kept inside a box.

    A simplex can fall flat on a wall of the box, so the best point starts new ones until they gain nothing.
    """
    best = min((_simplex(f, s, low, high, rounds, tolerance) for s in starts), key=lambda b: b[1])
    for _ in range(20):
        new = _simplex(f, best[0], low, high, rounds, tolerance)
        if not new[1] < best[1] - tolerance * (abs(best[1]) + tolerance):
            break
        best = new
    return best


def _simplex(f: Callable[[np.ndarray], float], start: np.ndarray, low: np.ndarray, high: np.ndarray, rounds: int, tolerance: float) -> tuple[np.ndarray, float]:
    """One run: reflect the worst point, stretch or shorten the step, or shrink all points to the best one."""
    keep = lambda p: np.clip(p, low, high)
    step = np.maximum(0.1 * np.abs(start), 0.02 * (high - low))
    points = [keep(start)]
    for i in range(len(low)):
        p = points[0].copy()
        p[i] += step[i] if p[i] + step[i] <= high[i] else -step[i]
        points.append(keep(p))
    values = [f(p) for p in points]
    for _ in range(rounds):
        order = np.argsort(values, kind="stable")
        points, values = [points[i] for i in order], [values[i] for i in order]
        near = np.max(np.abs(points[-1] - points[0])) <= 1e-9 * (1 + np.max(np.abs(points[0])))
        if near and abs(values[-1] - values[0]) <= tolerance * (abs(values[0]) + tolerance):
            break
        centre, worst = np.mean(points[:-1], axis=0), points[-1]
        p = keep(2 * centre - worst)
        v = f(p)
        if v < values[0]:
            far = keep(3 * centre - 2 * worst)
            fv = f(far)
            p, v = (far, fv) if fv < v else (p, v)
        elif v >= values[-2]:
            p = keep((centre + (p if v < values[-1] else worst)) / 2)
            v, least = f(p), min(v, values[-1])
            if v >= least:
                points = [points[0], *(keep((points[0] + x) / 2) for x in points[1:])]
                values = [values[0], *(f(x) for x in points[1:])]
                continue
        points[-1], values[-1] = p, v
    i = int(np.argmin(values))
    return points[i], values[i]
