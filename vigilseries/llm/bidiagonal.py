"""Right singular vectors of a small square matrix: Householder bidiagonalisation, dqds, twisted factorisations."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
CLOSE = 1e-3
SWEEPS = 200


def right_singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, and the right singular vectors as columns in the same order."""
    n = r.shape[1]
    norm = float(np.abs(r).max(initial=0.0))
    if not norm:
        return np.zeros(n), np.eye(n)
    square = np.zeros((max(n, len(r)), n))
    square[: len(r)] = r / norm
    a, b, right = bidiagonalise(square)
    size = max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    # Entries of rounding size: couplings are cut, pivots kept from 0.
    b = np.where(np.abs(b) <= EPS * size, 0.0, b)
    a = np.where(np.abs(a) <= EPS * size, EPS * size, a)
    values, vectors = np.zeros(n), np.zeros((n, n))
    edges = [0, *(np.flatnonzero(b == 0) + 1), n]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        values[lo:hi] = np.sort(dqds(a[lo:hi], b[lo: hi - 1]))[::-1]
        vectors[lo:hi, lo:hi] = twisted_vectors(a[lo:hi], b[lo: hi - 1], values[lo:hi])
    order = np.argsort(-values, kind="stable")
    return values[order] * norm * norm, right @ vectors[:, order]


def bidiagonalise(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and right factor: ``m = left @ bidiagonal @ right.T`` by Householder reflections."""
    m, n = m.copy(), m.shape[1]
    right = np.eye(n)
    for k in range(n):
        v, beta = _reflector(m[k:, k])
        m[k:, k:] -= beta * np.outer(v, v @ m[k:, k:])
        if k + 2 < n:
            v, beta = _reflector(m[k, k + 1:])
            m[k:, k + 1:] -= beta * np.outer(m[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= beta * np.outer(right[:, k + 1:] @ v, v)
    return np.diagonal(m)[:n].copy(), np.diagonal(m, 1)[: n - 1].copy(), right


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """``v`` and ``beta`` with ``x - beta * v * (v @ x)`` zero but for its first entry."""
    v, tail = x.copy(), float(x[1:] @ x[1:])
    if not tail:
        return v, 0.0
    v[0] += np.copysign(np.sqrt(float(x[0]) ** 2 + tail), x[0])
    return v, 2.0 / (float(v[0]) ** 2 + tail)


def dqds(a: np.ndarray, b: np.ndarray) -> list[float]:
    """Squares of the singular values of an upper bidiagonal matrix, each to high relative accuracy.

    The differential qd sweep without a shift also gives the diagonal of the
    inverse of B B', so 1 over its sum is a lower bound of the smallest value
    left: a shift by it keeps every term positive and converges quadratically.
    """
    out, todo = [], [([float(x) for x in a * a], [float(x) for x in b * b], 0.0)]
    while todo:
        q, e, shift = todo.pop()
        for _ in range(SWEEPS * (len(q) + 1)):
            while len(q) > 1 and _small(e[-1], shift, q[-1]):
                out.append(q.pop() + shift)
                e.pop()
            if len(q) <= 1:
                break
            cut = next((i for i in range(len(e) - 1) if _small(e[i], shift, min(q[i], q[i + 1]))), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], shift))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if 1.5 * q[0] < q[-1]:
                q.reverse()
                e.reverse()
            q, e, bound = _sweep(q, e, 0.0)
            while bound > 0:
                moved = _sweep(q, e, bound)
                if moved:
                    q, e, shift = moved[0], moved[1], shift + bound
                    break
                bound *= 0.5
        else:
            raise ArithmeticError("the qd sweeps did not converge")
        out += [x + shift for x in q]
    return out


def _small(e: float, shift: float, q: float) -> bool:
    return e <= (4 * EPS) ** 2 * (shift + q)


def _sweep(q: list[float], e: list[float], shift: float):
    """One differential qd transform; a lower bound of the values if ``shift`` is 0; None if the shift was too large."""
    new_q, new_e, inverse, d = [], [], 0.0, q[0] - shift
    for i in range(len(e)):
        if d < 0 or (shift and not d):
            return None
        inverse += 1.0 / d if d else np.inf
        top = d + e[i]
        t = q[i + 1] / top if top else 0.0
        new_q.append(top)
        new_e.append(e[i] * t)
        d = d * t - shift
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, 1.0 / (inverse + (1.0 / d if d else np.inf))


def twisted_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors of an unreduced upper bidiagonal matrix, as columns, for falling squared singular values.

    A vector is read off the twisted factorisation of B'B - value with the
    smallest twist. Values within a thousandth of each other get vectors from
    further twists, made orthogonal to those before.
    """
    n = len(a)
    out = np.zeros((n, n))
    start = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLOSE * values[k - 1]:
            start = k
        best, most = None, -1.0
        for z in _twists(a, b, float(value)):
            z = z / np.linalg.norm(z)
            for _ in range(2):
                z = z - out[:, start:k] @ (out[:, start:k].T @ z)
            left = float(np.linalg.norm(z))
            if left > most:
                best, most = z / left if left else z, left
            if left > 0.5:
                break
        out[:, k] = best
    if np.abs(out.T @ out - np.eye(n)).max() > 1e-10:
        q, r = np.linalg.qr(out)
        out = q * np.sign(np.diagonal(r))
    return out


def _twists(a: np.ndarray, b: np.ndarray, value: float):
    """Solutions of (B'B - value) z = twist, the smallest twists first; the first one after a Rayleigh correction."""
    upper, lower, gamma = _factors(a, b, value)
    at = int(np.abs(gamma).argmin())
    z = _solve(upper, lower, at)
    correction = gamma[at] / float(z @ z)
    if abs(correction) < 1e-8 * value:
        upper, lower, gamma = _factors(a, b, value + correction)
        at = int(np.abs(gamma).argmin())
        z = _solve(upper, lower, at)
    yield z
    for other in np.argsort(np.abs(gamma), kind="stable"):
        if other != at:
            yield _solve(upper, lower, int(other))


def _factors(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers of the stationary (top down) and progressive (bottom up) transforms, and the twists."""
    n, tiny = len(a), EPS * EPS * max(value, EPS * EPS)
    q, e, both = a * a, b * b, a[: n - 1] * b
    down, up, s, p = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0)), np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        d = s[i] + q[i] or tiny
        down[i] = both[i] / d
        s[i + 1] = e[i] * (s[i] / d) - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        d = e[i] + p[i + 1] or tiny
        up[i] = both[i] / d
        p[i] = p[i + 1] * (q[i] / d) - value
    return down, up, s + p + value


def _solve(down: np.ndarray, up: np.ndarray, at: int) -> np.ndarray:
    n = len(down) + 1
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -up[i] * z[i]
        if abs(z[i + 1]) > 1e150:
            z /= abs(z[i + 1])
    return z
