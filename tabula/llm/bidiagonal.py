"""Singular values and right singular vectors of a small square matrix on the driver:
Householder bidiagonalisation, dqds for the values, twisted factorisations for the vectors.

Sizes are the dimension of an embedding, never a number of rows."""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(float).eps)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal and superdiagonal of B in ``r = U B V'`` and the reflectors that make V:
    pairs (first index, unit vector)."""
    a = np.array(r, float)
    d = len(a)
    right: list[tuple[int, np.ndarray]] = []

    def reflector(x: np.ndarray) -> np.ndarray | None:
        scale = np.abs(x).max(initial=0.0)
        if len(x) < 2 or not scale or not np.abs(x[1:]).max():
            return None
        v = x / scale
        v[0] += math.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        w = reflector(a[k, k + 1:])
        if w is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
            right.append((k + 1, w))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def back_transform(right: list[tuple[int, np.ndarray]], z: np.ndarray) -> np.ndarray:
    """V z for the V of ``bidiagonalise``; one column of ``z`` a vector."""
    out = np.array(z, float)
    for first, w in reversed(right):
        out[first:] -= 2 * np.outer(w, w @ out[first:])
    return out


def _shifted(q: list[float], e: list[float], s: float) -> tuple[list[float], list[float]] | None:
    """One dqds sweep; None where the shift passed the least value."""
    qn, en = [], []
    d = q[0] - s
    for i in range(len(e)):
        if d < 0:
            return None
        top = d + e[i]
        if top == 0.0:
            return None
        t = q[i + 1] / top
        qn.append(top)
        en.append(e[i] * t)
        d = d * t - s
    if d < 0 or not math.isfinite(d):
        return None
    return [*qn, d], en


def _bounds(q: list[float], e: list[float]) -> tuple[float, float]:
    """Bounds of the least value: 1 / trace of the inverse (Newton's step) and the least
    pivot of the sweep without shift."""
    d, least, total = q[0], q[0], 0.0
    for i in range(len(e)):
        if d <= 0:
            return 0.0, 0.0
        total += 1 / d
        d *= q[i + 1] / (d + e[i])
        least = min(least, d)
    if d <= 0:
        return 0.0, 0.0
    return 1 / (total + 1 / d), least


def squared_singular_values(diag: np.ndarray, sup: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the upper bidiagonal matrix, falling, by dqds.

    Shifts stay between Newton's lower bound and the least pivot; one that goes too far
    is taken back and becomes the upper bound.  All transforms work on positive numbers, so
    small values keep their relative accuracy.  Entries below the rounding of the
    largest count as that rounding (their value is noise of the reduction)."""
    n = len(diag)
    if not n:
        return np.zeros(0)
    scale = max(np.abs(diag).max(initial=0.0), np.abs(sup).max(initial=0.0))
    if not scale:
        return np.zeros(n)
    floor = 0.01 * EPS
    a, b = np.abs(diag) / scale, np.abs(sup) / scale
    blocks = [([max(x, floor) ** 2 for x in a.tolist()], (b * b).tolist(), 0.0)]
    found: list[float] = []
    while blocks:
        q, e, base = blocks.pop()
        low = 0.0  # rounding of the base, kept apart
        steps = 0
        while q:
            steps += 1
            if steps > 200 * n:
                raise ArithmeticError("dqds does not converge")
            m = len(q)
            if m == 1 or e[-1] <= EPS * EPS * (base + q[-1]):
                found.append(base + (q[-1] + low))
                q.pop()
                if e:
                    e.pop()
                continue
            cut = next((i for i in range(m - 2, -1, -1) if e[i] <= EPS * EPS * base), -1)
            if cut >= 0:  # the rest is a matrix of its own
                blocks.append((q[:cut + 1], e[:cut], base + low))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            lo, hi = _bounds(q, e)
            swept = None
            if lo > 0:
                for s in (math.sqrt(lo * hi) if lo < 0.99 * hi else lo * (1 - 8 * m * EPS), 0.999 * lo, 0.5 * lo):
                    if (swept := _shifted(q, e, s)) is not None:
                        break
            if swept is None:
                s, swept = 0.0, _shifted(q, e, 0.0)
                if swept is None:  # an exact zero
                    found.append(base + low)
                    q.pop()
                    e.pop()
                    continue
            q, e = swept
            new = base + (s + low)
            low = (base - new) + (s + low)
            base = new
    return np.sort(np.array(found))[::-1] * scale * scale


def _factors(diag: np.ndarray, sup: np.ndarray, lam: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """B'B - lam from the top (L, D), from the bottom (U, P) and the twists gamma."""
    n = len(diag)
    q = diag * diag
    low = np.divide(sup, diag[:-1], out=np.zeros(n - 1), where=diag[:-1] != 0)
    tiny = np.finfo(float).tiny ** 0.5 * max(q.max(initial=0.0), 1e-300)
    dplus, lplus = np.empty(n), np.empty(max(n - 1, 0))
    s = np.empty(n)
    s[0] = -lam
    for i in range(n - 1):
        dplus[i] = q[i] + s[i] or tiny
        lplus[i] = q[i] * low[i] / dplus[i]
        s[i + 1] = lplus[i] * low[i] * s[i] - lam
    dplus[n - 1] = q[n - 1] + s[n - 1] or tiny
    p = np.empty(n)
    uminus, minus = np.empty(max(n - 1, 0)), np.empty(n)
    p[n - 1] = q[n - 1] - lam
    for i in range(n - 2, -1, -1):
        minus[i + 1] = q[i] * low[i] * low[i] + p[i + 1] or tiny
        t = q[i] / minus[i + 1]
        uminus[i] = low[i] * t
        p[i] = p[i + 1] * t - lam
    minus[0] = p[0] or tiny
    return lplus, dplus, uminus, minus, s + p + lam


def _twisted_vector(diag: np.ndarray, sup: np.ndarray, lam: float) -> tuple[np.ndarray, float]:
    """Vector of the twist with the least pivot and its residual's pivot over the length squared."""
    lplus, _, uminus, _, gamma = _factors(diag, sup, lam)
    n = len(diag)
    k = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -lplus[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -uminus[i] * z[i]
    size = float(z @ z)
    return z / math.sqrt(size), float(gamma[k]) / size


def _solve(diag: np.ndarray, sup: np.ndarray, lam: float, x: np.ndarray) -> np.ndarray:
    """(B'B - lam)^-1 x by the twisted factorisation, scaled to length 1."""
    lplus, dplus, uminus, minus, gamma = _factors(diag, sup, lam)
    n = len(diag)
    k = int(np.argmin(np.abs(gamma)))
    y = np.array(x, float)
    for i in range(k):  # N y = x, from both ends to the twist
        y[i + 1] -= lplus[i] * y[i]
    for i in range(n - 1, k, -1):
        y[i - 1] -= uminus[i - 1] * y[i]
    pivot = np.concatenate([dplus[:k], [gamma[k] or EPS * EPS * (abs(lam) or 1.0)], minus[k + 1:]])
    y = y / pivot
    y /= np.abs(y).max() or 1.0
    for i in range(k - 1, -1, -1):
        y[i] -= lplus[i] * y[i + 1]
    for i in range(k, n - 1):
        y[i + 1] -= uminus[i] * y[i]
    return y / (np.linalg.norm(y) or 1.0)


def _product(diag: np.ndarray, sup: np.ndarray, z: np.ndarray) -> np.ndarray:
    """B'B z."""
    y = diag * z
    y[:-1] += sup * z[1:]
    out = diag * y
    out[1:] += sup * y[:-1]
    return out


CLUSTER = 1e-4  # values nearer than this, relatively, share their vectors' orthogonalisation


def right_vectors(diag: np.ndarray, sup: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Orthonormal vectors z (columns) with ``B'B z = values z`` for the first ``count`` values.

    A value apart from its neighbours gets its vector from one twisted factorisation and
    a Rayleigh correction; the values of a cluster get theirs by inverse iteration with twisted solves, made
    orthogonal to the cluster's others, from fixed random starts."""
    scale = max(np.abs(diag).max(initial=0.0), np.abs(sup).max(initial=0.0)) or 1.0
    # a zero on the diagonal would end the recurrences; the floor is far below rounding
    a = np.where(np.abs(diag) < 0.01 * EPS * scale, 0.01 * EPS * scale, diag) / scale
    b, lam = np.asarray(sup) / scale, np.asarray(values) / (scale * scale)
    n = len(a)
    out = np.zeros((n, count))
    rng = np.random.default_rng(7)
    first = 0
    while first < count:
        last = first
        while last + 1 < n and lam[last] - lam[last + 1] <= CLUSTER * lam[last]:
            last += 1
        many = last > first
        for j in range(first, min(last + 1, count)):
            near = out[:, first:j]
            if not many:
                at = lam[j]
                for _ in range(4):
                    z, off = _twisted_vector(a, b, at)
                    if abs(off) <= 2 * EPS * abs(at):
                        break
                    at += off
            else:
                z, least = None, np.inf
                for beside in (64, 1024, 16, 4096):
                    # beside the value, so that no other of the cluster is nearer by far
                    at, trial = lam[j] * (1 + beside * EPS), rng.normal(size=n)
                    for step in range(6):
                        for _ in range(2):
                            trial = trial - near @ (near.T @ trial)
                            trial /= np.linalg.norm(trial)
                        if step < 5:
                            trial = _solve(a, b, at, trial)
                    off = float(np.abs(_product(a, b, trial) - lam[j] * trial).max())
                    if off < least:
                        z, least = trial, off
                    if least <= 32 * EPS * lam[0]:
                        break
            out[:, j] = z
        first = last + 1
    return out


def right_singular(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of the square matrix, falling, and the first
    ``count`` right singular vectors as columns."""
    diag, sup, right = bidiagonalise(r)
    values = squared_singular_values(diag, sup)
    z = right_vectors(diag, sup, values, min(count, len(values)))
    return values, back_transform(right, z)
