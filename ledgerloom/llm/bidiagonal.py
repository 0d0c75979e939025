"""Singular values of a small square matrix by dqds, right singular vectors by twisted factorisation."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps

# Entries of the scaled bidiagonal below this count as this.
LEAST = 1e-20


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of a bidiagonal ``U' matrix W``, and the reflectors that make up W."""
    a = np.array(matrix, float)
    n = len(a)
    right: list[np.ndarray] = []
    for k in range(n):
        reflector = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(2 * reflector, reflector @ a[k:, k:])
        if k < n - 2:
            reflector = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ (2 * reflector), reflector)
            right.append(reflector)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray:
    """Unit vector whose reflection takes `x` to a multiple of the first axis; zero if it is one."""
    v = x.copy()
    size = np.abs(v).max(initial=0.0)
    if size == 0 or not v[1:].any():
        return np.zeros_like(v)
    v /= size
    v[0] += np.copysign(np.sqrt(v @ v), v[0])
    return v / np.sqrt(v @ v)


def from_bidiagonal(z: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """``W z`` for the columns of `z`."""
    out = z.copy()
    for k in range(len(right) - 1, -1, -1):
        v = right[k]
        out[k + 1 :] -= np.outer(2 * v, v @ out[k + 1 :])
    return out


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues, falling, of ``B'B`` for a bidiagonal B with squared entries `q` and `e`.

    Each shift is the reciprocal of the trace of the inverse, which never exceeds the least
    eigenvalue; it comes from the pivots of a transform without shift.
    """
    q, e = q.tolist(), e.tolist()
    found, shift, n, rounds = [], 0.0, len(q), 0
    while n:
        if n == 1 or e[n - 2] <= (4 * EPS) ** 2 * (shift + q[n - 1]):
            found.append(shift + q[n - 1])
            n -= 1
            continue
        rounds += 1
        if rounds > 60 * len(q):
            raise ArithmeticError("dqds does not settle")
        if q[0] * 1.5 < q[n - 1]:  # the small end belongs below
            q[:n], e[: n - 1] = q[:n][::-1], e[: n - 1][::-1]
        d, inverse = q[0], 1 / q[0]
        for i in range(n - 1):
            d *= q[i + 1] / (d + e[i])
            inverse += 1 / max(d, 1e-280)
        step = (1 - 64 * EPS) / inverse
        moved = _transform(q, e, n, step) or _transform(q, e, n, 0.0)
        if moved is None:
            raise ArithmeticError("dqds lost a pivot")
        shift += step if moved[2] else 0.0
        q[:n], e[: n - 1] = moved[0], moved[1]
    return np.sort(np.array(found))[::-1]


def _transform(q: list, e: list, n: int, shift: float) -> tuple | None:
    new_q, new_e, d = [], [], q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return None
        total = max(d + e[i], 1e-280)
        ratio = q[i + 1] / total
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    return [*new_q, max(d, 1e-280)], new_e, shift != 0.0


def _twisted(a: np.ndarray, b: np.ndarray, value: float):
    """Factors of ``B'B - value`` from above and below, and the twist at each place."""
    n = len(a)
    d, ratio = (a * a).tolist(), (b / a[:-1]).tolist()
    tiny = EPS * max(abs(value), 1e-280)
    upper, lower, s, p = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    s[0] = -value
    for i in range(n - 1):
        pivot = d[i] + s[i]
        upper[i] = d[i] * ratio[i] / (pivot if pivot else tiny)
        s[i + 1] = upper[i] * ratio[i] * s[i] - value
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * ratio[i] ** 2 + p[i + 1]
        t = d[i] / (pivot if pivot else tiny)
        lower[i] = ratio[i] * t
        p[i] = p[i + 1] * t - value
    return upper, lower, np.array(s) + np.array(p) + value


def _vector(upper: list, lower: list, k: int, n: int) -> np.ndarray:
    z = np.zeros(n)
    z[k] = 1.0
    with np.errstate(all="ignore"):
        for i in range(k - 1, -1, -1):
            z[i] = -upper[i] * z[i + 1]
        for i in range(k, n - 1):
            z[i + 1] = -lower[i] * z[i]
        z /= np.abs(z).max()
        return z / np.sqrt(z @ z)


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The greatest `count` singular values with their right singular vectors as columns, and the
    sum of all squared ones. Values within rounding of zero are left out."""
    diagonal, above, right = bidiagonalise(matrix)
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((len(matrix), 0)), 0.0
    n = len(diagonal)
    # Signs do not matter to B'B but for the vectors, which keep them.
    a = diagonal / scale
    a = np.where(np.abs(a) < LEAST, LEAST, a)
    b = above / scale
    values = dqds(a * a, b * b)
    kept = values[values > (n * EPS) ** 2 * values[0]][:count]

    def gram(z: np.ndarray) -> np.ndarray:
        w = a * z
        w[:-1] += b * z[1:]
        out = a * w
        out[1:] += b * w[:-1]
        return out

    columns: list[np.ndarray] = []
    for value in kept.tolist():
        upper, lower, twist = _twisted(a, b, value)
        best, least = None, np.inf
        # The first choice is right unless values are equal or nearly so; then other twists
        # give the rest of their space.
        for k in np.argsort(np.abs(np.nan_to_num(twist, nan=np.inf)), kind="stable").tolist():
            z = _vector(upper, lower, k, n)
            if not np.isfinite(z).all():
                continue
            for _ in range(2):
                for other in columns:
                    z = z - (other @ z) * other
            size = np.sqrt(z @ z)
            if size < 1e-3:
                continue
            z /= size
            off = gram(z) - value * z
            error = np.sqrt(off @ off)
            if error < least:
                best, least = z, error
            if error <= 1e-12 * values[0]:
                break
        if best is None:
            raise ArithmeticError("no vector for a singular value")
        columns.append(best)
    z = np.array(columns).T
    # Within the space they span, the vectors are turned to the axes of B'B.
    image = a[:, None] * z
    image[:-1] += b[:, None] * z[1:]
    z = z @ np.linalg.svd(image, full_matrices=False)[2].T
    return np.sqrt(kept) * scale, from_bidiagonal(z, right), float(values.sum()) * scale**2
