"""Singular values and right vectors of a square matrix: Householder bidiagonalisation,
dqds with Rutishauser's shifts, and twisted factorisations for the vectors.

The matrix is no larger than the dimension of the vectors, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Eigenvalues closer than this, relative to the larger, are treated as one cluster.
CLUSTER = 1e-6


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """v, beta and alpha with (I - beta v v') x = alpha e1."""
    norm = float(np.linalg.norm(x))
    if norm == 0.0:
        return np.zeros_like(x), 0.0, 0.0
    alpha = -norm if x[0] > 0 else norm
    v = x.copy()
    v[0] -= alpha
    return v, 2.0 / float(v @ v), alpha


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Diagonal, superdiagonal and right reflectors of an upper bidiagonal form."""
    a = matrix.astype(float).copy()
    d = a.shape[1]
    right = []
    diag, above = np.zeros(d), np.zeros(max(d - 1, 0))
    for k in range(d):
        v, beta, diag[k] = _reflector(a[k:, k])
        if beta and k + 1 < d:
            a[k:, k + 1:] -= np.outer(beta * v, v @ a[k:, k + 1:])
        if k + 2 < d:
            v, beta, above[k] = _reflector(a[k, k + 1:])
            if beta:
                a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k + 1:] @ v, beta * v)
            right.append((v, beta))
        elif k + 1 < d:
            above[k] = a[k, k + 1]
    return diag, above, right


def _two(q1: float, e1: float, q2: float) -> tuple[float, float]:
    """Eigenvalues of the 2 x 2 block with this qd array, the larger first, without cancellation."""
    total, product = q1 + e1 + q2, q1 * q2
    root = np.sqrt(max((q1 - q2 + e1) ** 2 + 4 * q2 * e1, 0.0))
    large = (total + root) / 2
    return large, product / large if large else 0.0


def _transform(q: list, e: list, shift: float):
    """One dqds sweep; None and the place and value of a negative pivot when the shift is too large."""
    n = len(q)
    q_new, e_new = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    for j in range(n - 1):
        if d < 0:
            return None, j, d
        q_new[j] = d + e[j]
        t = q[j + 1] / q_new[j] if q_new[j] else 0.0
        e_new[j] = e[j] * t
        d = (d * t if q_new[j] else q[j + 1]) - shift
    if d < 0:
        return None, n - 1, d
    q_new[-1] = d
    return (q_new, e_new), n, d


def dqds(diag: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling."""
    found, stack = [], [((diag ** 2).tolist(), (above ** 2).tolist(), 0.0)]
    while stack:
        q, e, moved = stack.pop()
        for _ in range(60 * len(q) + 60):
            n = len(q)
            if n == 0:
                break
            if n == 1:
                found.append(q[0] + moved)
                break
            if n == 2:
                found += [x + moved for x in _two(q[0], e[0], q[1])]
                break
            if e[-1] <= EPS ** 2 * (moved + q[-1]) or e[-1] == 0.0:
                found.append(q[-1] + moved)
                q, e = q[:-1], e[:-1]
                continue
            if e[-2] <= EPS ** 2 * (moved + q[-2]):
                found += [x + moved for x in _two(q[-2], e[-1], q[-1])]
                q, e = q[:-2], e[:-2]
                continue
            cut = next((j for j in range(n - 2) if e[j] <= EPS ** 2 * (moved + q[j]) or e[j] == 0.0), None)
            if cut is not None:
                stack.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if q[0] < q[-1]:  # the small end belongs at the bottom; a reversed and transposed B has the same values
                q, e = q[::-1], e[::-1]
            corner = q[-1] + e[-1]
            shift = _two(q[-2], e[-1], q[-1])[1] if corner else 0.0
            for attempt in range(4):
                new, place, d = _transform(q, e, shift)
                if new is not None:
                    break
                # A failure at the last pivot alone says how far the shift was too large.
                shift = max(shift + d, 0.0) if place == n - 1 and attempt == 0 else shift / 4 if attempt < 2 else 0.0
            q, e = new
            moved += shift
        else:
            raise ArithmeticError("dqds does not converge")
    return np.sort(np.array(found))[::-1]


def twisted_vector(diag: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B = L D L' for an eigenvalue, from the twist with the smallest pivot."""
    n = len(diag)
    d, l = diag ** 2, above / diag[:-1]
    tiny = EPS ** 2 * max(value, 1e-300)
    lower, upper, s, p = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + d[i] or tiny
        lower[i] = d[i] * l[i] / pivot
        s[i + 1] = lower[i] * l[i] * s[i] - value
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * l[i] ** 2 + p[i + 1] or tiny
        t = d[i] / pivot
        upper[i] = l[i] * t
        p[i] = p[i + 1] * t - value
    gamma = np.abs(s + p + value)
    twist = int(np.argmin(np.where(np.isfinite(gamma), gamma, np.inf)))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def _other_vector(diag, above, value, found: list[np.ndarray]) -> np.ndarray:
    """Another eigenvector of a cluster: inverse iteration kept orthogonal to those found."""
    n = len(diag)
    b = np.diag(diag) + np.diag(above, 1)
    shifted = b.T @ b - (value * (1 + 4 * EPS) + 1e-300) * np.eye(n)
    z = np.random.default_rng(len(found)).standard_normal(n)
    for _ in range(4):
        z = np.linalg.lstsq(shifted, z, rcond=EPS ** 2)[0]
        z /= np.linalg.norm(z)
        for _ in range(2):
            for other in found:
                z = z - (other @ z) * other
        z /= np.linalg.norm(z)
    return z


def right_vectors(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values (positive to rounding) and their right vectors, as rows."""
    dim = matrix.shape[1]
    scale = float(np.abs(matrix).max(initial=0.0))
    if dim == 0 or scale == 0.0:
        return np.zeros(0), np.zeros((0, dim))
    diag, above, right = bidiagonalise(matrix / scale)
    # An exact zero on the diagonal gets a size below rounding, so that L D L' exists.
    diag = np.where(np.abs(diag) < EPS ** 2, EPS ** 2, diag)
    values = dqds(diag, above)[:count]
    values = values[values > (dim * EPS) ** 2 * values[0]]
    vectors: list[np.ndarray] = []
    for value in values:
        z = twisted_vector(diag, above, value) if dim > 1 else np.ones(1)
        near = [v for v, other in zip(vectors, values) if other - value <= CLUSTER * other]
        rest = z - sum(((v @ z) * v for v in near), np.zeros(dim))
        if not np.isfinite(z).all() or np.linalg.norm(rest) < 0.7:
            z = _other_vector(diag, above, value, near)
        else:
            rest -= sum(((v @ rest) * v for v in near), np.zeros(dim))
            z = rest / np.linalg.norm(rest)
        vectors.append(z)
    out = np.array(vectors)
    for k in range(len(right) - 1, -1, -1):
        v, beta = right[k]
        if beta:
            out[:, k + 1:] -= np.outer(out[:, k + 1:] @ v, beta * v)
    return values * scale ** 2, out
