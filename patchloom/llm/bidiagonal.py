"""Singular values and right singular vectors of a small square matrix.

Householder reflections make it bidiagonal, the differential qd algorithm with shifts finds
the singular values of that to high relative accuracy, and twisted factorisations give a
vector for each. All of it is on one matrix of the size of a vector, never on rows of data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = float(np.finfo(float).eps)
TINY = float(np.finfo(float).tiny)
CLUSTER = 1e-3  # eigenvalues nearer than this share get vectors made orthogonal to each other


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, upper diagonal b and orthogonal P with matrix = Q * B * P'."""
    work = np.array(matrix, dtype=float)
    d = work.shape[1]
    right = np.eye(d)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        """v and beta, so that (1 - beta v v') x has only its first entry left."""
        v, size = x.copy(), float(np.linalg.norm(x))
        if size == 0 or not np.any(x[1:]):
            return v, 0.0
        v[0] += size if v[0] >= 0 else -size
        return v, 2.0 / float(v @ v)

    for k in range(d):
        v, beta = reflector(work[k:, k])
        if beta:
            work[k:, k:] -= beta * np.outer(v, v @ work[k:, k:])
        if k < d - 2:
            v, beta = reflector(work[k, k + 1 :])
            if beta:
                work[k:, k + 1 :] -= beta * np.outer(work[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= beta * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(work).copy(), np.diag(work, 1).copy(), right


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One transform: the qd array of the matrix less ``shift``, and the least pivot on the way."""
    out_q, out_e = [], []
    d = least = q[0] - shift
    for k, off in enumerate(e):
        top = d + off
        if top <= 0:  # the shift was too large, or all is zero here
            if least >= 0 and off == 0 and d == 0 and shift == 0:
                out_q.append(0.0)
                out_e.append(0.0)
                d = q[k + 1]
                continue
            return q, e, -1.0
        ratio = q[k + 1] / top
        out_q.append(top)
        out_e.append(off * ratio)
        d = d * ratio - shift
        least = min(least, d)
    out_q.append(d)
    return out_q, out_e, least


def _shift(q: list[float], e: list[float]) -> float:
    """A value likely just below the least eigenvalue, from the last rows."""
    x, y = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1]
    off = q[-2] * e[-1]
    gap = x - y
    root = float(np.hypot(gap, 2 * off**0.5))
    low = max(0.0, (x * y - off) * 2 / (x + y + root)) if x + y else 0.0
    if len(e) > 1 and off:
        lean = (y - low) / (off + (y - low) ** 2) ** 0.5  # of the 2 x 2 eigenvector, towards the row above
        low -= (q[-3] * e[-2]) ** 0.5 * abs(lean)
    return max(0.0, low * (1 - 4 * EPS))


def qd_eigenvalues(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of B'B, falling, from the squares of an upper bidiagonal B."""
    found: list[float] = []
    parts = [(list(q), list(e), 0.0, 0.0)]  # with the shifts so far as a sum and what rounding lost of it
    tol = (100 * EPS) ** 2
    while parts:
        q, e, sigma, lost = parts.pop()
        for _ in range(60 * len(q) + 60):
            while e and e[-1] <= tol * (sigma + q[-1]):
                found.append(sigma + (q.pop() + lost))
                e.pop()
            if not e:
                found.extend(sigma + (x + lost) for x in q)
                q = []
                break
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= tol * (sigma + q[k])), None)
            if cut is not None:
                parts.append((q[: cut + 1], e[:cut], sigma, lost))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            shift = _shift(q, e)
            for attempt in range(4):
                new_q, new_e, least = _dqds(q, e, shift)
                if least >= 0:
                    break
                shift = shift / 4 if attempt < 2 else 0.0
            if least < 0:
                raise ArithmeticError("qd array is not positive")
            q, e = new_q, new_e
            total = sigma + (shift + lost)
            lost = (shift + lost) - (total - sigma)
            sigma = total
        if q:
            raise ArithmeticError("singular values were not found")
    return sorted(found, reverse=True)


@dataclass
class Twisted:
    """B'B - value as N * delta * N', N lower bidiagonal above row ``at`` and upper below it."""

    lower: np.ndarray
    upper: np.ndarray
    delta: np.ndarray
    at: int

    def solve(self, x: np.ndarray) -> np.ndarray:
        """y with (B'B - value) y = x, scaled to length 1."""
        y, r, m = x.astype(float), self.at, len(x)
        for i in range(r):
            y[i + 1] -= self.lower[i] * y[i]
        for i in range(m - 2, r - 1, -1):
            y[i] -= self.upper[i] * y[i + 1]
        y = y / self.delta
        y /= np.abs(y).max()
        for i in range(r - 1, -1, -1):
            y[i] -= self.lower[i] * y[i + 1]
        for i in range(r, m - 1):
            y[i + 1] -= self.upper[i] * y[i]
        return y / np.linalg.norm(y)


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> Twisted:
    """Factorise B'B - value from both ends, meeting where the middle pivot is least."""
    m, q, e, off = len(a), a * a, b * b, a[:-1] * b
    least = max(TINY, EPS * EPS * float(q.max(initial=0.0) + e.max(initial=0.0)))
    plus, minus = np.empty(m), np.empty(m)
    s, p = np.empty(m), np.empty(m)

    def pivot(x: float) -> float:
        return x if abs(x) > least else least if x >= 0 else -least

    s[0] = -value
    for i in range(m):
        plus[i] = pivot(s[i] + q[i])
        if i < m - 1:
            s[i + 1] = e[i] * s[i] / plus[i] - value
    p[m - 1] = q[m - 1] - value
    for i in range(m - 1, 0, -1):
        minus[i] = pivot(e[i - 1] + p[i])
        p[i - 1] = p[i] * q[i - 1] / minus[i] - value
    minus[0] = pivot(p[0])
    middle = s + p + value
    at = int(np.argmin(np.abs(middle)))
    delta = np.concatenate([plus[:at], [pivot(middle[at])], minus[at + 1 :]])
    return Twisted(off / plus[:-1], off / minus[1:], delta, at)


def _vectors(a: np.ndarray, b: np.ndarray, values: list[float]) -> np.ndarray:
    """Unit eigenvectors of B'B, a row for each of its falling ``values``."""
    m, out, cluster = len(a), [], []
    rng = np.random.default_rng(m)
    enough = 16 * m * EPS * float((a * a).max() + (b * b).max(initial=0.0))

    def residual(z: np.ndarray, value: float) -> float:
        bz = a * z
        bz[:-1] += b * z[1:]
        back = a * bz
        back[1:] += b * bz[:-1]
        return float(np.linalg.norm(back - value * z))

    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * values[i - 1]:
            cluster = []
        factors = twisted(a, b, value)
        z = factors.solve(np.eye(m)[factors.at])
        for _ in range(8 if cluster else 0):  # inverse iteration beside the vectors of the cluster
            for other in [*cluster, *cluster]:
                z = z - (other @ z) * other
            size = float(np.linalg.norm(z))
            z = z / size if size > EPS else rng.standard_normal(m)
            if size > EPS and residual(z, value) <= enough:
                break
            z = factors.solve(z)
        else:
            for other in [*cluster, *cluster]:
                z = z - (other @ z) * other
            z = z / np.linalg.norm(z)
        cluster.append(z)
        out.append(z)
    return np.array(out)


def right_singular(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest squared singular values, falling, and their right vectors as rows.

    Values that rounding alone could make are left out, so a matrix of low rank gives fewer.
    """
    scale = float(np.abs(matrix).max(initial=0.0))
    if scale == 0 or not most:
        return np.zeros(0), np.zeros((0, matrix.shape[1]))
    a, b, right = bidiagonalise(matrix / scale)
    sign = np.concatenate([[1.0], np.cumprod(np.where(a[:-1] * b < 0, -1.0, 1.0))])
    a, b = np.abs(a), np.abs(b)
    size = float(max(a.max(), b.max(initial=0.0)))
    edges = [0, *(np.flatnonzero(b <= EPS * size / 100) + 1).tolist(), len(a)]
    pairs = []
    for low, high in zip(edges, edges[1:]):
        part_a, part_b = a[low:high], b[low : high - 1]
        values = qd_eigenvalues((part_a**2).tolist(), (part_b**2).tolist())
        kept = [v for v in values if v > 0][:most]
        for value, z in zip(kept, _vectors(part_a, part_b, kept) if kept else ()):
            whole = np.zeros(len(a))
            whole[low:high] = z
            pairs.append((value, whole))
    pairs.sort(key=lambda p: -p[0])
    floor = (64 * len(a) * EPS) ** 2 * pairs[0][0] if pairs else 0.0
    pairs = [p for p in pairs if p[0] > floor][:most]
    vectors = np.array([right @ (sign * z) for _, z in pairs]).reshape(len(pairs), matrix.shape[1])
    return np.array([v for v, _ in pairs]) * scale**2, vectors
