"""Leading eigenvectors of a symmetric matrix by contour integration (FEAST).

* ``Inertia`` counts the eigenvalues below a shift: the matrix is brought to tridiagonal
  form once, and the signs of the pivots of the shifted form are its inertia (Sylvester).
* ``intervals`` cuts the axis, from the top, into pieces that hold a few eigenvalues each.
* ``inside`` projects a block of vectors onto the eigenvectors of one piece: the integral of
  the resolvent round the piece, as a Gauss-Legendre sum of complex shifted solves; then
  Rayleigh-Ritz extracts the pairs.  It repeats until the residuals are at rounding level
  and as many pairs lie inside as the inertia says; a larger block follows where they don't.
* ``leading`` joins the pieces by one more Rayleigh-Ritz step over all their vectors, so
  that vectors of neighbouring pieces are orthogonal to double precision.

The matrix is dimension x dimension, whatever the number of rows behind it.
"""

from __future__ import annotations

import numpy as np

POINTS = 8  # quadrature points on the upper half of the contour
EXTRA = 8  # vectors of a block beyond the number looked for
MOST = 8  # eigenvalues of one piece, unless they can't be told apart
EPS = float(np.finfo(float).eps)


class Inertia:
    """Eigenvalue counts of a symmetric matrix."""

    def __init__(self, a: np.ndarray):
        a, n = a.copy(), len(a)
        for k in range(n - 2):  # Householder reflections from both sides
            x = a[k + 1 :, k].copy()
            norm = np.linalg.norm(x)
            if norm == 0:
                continue
            x[0] += np.copysign(norm, x[0])
            x /= np.linalg.norm(x)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ x
            q = 2 * (p - (x @ p) * x)
            rest -= np.outer(x, q) + np.outer(q, x)
            a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
            a[k, k + 1 :] = a[k + 1 :, k]
        self.n, self.diagonal, self.beside = n, np.diag(a).copy(), np.diag(a, -1).copy()
        reach = np.abs(np.append(self.beside, 0)) + np.abs(np.insert(self.beside, 0, 0))
        self.low, self.high = float((self.diagonal - reach).min()), float((self.diagonal + reach).max())
        self.scale = max(abs(self.low), abs(self.high))

    def below(self, shifts: np.ndarray) -> np.ndarray:
        """How many eigenvalues are less than each shift."""
        s = np.asarray(shifts, dtype=float)
        least = EPS * EPS * max(self.scale, 1e-300)
        pivot, count = np.ones_like(s), np.zeros(s.shape, dtype=int)
        for k in range(self.n):
            pivot = self.diagonal[k] - s - (self.beside[k - 1] ** 2 / pivot if k else 0.0)
            pivot = np.where(np.abs(pivot) < least, -least, pivot)
            count += pivot < 0
        return count


def intervals(inertia: Inertia, k: int, floor: float) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), from the top, until they hold ``k``; nothing below ``floor``."""
    low, high = floor, inertia.high + 1e-6 * inertia.scale
    at = inertia.below(np.array([low, high]))
    left, out = [(low, high, int(at[0]), int(at[1]))], []
    while left and k > 0:
        a, b, under_a, under_b = left.pop()
        held = under_b - under_a
        if held <= 0:
            continue
        if held <= MOST or b - a <= 1e-9 * inertia.scale:
            out.append((a, b, held))
            k -= held
            continue
        cuts = a + (b - a) * np.linspace(0, 1, 34)[1:-1]
        counts = inertia.below(cuts)
        # cut inside the longest stretch of the middle half that holds no eigenvalue
        width, best = 0, len(cuts) // 2
        i = len(cuts) // 4
        while i < 3 * len(cuts) // 4:
            j = i
            while j + 1 < 3 * len(cuts) // 4 and counts[j + 1] == counts[i]:
                j += 1
            if j - i > width:
                width, best = j - i, (i + j) // 2
            i = j + 1
        left += [(a, float(cuts[best]), under_a, int(counts[best])), (float(cuts[best]), b, int(counts[best]), under_b)]
    return out


def _ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q, _ = np.linalg.qr(block)
    q, _ = np.linalg.qr(q)
    h = q.T @ v @ q
    e, u = np.linalg.eigh((h + h.T) / 2)
    return e, q @ u


def inside(v: np.ndarray, low: float, high: float, held: int, scale: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``held`` eigenpairs of ``v`` between ``low`` and ``high``."""
    n = len(v)
    x, w = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(1j * np.pi / 2 * (1 - x))
    centre, radius = (low + high) / 2, (high - low) / 2
    solve = [np.linalg.inv((centre + radius * t) * np.eye(n) - v) for t in turn]
    size, rng = min(n, held + max(EXTRA, held // 2)), np.random.Generator(np.random.PCG64(seed))
    while True:
        block = rng.standard_normal((n, size))
        before = np.inf
        for _ in range(30):
            block = sum((w[j] / 2 * radius) * (turn[j] * (solve[j] @ block)).real for j in range(POINTS))
            e, block = _ritz(v, block)
            mine = (e >= low) & (e < high)
            off = np.linalg.norm(v @ block[:, mine] - block[:, mine] * e[mine], axis=0).max(initial=0.0)
            if mine.sum() == held and (off <= 8 * EPS * scale or off >= before / 2 and off <= 1e-11 * scale):
                return e[mine], block[:, mine]
            before = off if mine.sum() == held else np.inf
        if size == n:  # an eigenvalue within rounding of an end: the nearest ones, by Rayleigh-Ritz over the whole space
            near = np.sort(np.argsort(np.maximum(low - e, e - high), kind="stable")[:held])
            return e[near], block[:, near]
        size = min(n, 2 * size)


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The up to ``k`` greatest eigenvalues above rounding level (falling), and unit eigenvectors as columns."""
    n = len(v)
    if not n or not np.any(v):
        return np.empty(0), np.empty((n, 0))
    inertia = Inertia(v)
    floor = 4 * n * EPS * inertia.scale
    k = min(k, n - int(inertia.below(np.array([floor]))[0]))
    parts = [inside(v, *piece, inertia.scale) for piece in intervals(inertia, k, floor)]
    if not parts:
        return np.empty(0), np.empty((n, 0))
    e, u = _ritz(v, np.hstack([p[1] for p in parts]))
    order = np.argsort(-e, kind="stable")[:k]
    return e[order], u[:, order]
