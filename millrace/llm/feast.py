"""Eigenpairs of a symmetric matrix in an interval, by contour integration.

The projector onto the eigenvectors of an interval is a contour integral of the
resolvent around it.  A quadrature of few nodes, each a solve with a complex
shifted matrix, filters a block of vectors; Rayleigh-Ritz in the filtered block
gives the pairs, and filtering again sharpens them.  Sylvester's law gives the
number of eigenvalues above any shift, from the signs of the pivots of a
symmetric elimination, so that no pair of an interval can be missed.
"""

from __future__ import annotations

import numpy as np

_EPS = float(np.finfo(float).eps)


class Inertia:
    """Numbers of eigenvalues above a shift, from the pivots' signs in the elimination of a matrix brought to three diagonals once."""

    def __init__(self, a: np.ndarray):
        a = a.copy()
        for k in range(len(a) - 2):
            v = a[k + 1:, k].copy()
            v[0] += np.copysign(np.linalg.norm(v), v[0])
            length = np.linalg.norm(v)
            if length == 0.0:
                continue
            v /= length
            head = a[k + 1, k] - 2 * v[0] * (v @ a[k + 1:, k])
            rest = a[k + 1:, k + 1:]
            w = rest @ v
            w -= (v @ w) * v
            rest -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] = head
        self.diagonal, self.squares = a.diagonal().tolist(), [0.0, *(a.diagonal(-1) ** 2).tolist()]
        self.tiny = _EPS * max(1e-300, float(np.abs(a.diagonal()).max(initial=0.0)), float(np.abs(a.diagonal(-1)).max(initial=0.0))) ** 2

    def above(self, shift: float) -> int:
        n, pivot = 0, 1.0
        for d, s in zip(self.diagonal, self.squares, strict=True):
            pivot = d - shift - s / pivot
            if abs(pivot) < self.tiny:
                pivot = -self.tiny
            n += pivot > 0
        return n


def _edge(a: Inertia, n: int, at: float, outside: float, fine: float) -> float:
    """About where the gap around ``at`` ends, with ``n`` eigenvalues above it, on the way to ``outside``."""
    inside = at
    while abs(outside - inside) > max(fine, abs(inside - at) / 8):
        middle = (inside + outside) / 2
        inside, outside = (middle, outside) if a.above(middle) == n else (inside, middle)
    return inside


def _cut(a: Inertia, low: float, high: float, want: int) -> tuple[float, int]:
    """A shift in a gap with ``want`` eigenvalues above it, or as many more as a tie leaves, and their number."""
    fine = 64 * len(a.diagonal) * _EPS * high
    bottom, top = low, high
    while top - bottom > fine:
        middle = (bottom + top) / 2
        n = a.above(middle)
        bottom, top = (middle, middle) if n == want else (middle, top) if n > want else (bottom, middle)
    n = a.above(bottom)
    down = low if a.above(low) == n else _edge(a, n, bottom, low, fine)
    return (down + _edge(a, n, bottom, high, fine)) / 2, n


def slices(a: Inertia, want: int, most: int, lowest: float, highest: float) -> list[tuple[float, float, int]]:
    """Intervals (low, high, number) that hold the ``want`` largest eigenvalues over ``lowest``.

    An interval has about ``most`` eigenvalues and spans about a factor of four, so the
    contour passes none of them closely as compared with its size.
    """
    out, done, high = [], 0, highest
    want = min(want, a.above(lowest))
    while done < want:
        largest, _ = _cut(a, lowest, high, done + 1)
        near = a.above(max(lowest, min(largest, high) / 4))
        low, n = _cut(a, lowest, high, min(want, done + most, max(near, done + 1)))
        out.append((low, high, n - done))
        done, high = n, low
    return out


def interval_pairs(a: np.ndarray, low: float, high: float, n: int, nodes: int = 8, rounds: int = 40) -> np.ndarray:
    """The ``n`` eigenvectors of the eigenvalues between two shifts, as columns."""
    d = len(a)
    block = np.random.default_rng(d * 1009 + n).standard_normal((d, min(d, 2 * n + 4)))
    x, weights = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(1j * np.pi / 2 * (1 - x))
    centre, radius, size = (low + high) / 2, (high - low) / 2, np.abs(a).sum(1).max()
    best, pairs = np.inf, None
    for _ in range(rounds):
        filtered = np.zeros_like(block)
        for t, w in zip(turn, weights, strict=True):  # the other half of the circle is the conjugate
            filtered += w / 2 * (radius * t * np.linalg.solve((centre + radius * t) * np.eye(d) - a, block)).real
        q = np.linalg.qr(filtered)[0]
        values, small = np.linalg.eigh(q.T @ a @ q)
        block = q @ small
        error = np.linalg.norm(a @ block - block * values, axis=0)
        inside = np.flatnonzero((values > low) & (values <= high))
        inside = inside[np.argsort(error[inside])[:n]]
        if len(inside) == n:
            worst = error[inside].max() / size
            if worst < best / 2:
                best, pairs = worst, block[:, inside]
            elif best < 1e-12:
                break
    if best > 1e-9:
        raise ArithmeticError(f"{n} eigenvalues lie between {low} and {high}, but their vectors were not reached")
    return pairs


def largest_pairs(a: np.ndarray, want: int, most: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(values falling, unit vectors as columns) of the largest eigenvalues that differ from 0, ``want`` at most."""
    size = float(np.abs(a).sum(1).max()) if a.size else 0.0
    if size == 0.0:
        return np.zeros(0), np.zeros((len(a), 0))
    a = a / size
    counts, least = Inertia(a), 64 * len(a) * _EPS
    found = slices(counts, want, most, least, 1.0 + 64 * _EPS)
    if not found:
        return np.zeros(0), np.zeros((len(a), 0))
    q = np.linalg.qr(np.concatenate([interval_pairs(a, *s) for s in found], 1))[0]
    if q.shape[1] < min(want, counts.above(least)):
        raise ArithmeticError("eigenvalues are missing")
    values, small = np.linalg.eigh(q.T @ a @ q)
    order = np.argsort(-values)[:want]
    return values[order] * size, q @ small[:, order]
