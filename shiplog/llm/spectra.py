"""Eigendecompositions that grow by rank-one updates.

`updated` turns the eigendecomposition of A into that of A + rho v v'. In the basis of A's
eigenvectors that is a diagonal matrix plus rho z z'; its eigenvalues are the roots of the secular
equation 1 + rho sum(z_j^2 / (d_j - x)) = 0, one between any two neighbouring d_j. Entries of z that
vanish, and all but one of those that share a d_j, leave their eigenpairs as they are and are
deflated first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = np.finfo(np.float64).eps
MOST_STEPS = 80


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """(origin, shift) of each root: the nearer pole and the distance from it.

    `d` ascends, `z2` and `rho` are positive. Each step fits a rational function with the two
    poles around the root; a step that leaves the bracket is a bisection instead.
    """
    k = len(d)
    right = np.r_[d[1:], d[-1] + rho * z2.sum()]
    gap = right - d
    to_left = d[:, None] - d[None, :]  # [pole, root]

    half = gap / 2
    near_left = 1 + rho * (z2[:, None] / (to_left - half)).sum(axis=0) >= 0
    near_left[-1] = True
    origin = np.where(near_left, d, right)
    delta = d[:, None] - origin[None, :]
    low = np.where(near_left, 0.0, -half)
    high = np.where(near_left, np.where(np.arange(k) == k - 1, gap, half), 0.0)
    shift = (low + high) / 2
    lower = np.arange(k)[:, None] <= np.arange(k)[None, :]
    first, second = d - origin, right - origin
    for _ in range(MOST_STEPS):
        apart = delta - shift
        terms = rho * z2[:, None] / apart
        slopes = terms / apart
        f = 1 + terms.sum(axis=0)
        low, high = np.where(f < 0, shift, low), np.where(f < 0, high, shift)
        small = EPS * k * (1 + np.abs(terms).sum(axis=0))
        open_ = (np.abs(f) > small) & (high - low > 2 * EPS * np.abs(shift))
        if not open_.any():
            break
        psi = (slopes * lower).sum(axis=0)
        phi = slopes.sum(axis=0) - psi
        one, two = first - shift, second - shift
        c = f - one * psi - two * phi
        a = (one + two) * f - one * two * (psi + phi)
        b = one * two * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(all="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        moved = shift + step
        fine = np.isfinite(moved) & (moved > low) & (moved < high)
        shift = np.where(open_, np.where(fine, moved, (low + high) / 2), shift)
    return origin, shift


def _rank_one(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of diag(d) + rho z z', all z different from zero and all d
    from one another. The vectors come from the z that the computed roots belong to exactly,
    which makes them orthogonal however close the roots lie."""
    origin, shift = secular_roots(d, z * z, rho)
    apart = (d[:, None] - origin[None, :]) - shift  # d_j - root_i
    k = len(d)
    between = d[:, None] - d[None, :]
    np.fill_diagonal(between, 1.0)
    # z_j^2 = prod_i (root_i - d_j) / prod_(i != j) (d_i - d_j), in an order that keeps factors tame
    ratio = np.empty((k, k))
    low, high = np.tril_indices(k, -1), np.triu_indices(k, 1)
    ratio[low] = apart[low] / between[low]
    ratio[high] = apart[high] / between[high]
    np.fill_diagonal(ratio, -np.diag(apart))
    fitted = np.sign(z) * np.sqrt(np.abs(np.prod(ratio, axis=1)) / rho)
    vectors = fitted[:, None] / apart
    vectors /= np.linalg.norm(vectors, axis=0)
    return origin + shift, vectors


def updated(
    d: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float
) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of u diag(d) u' + rho v v'; rho >= 0."""
    z = u.T @ v
    size = rho * float(z @ z)
    if size == 0:
        return d, u
    scale = max(float(np.abs(d).max()), size)
    u = u.copy()
    # Of eigenvalues that are equal up to rounding, a reflection leaves one with a part of z.
    close = np.diff(d) <= 4 * EPS * scale
    edges = np.flatnonzero(np.diff(np.r_[0, close, 0]))
    for start, end in zip(edges[::2].tolist(), (edges[1::2] + 1).tolist()):
        part = z[start:end].copy()
        length = np.linalg.norm(part)
        if length == 0:
            continue
        part[-1] += np.copysign(length, part[-1])
        part /= np.linalg.norm(part)
        u[:, start:end] -= 2 * np.outer(u[:, start:end] @ part, part)
        z[start:end] = 0
        z[end - 1] = -np.copysign(length, part[-1])
        d = d.copy()
        d[start:end] = d[start:end].mean()
    live = rho * np.abs(z) * np.linalg.norm(z) > EPS * scale
    d = d.copy()
    if live.sum() == 1:
        d[live] += rho * z[live] ** 2
    elif live.any():
        d[live], turn = _rank_one(d[live], z[live], rho)
        u[:, live] = u[:, live] @ turn
    order = np.argsort(d, kind="stable")
    return d[order], u[:, order]


@dataclass
class Spectrum:
    """Count, exact sums, mean and the eigendecomposition of the scatter around the mean."""

    n: int
    sums: np.ndarray  # of integers, exact
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def nothing(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim, np.int64), np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        """One vector of integers: a rank-one update along its way from the mean."""
        away = x - self.mean
        rho = self.n / (self.n + 1)
        self.n += 1
        self.sums = self.sums + x
        self.mean = self.mean + away / self.n
        self.values, self.vectors = updated(self.values, self.vectors, away, rho)

    def absorb(self, other: Spectrum) -> None:
        """Another spectrum: a rank-one update for each of its eigenpairs, one for the means."""
        if not other.n:
            return
        floor = EPS * max(float(other.values.max(initial=0)), float(self.values.max(initial=0)))
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > floor:
                self.values, self.vectors = updated(self.values, self.vectors, vector, value)
        n = self.n + other.n
        away = other.mean - self.mean
        self.values, self.vectors = updated(
            self.values, self.vectors, away, self.n * other.n / n
        )
        self.mean = self.mean + away * (other.n / n)
        self.n, self.sums = n, self.sums + other.sums
