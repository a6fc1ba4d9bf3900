"""A symmetric matrix kept as its spectrum, changed by rank-one updates.

``V = U diag(d) U^T`` becomes the spectrum of ``V + rho v v^T`` for rho > 0. In
the basis U the change is ``diag(d) + rho z z^T`` with ``z = U^T v``. Deflation
first: an eigenvalue whose z is negligible stays as it is, and of eigenvalues
that agree one takes the whole weight, by a reflection of their vectors. The
others solve the secular equation ``1 + rho sum z_j^2 / (d_j - x) = 0``, one root
between each two poles, found for all roots at once with two-pole rational steps
kept inside a bracket. Each root is held as its distance from the nearer pole,
and the vectors come from a z that is recomputed from the roots, so that they are
orthogonal to working precision also where roots lie close together.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
MAX_STEPS = 80


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots for ascending distinct ``d`` and nonzero ``z``, and the matrix of
    ``d_j - root_i`` (row j, column i), exact to the last digits."""
    k = len(d)
    z2 = rho * z * z
    gap = np.append(np.diff(d), z2.sum())  # the last root lies within the total weight
    half = gap / 2

    def value(delta):  # delta[j, i] = d_j - x_i
        with np.errstate(divide="ignore"):
            return 1 + (z2[:, None] / delta).sum(0)

    # the pole nearer to the root is its origin; the last root has only the one below
    below = value((d[:, None] - d[None, :]) - half[None, :]) > 0
    below[-1] = True
    origin = np.where(below, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    shift = d[:, None] - d[origin][None, :]
    last = np.arange(k) == k - 1
    lo = np.where(below, 0.0, -half)
    hi = np.where(below, np.where(last, gap, half), 0.0)
    x = (lo + hi) / 2
    left = np.arange(k)[:, None] <= np.arange(k)[None, :]
    todo = np.ones(k, bool)
    for _ in range(MAX_STEPS):
        delta = shift - x[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            term = z2[:, None] / delta
            slope = term / delta
            f = 1 + term.sum(0)
            size = 1 + np.abs(term).sum(0)
            # bracket: f grows from minus to plus infinity between two poles
            lo, hi = np.where(f < 0, x, lo), np.where(f < 0, hi, x)
            todo &= (np.abs(f) > 8 * EPS * size) & (hi - lo > 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
            if not todo.any():
                break
            psi = np.where(left, slope, 0).sum(0)
            phi = slope.sum(0) - psi
            a_, b_ = delta.diagonal(), np.append(delta.diagonal(-1), np.inf)
            # two poles a_, b_ and a constant through value and both slopes
            c = f - a_ * psi - np.where(last, 0, b_ * phi)
            a = (a_ + b_) * f - a_ * b_ * (psi + phi)
            b = a_ * b_ * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # the last root: one pole and a constant
            step = np.where(last, a_ + a_ * a_ * psi / c, step)
        new = x + step
        inside = np.isfinite(new) & (new > lo) & (new < hi)
        mid = (lo + hi) / 2
        x = np.where(todo, np.where(inside, new, mid), x)
    return d[origin] + x, shift - x[None, :]


def update(d: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``u diag(d) u^T + rho v v^T``: ascending values, vectors in columns."""
    z = u.T @ v
    weight = rho * float(z @ z)
    if not weight > 0:
        return d, u
    tol = 8 * EPS * max(abs(d[-1]), abs(d[0]), weight)
    u = u.copy()
    # eigenvalues that agree: reflect their vectors so that one takes the weight
    cut = np.flatnonzero(np.diff(d) > tol) + 1
    for lo, hi in zip(np.append(0, cut), np.append(cut, len(d))):
        if hi - lo > 1 and (norm := np.linalg.norm(z[lo:hi])) > 0:
            w = z[lo:hi].copy()
            w[-1] += norm if w[-1] >= 0 else -norm
            w /= np.linalg.norm(w)
            u[:, lo:hi] -= 2 * np.outer(u[:, lo:hi] @ w, w)
            z[lo:hi] = np.append(np.zeros(hi - lo - 1), norm if z[hi - 1] < 0 else -norm)
    live = np.flatnonzero(np.abs(z) * np.sqrt(rho) * np.sqrt(weight) > tol)
    if len(live) == 0:
        return d, u
    da, za = d[live], z[live]
    roots, delta = secular_roots(da, za, rho)
    # z that belongs exactly to these roots: product over i of (root_i - d_j) / (d_i - d_j), i != j
    k = len(da)
    apart = da[None, :] - da[:, None]
    np.fill_diagonal(apart, 1.0)
    ratio = -delta / apart  # row j, column i
    za = np.sign(za) * np.sqrt(np.abs(np.prod(ratio, axis=1)))
    q = za[:, None] / delta
    q /= np.linalg.norm(q, axis=0)
    d = d.copy()
    d[live] = roots
    u[:, live] = u[:, live] @ q if k > 1 else u[:, live] * np.sign(q[0, 0])
    order = np.argsort(d, kind="stable")
    return d[order], u[:, order]


class Spectrum:
    """Count, mean and covariance spectrum (sums, not divided) of the rows seen."""

    def __init__(self, dim: int):
        self.n, self.mean = 0, np.zeros(dim)
        self.d, self.u = np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        """One row: a rank-one update by its centred value."""
        gap = x - self.mean
        if self.n:
            self.d, self.u = update(self.d, self.u, gap, self.n / (self.n + 1))
        self.n += 1
        self.mean += gap / self.n

    def merge(self, other: "Spectrum") -> None:
        """Another set of rows: a rank-one update for each of its eigenvectors
        and one for the distance of the means."""
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.d, self.u = other.n, other.mean.copy(), other.d, other.u
            return
        gap, total = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.d, other.u.T):
            if value > 0:
                self.d, self.u = update(self.d, self.u, vector, value)
        self.d, self.u = update(self.d, self.u, gap, self.n * other.n / total)
        self.mean += gap * (other.n / total)
        self.n = total
