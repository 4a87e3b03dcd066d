"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of ``V - s I``, read off an LDL' factorisation with symmetric
pivoting, counts the eigenvalues above ``s`` (Sylvester's law). Bisection on
these counts isolates the eigenvalue of each wanted number; Rayleigh quotient
iteration then converges cubically, and the counts on both sides of its result
certify that it is the eigenvalue of that number and not a neighbour.
Eigenvalues that double precision can't tell apart are taken together, with any
orthonormal basis of their space.

The matrix has a vector's dimensions, whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
#: Bunch and Parlett's bound on the growth of pivots.
_ALPHA = (1 + 17**0.5) / 8
#: Eigenvalues nearer to each other than this share of the largest are one group.
GROUP_GAP = 1e-11


def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``v`` above ``shift``: positive eigenvalues of D in LDL' = v - shift I."""
    a = v - shift * np.eye(len(v))
    tiny = _EPS * max(np.abs(a).max(initial=0.0), np.finfo(np.float64).tiny)
    above = 0
    while len(a):
        on = np.abs(np.diagonal(a))
        p = int(on.argmax())
        off = np.abs(a - np.diag(np.diagonal(a)))
        q, r = divmod(int(off.argmax()), len(a))
        if on[p] >= _ALPHA * off[q, r]:
            d = a[p, p]
            if abs(d) <= tiny:  # all that is left is zero
                return above
            above += d > 0
            rest = np.delete(np.arange(len(a)), p)
            column = a[rest, p]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / d)
        else:  # a pivot of two rows has a negative determinant: one eigenvalue of each sign
            above += 1
            rest = np.delete(np.arange(len(a)), [q, r])
            columns = a[np.ix_(rest, [q, r])]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(a[np.ix_([q, r], [q, r])], columns.T)
    return above


class Slices:
    """Inertia counts of one matrix, kept by shift."""

    def __init__(self, v: np.ndarray):
        self.v = v
        reach = np.abs(v).sum(axis=1).max(initial=0.0) * (1 + 4 * _EPS)
        self.known = {-reach: len(v), reach: 0}

    def count(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = count_above(self.v, shift)
        return self.known[shift]

    def around(self, number: int) -> tuple[float, float]:
        """The nearest known shifts with eigenvalue ``number`` (1: the largest) above the one and not above the other."""
        return max(s for s, c in self.known.items() if c >= number), min(s for s, c in self.known.items() if c < number)

    def bisect(self, number: int) -> None:
        low, high = self.around(number)
        self.count((low + high) / 2)


def _solved(v: np.ndarray, shift: float, x: np.ndarray, norm: float) -> np.ndarray:
    """Direction of (v - shift I)^-1 x; a shift that is an eigenvalue to the last bit is moved by one."""
    for step in (0.0, 2.0, 8.0, 64.0):
        try:
            y = np.linalg.solve(v - (shift + step * _EPS * norm) * np.eye(len(v)), x)
        except np.linalg.LinAlgError:
            continue
        length = np.linalg.norm(y)
        if np.isfinite(length) and length > 0:
            return y / length
    return x


def _iterated(v: np.ndarray, low: float, high: float, start: np.ndarray, found: np.ndarray, norm: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from the middle of (low, high), at right angles to ``found``."""
    def clear(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - found @ (found.T @ x)
        return x / np.linalg.norm(x)

    x = clear(start)
    shift = (low + high) / 2
    for _ in range(2):  # near the interval first
        x = clear(_solved(v, shift, x, norm))
    for _ in range(30):
        shift = float(x @ v @ x)
        if not low < shift < high:
            break
        if np.linalg.norm(v @ x - shift * x) <= 4 * _EPS * norm:
            break
        x = clear(_solved(v, shift, x, norm))
    return float(x @ v @ x), x


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues, unit eigenvectors as columns): the ``most`` largest of ``v``."""
    dim = len(v)
    most = min(most, dim)
    norm = float(np.abs(v).sum(axis=1).max(initial=0.0))
    values, vectors = np.zeros(most), np.zeros((dim, most))
    if not norm:
        return values, np.eye(dim)[:, :most]
    slices = Slices(v)
    near = 8 * dim * _EPS * norm  # what rounding may do to a count
    starts = np.random.default_rng(1).standard_normal((dim, dim))
    number = 1
    while number <= most:
        low, high = slices.around(number)
        inside = slices.count(low) - slices.count(high)
        if inside > 1 and high - low > GROUP_GAP * norm:
            slices.bisect(number)
            continue
        # One eigenvalue, or a group that is one to double precision.
        group_first = slices.count(high) + 1
        taken = vectors[:, group_first - 1 : number - 1] if inside > 1 else vectors[:, :0]
        value, x = _iterated(v, low, high, starts[:, number - 1], taken, norm)
        if inside > 1:
            value = min(max(value, low), high)
        good = np.linalg.norm(v @ x - value * x) <= max(64 * dim * _EPS * norm, GROUP_GAP * norm if inside > 1 else 0.0)
        certified = inside > 1 or (low <= value <= high and slices.count(value - near) >= number and slices.count(value + near) < number)
        if not (good and certified) and high - low > near:
            slices.bisect(number)
            continue
        values[number - 1], vectors[:, number - 1] = value, x
        number += 1
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]
