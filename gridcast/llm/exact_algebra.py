"""Exact linear algebra on one small integer matrix, for the whitening: the
characteristic polynomial modulo primes, its real roots and null spaces.

The matrix has as many rows as the vectors have dimensions; nothing here grows with
the number of vectors. Numbers are Python integers; a fraction stands as an integer and
a power of two.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, isqrt, prod

import numpy as np

ROOT_BITS = 128  # bits of an eigenvalue; closer ones count as one of higher multiplicity
FIXED = 384  # bits of a number in the elimination
_WITNESSES = (2, 3, 5, 7)  # decide primality of every number below 3.2e9


def is_prime(n: int) -> bool:
    """Whether the odd number ``n`` below 3.2e9 is prime (strong pseudoprime test)."""
    if any(n % p == 0 for p in _WITNESSES):
        return n in _WITNESSES
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in _WITNESSES:
        x = pow(a, odd, n)
        if x in (1, n - 1):
            continue
        if not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """The largest primes below 2^31 whose product exceeds twice ``bound``."""
    out, n, whole = [], (1 << 31) - 1, 1
    while whole <= 2 * bound:
        if is_prime(n):
            out.append(n)
            whole *= n
        n -= 2
    return out


def coefficient_bound(matrix: np.ndarray) -> int:
    """No coefficient of the polynomial of a positive semi-definite matrix is larger:
    Maclaurin's inequality on the elementary symmetric functions of its eigenvalues."""
    d = len(matrix)
    mean = int(np.trace(matrix)) // d + 1
    return max(comb(d, k) * mean ** k for k in range(d + 1))


def charpoly_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(xI - matrix) modulo the prime ``p`` below 2^31, constant
    term first, by reduction to Hessenberg form."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for m in range(1, d - 1):
        at = np.flatnonzero(h[m:, m - 1])
        if not len(at):
            continue
        i = m + int(at[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):
        new = np.roll(polys[k], 1)  # the last place is still 0
        new = (new - int(h[k, k]) * polys[k] % p) % p
        t, factors = 1, []
        for i in range(k - 1, -1, -1):
            t = t * int(h[i + 1, i]) % p
            if not t:
                break
            factors.append((i, t * int(h[i, k]) % p))
        if factors:
            rows, f = (np.array(x, np.int64) for x in zip(*factors, strict=True))
            new = (new - (f[:, None] * polys[rows] % p).sum(axis=0)) % p
        polys[k + 1] = new
    return polys[d]


def chinese_remainder(residues: dict[int, list[int]]) -> list[int]:
    """The integers of least size with the given residues (a list per prime)."""
    whole = prod(residues)
    total = [0] * len(next(iter(residues.values())))
    for p, values in residues.items():
        rest = whole // p
        unit = rest * pow(rest, -1, p)
        total = [t + unit * int(v) for t, v in zip(total, values, strict=True)]
    total = [t % whole for t in total]
    return [t - whole if 2 * t > whole else t for t in total]


def roots_above(poly: list[int], m: int, t: int) -> int:
    """How many roots, by multiplicity, of a polynomial with real roots only exceed
    m / 2^t: the sign changes of its coefficients around that point (Budan and Fourier)."""
    d = len(poly) - 1
    c = [x << (t * (d - k)) for k, x in enumerate(poly)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += m * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def largest_roots(poly: list[int], k: int, bits: int = ROOT_BITS) -> Iterator[tuple[int, int, int]]:
    """The ``k`` largest positive roots of a polynomial with real, non-negative roots
    as ``(m, t, multiplicity)``: each is in ((m - 1) / 2^t, m / 2^t], isolated by
    bisection to ``bits`` bits. The last multiplicity may reach beyond ``k``."""
    z = next(i for i, x in enumerate(poly) if x)
    poly, found = poly[z:], 0
    top = max(1, -poly[-2]).bit_length() if len(poly) > 1 else 0  # no root exceeds their sum
    while found < min(k, len(poly) - 1):
        lo, hi, t = 0, 1 << top, 0
        while hi - lo > 1 or hi.bit_length() < bits:
            if hi - lo == 1:
                lo, hi, t = 2 * lo, 2 * hi, t + 1
            mid = (lo + hi) // 2
            if roots_above(poly, mid, t) > found:
                lo = mid
            else:
                hi = mid
        here = roots_above(poly, hi - 1, t) - found
        yield hi, t, here
        found += here


def _unit(v: np.ndarray) -> np.ndarray:
    return np.array([(int(x) << FIXED) // isqrt(int((v * v).sum())) for x in v], object)


def _orthonormal(vectors: list[np.ndarray]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for v in vectors:
        v = _unit(v)
        for _ in range(2):
            for u in out:
                v = v - (u * (int((u * v).sum()) >> FIXED) >> FIXED)
        out.append(_unit(v))
    return out


class _Elimination:
    """LU decomposition with complete pivoting in fixed-point integers; a pivot that
    vanishes counts as the least number that is not 0."""

    def __init__(self, a: np.ndarray):
        d = len(a)
        size = max(int(abs(x)).bit_length() for x in a.ravel())
        a = a * (1 << max(0, FIXED - size))
        self.rows, self.cols, self.low = list(range(d)), list(range(d)), np.zeros((d, d), object)
        for k in range(d):
            i, j = divmod(int(np.argmax(np.abs(a[k:, k:]))), d - k)
            i, j = i + k, j + k
            a[[i, k]], self.low[[i, k]] = a[[k, i]], self.low[[k, i]]
            a[:, [j, k]] = a[:, [k, j]]
            self.rows[i], self.rows[k] = self.rows[k], self.rows[i]
            self.cols[j], self.cols[k] = self.cols[k], self.cols[j]
            if not a[k, k]:
                a[k, k] = 1
            f = np.array([(int(x) << FIXED) // int(a[k, k]) for x in a[k + 1:, k]], object)
            self.low[k + 1:, k] = f
            if len(f):
                a[k + 1:, k:] -= (f[:, None] * a[k, k:]) >> FIXED
                a[k + 1:, k] = 0
        self.a = a

    def _up(self, y: np.ndarray, free: int = 0) -> np.ndarray:
        """Back substitution; the last ``free`` entries of ``y`` are given solutions."""
        d = len(y)
        for k in range(d - 1 - free, -1, -1):
            y[k] = ((int(y[k]) << FIXED) - int((self.a[k, k + 1:] * y[k + 1:]).sum())) // int(self.a[k, k])
        x = np.empty(d, object)
        x[self.cols] = y
        return x

    def null_vector(self, free: int, nth: int) -> np.ndarray:
        """The vector of the null space with a 1 at the ``nth`` of ``free`` last columns."""
        y = np.array([0] * len(self.a), object)
        y[len(y) - free + nth] = 1 << FIXED
        return self._up(y, free)

    def solve(self, b: np.ndarray) -> np.ndarray:
        y = b[self.rows]
        for k in range(1, len(y)):
            y[k] -= int((self.low[k, :k] * y[:k]).sum()) >> FIXED
        return self._up(y)


def eigenvectors(matrix: np.ndarray, m: int, t: int, multiplicity: int, rounds: int = 2) -> list[np.ndarray]:
    """Orthonormal vectors of the eigenvalue m / 2^t of a symmetric integer
    matrix: its null space by elimination, then inverse iteration."""
    d = len(matrix)
    shifted = matrix * (1 << t)
    shifted[np.arange(d), np.arange(d)] -= m
    lu = _Elimination(shifted)
    vectors = _orthonormal([lu.null_vector(multiplicity, i) for i in range(multiplicity)])
    for _ in range(rounds):
        vectors = _orthonormal([lu.solve(v) for v in vectors])
    out = []
    for v in vectors:
        x = np.array([int(i) / (1 << FIXED) for i in v])
        out.append(x * np.sign(x[np.argmax(np.abs(x))]))
    return out
