"""Two-sample Kolmogorov-Smirnov p-value (two-sided) - a scalar finaliser.

Applied to the (D, n1, n2) triple that the distributed KS statistic
produces; it never sees rows. Exact when max(n1, n2) <= 10 000: the
probability that a uniformly random lattice path from (0, 0) to (n1, n2)
touches |i/n1 - j/n2| >= D, computed by a forward recursion along
anti-diagonals (Hodges 1957). Above that, the finite-n distribution of the
one-sample statistic at n = round(n1 n2 / (n1 + n2)).
"""
from __future__ import annotations

import math

import numpy as np

from kindling import config as C


def exact_pvalue(d: float, n1: int, n2: int) -> float:
    if d <= 0:
        return 1.0
    g = math.gcd(n1, n2)
    a, b = n2 // g, n1 // g          # |i/n1 - j/n2| >= D  <=>  |i*a - j*b| >= h
    h = round(d * (n1 // g) * n2)
    total = n1 + n2
    # q[i] = probability of standing at (i, k - i) on anti-diagonal k without
    # having crossed; entries off the current diagonal are zero or stale-but-
    # unused, so each step touches only the live slice [lo, hi].
    q = np.zeros(n1 + 2)
    q[0] = 1.0
    i_all = np.arange(n1 + 1, dtype=np.int64)
    outside = 0.0
    for k in range(1, total + 1):
        lo, hi = max(0, k - n2), min(n1, k)
        i = i_all[lo:hi + 1]
        j = k - i
        rem = total - k + 1
        from_x = np.empty(hi - lo + 1)
        if lo == 0:
            from_x[0] = 0.0
            from_x[1:] = q[0:hi] * (n1 - i[1:] + 1)
        else:
            from_x[:] = q[lo - 1:hi] * (n1 - i + 1)
        from_y = q[lo:hi + 1] * (n2 - j + 1)
        if hi == k:                  # point (k, 0): no step in y leads there
            from_y[-1] = 0.0
        new = (from_x + from_y) / rem
        cross = np.abs(i * a - j * b) >= h
        if cross.any():
            outside += float(new[cross].sum())
            new[cross] = 0.0
        q[lo:hi + 1] = new
    return min(1.0, max(0.0, outside))


def _one_sample_exact(d: float, n: int) -> float:
    """P(D_n >= d) of one sample of n, by powers of the transition matrix of the
    path between its two boundaries (Durbin 1973; Marsaglia, Tsang, Wang 2003)."""
    k = int(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    step = np.tril(np.ones((m, m)), 1)
    power = h ** np.arange(1, m + 1)
    step[:, 0] -= power
    step[-1, :] -= power[::-1]
    step[-1, 0] += max(0.0, 2 * h - 1) ** m
    lag = np.subtract.outer(np.arange(m), np.arange(m)) + 1
    fact = np.cumprod(np.concatenate(([1.0], np.arange(1, m + 1))))
    with np.errstate(over="ignore", invalid="ignore"):
        step = np.where(lag > 0, step / fact[np.clip(lag, 0, m)], step)
    result, exponent = np.eye(m), 0
    shift, e = 0, n
    while e:
        if e & 1:
            result, exponent = result @ step, exponent + shift
        step, shift = step @ step, 2 * shift
        for name in ("result", "step"):   # keep both within range, counting powers of two
            mat = result if name == "result" else step
            top = mat[k - 1, k - 1]
            by = 400 if top > 1e140 else -400 if 0 < top < 1e-140 else 0
            if by:
                if name == "result":
                    result, exponent = mat * 2.0 ** -by, exponent + by
                else:
                    step, shift = mat * 2.0 ** -by, shift + by
        e >>= 1
    if result[k - 1, k - 1] <= 0:   # no path stays inside
        return 1.0
    inside = math.log(result[k - 1, k - 1]) + exponent * math.log(2) + math.lgamma(n + 1) - n * math.log(n)
    return min(1.0, max(0.0, -math.expm1(min(0.0, inside))))


def _one_sample_series(d: float, n: int) -> float:
    """P(D_n >= d) by the limit and its corrections up to 1/n (Pelz, Good 1976)."""
    z = math.sqrt(n) * d
    half = (np.arange(-40, 40) + 0.5) ** 2 * math.pi ** 2
    whole = np.arange(-40, 41) ** 2 * math.pi ** 2
    at, at_whole = np.exp(-half / (2 * z * z)), np.exp(-whole / (2 * z * z))
    root = math.sqrt(math.pi / 2)
    k0 = root / z * at.sum()
    k1 = root / (6 * z ** 4) * ((half - z * z) * at).sum()
    k2 = (root / (72 * z ** 7) * ((6 * z ** 6 + 2 * z ** 4 + (2 * z ** 4 - 5 * z * z) * half + (1 - 2 * z * z) * half ** 2) * at).sum()
          - root / (36 * z ** 3) * (whole * at_whole).sum())
    return float(min(1.0, max(0.0, 1 - (k0 + k1 / math.sqrt(n) + k2 / n))))   # not NumPy's, which no row can hold


def _one_sided(d: float, n: int) -> float:
    """P(D_n+ >= d): Smirnov's sum, in logs; its limit for very large n."""
    if n > 1_000_000:
        return math.exp(-((6 * n * d + 1) ** 2) / (18 * n))
    j = np.arange(int(n * (1 - d)) + 1)
    low, high = d + j / n, 1 - d - j / n
    ok = high > 0
    j, low, high = j[ok], low[ok], high[ok]
    log_fact = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, n + 1)))))
    terms = log_fact[n] - log_fact[j] - log_fact[n - j] + (j - 1) * np.log(low) + (n - j) * np.log(high)
    return float(min(1.0, d * np.exp(terms).sum()))


def one_sample_sf(d: float, n: int) -> float:
    """P(D_n >= d) for the two-sided statistic of one sample of n."""
    if d <= 0 or n * d <= 0.5:
        return 1.0
    if d >= 1:
        return 0.0
    if n * d * d >= 4:
        return min(1.0, 2 * _one_sided(d, n))   # both sides at once: below 1e-14
    return _one_sample_exact(d, n) if n <= 10_000 else _one_sample_series(d, n)


def ks_pvalue(d: float, n1: int, n2: int) -> float:
    """p-value of the two-sample statistic; NaN if a side is empty."""
    if d is None or n1 is None or n2 is None or n1 == 0 or n2 == 0:
        return float("nan")
    n1, n2 = int(n1), int(n2)
    if max(n1, n2) <= C.KS_EXACT_MAX_N:
        return exact_pvalue(float(d), n1, n2)
    return one_sample_sf(float(d), round(n1 * n2 / (n1 + n2)))
