"""The series helpers by their formulas, over one Python list: the test oracle.

Every value is computed on its own from its definition (a prefix, an explicit
weight, a pair), never from the value before it.
"""

from __future__ import annotations

import math
import statistics
from itertools import accumulate, pairwise


def lsum(xs):
    return math.fsum(xs)


def lmean(xs):
    return statistics.fmean(xs) if xs else math.nan


def lstd(xs):
    if not xs:
        return math.nan
    return statistics.pstdev(xs) if all(map(math.isfinite, xs)) else math.nan


def cum_sum(xs):
    return list(accumulate(xs))


def ewm(xs, span):
    """y_t = b^t x_0 + sum over s = 1..t of a b^(t-s) x_s, with a = 2 / (1 + span), b = 1 - a."""
    a = 2.0 / (1.0 + span)
    b = 1.0 - a
    return [b**t * xs[0] + math.fsum(a * b ** (t - s) * xs[s] for s in range(max(1, t - 4000), t + 1)) if t else xs[0] for t in range(len(xs))]


def ewm_with_nulls(xs, span):
    """The mean over the values so far; None before the first."""
    out = []
    for t in range(len(xs)):
        known = [x for x in xs[: t + 1] if x is not None]
        out.append(ewm(known, span)[-1] if known else None)
    return out


def diff(xs):
    return [0.0 * xs[0], *(b - a for a, b in pairwise(xs))] if xs else []


def true_range(bars):
    """bars: list of (high, low, close)."""
    closes = [c for _, _, c in bars]
    return [max(h - lo, abs(h - p), abs(lo - p)) for (h, lo, _), p in zip(bars, closes[:1] + closes)]


def sliding(xs, size):
    return [xs[end - size : end] for end in range(size, len(xs) + 1)]


def expanding(xs):
    return [xs[:end] for end in range(len(xs) - 1)]


def change(old, new):
    """(new - old) / old as doubles divide."""
    if old:
        return (new - old) / old
    return math.nan if new == old else math.copysign(math.inf, new - old)


def returns(k, closes):
    return change(closes[-1 - k], closes[-1]) if len(closes) > k else 0.0


def signed_log(r):
    """The log of the size with the sign of the change; 0 stays 0."""
    sign = (r > 0) - (r < 0)
    return sign * math.log(abs(r)) if sign else r


def volatility(closes):
    """Population deviation of the signed logs of all one-step changes (NaN from a zero price)."""
    steps = [signed_log(change(a, b)) if a else math.nan for a, b in pairwise(closes)]
    return lstd(steps) if steps else 0.0
