"""Column expressions for the rating formulas.

All are plain Catalyst expressions, so they stay inside whole-stage codegen.

    scale(x, a)   = hi - a  if x > a ;  a - lo  if x < a ;  1  if x = a
    dev(r, a)     = (r - a) / scale(r, a)
    predict(a, d) = a + d * scale(a + d, a)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rating scale's bounds (ratings are 1..5).
RATING_LO = 1.0
RATING_HI = 5.0

# Digits kept when a similarity is used as an ordering key or tested for zero,
# and digits of every reported double.
RANK_DIGITS = 9
OUT_DIGITS = 6


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def scale(x, avg, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    x, avg = _c(x), _c(avg)
    return (F.when(x > avg, F.lit(hi) - avg)
             .when(x < avg, avg - F.lit(lo))
             .otherwise(F.lit(1.0)))


def deviation(rating, avg, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    rating, avg = _c(rating), _c(avg)
    return (rating - avg) / scale(rating, avg, lo, hi)


def predict_from(avg, d, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    avg, d = _c(avg), _c(d)
    return avg + d * scale(avg + d, avg, lo, hi)


def safe_ratio(num, den, default: float = 0.0) -> Column:
    """num / den, or ``default`` where den is 0 or null (ANSI-safe)."""
    num, den = _c(num), _c(den)
    return F.when(den.isNotNull() & (den != 0), num / den).otherwise(F.lit(default))


def round_half_up(x, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` in plain IEEE double arithmetic, so
    any engine evaluating the same formula on the same double agrees to the
    bit (decimal-string rounding differs between engines at exact halves)."""
    p = float(10 ** digits)
    return F.floor(_c(x) * F.lit(p) + F.lit(0.5)) / F.lit(p)


def rank_key(sim) -> Column:
    """Similarity as an ordering key: rounded so that summation-order noise
    cannot reorder neighbours or turn a zero into a non-zero."""
    return round_half_up(sim, RANK_DIGITS)


def out(x) -> Column:
    return round_half_up(x, OUT_DIGITS)
