"""Arithmetic on columns with the rounding, division and overflow rules of tabular risk work."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(numerator, denominator) -> Column:
    """Plain ratio, null where the denominator is zero or missing."""
    return F.try_divide(_c(numerator), _c(denominator))


def ratio_or(numerator, denominator, default: float = 0.0) -> Column:
    """Ratio with a default where the denominator is zero; missing inputs stay missing."""
    num, den = _c(numerator), _c(denominator)
    return F.when(den == 0, F.lit(float(default))).otherwise(F.try_divide(num, den))


def ratio_or_inf(numerator, denominator) -> Column:
    """Ratio with 0/0 = 0 and x/0 = infinity."""
    num, den = _c(numerator), _c(denominator)
    return (
        F.when((den == 0) & (num == 0), F.lit(0.0))
        .when(den == 0, F.lit(float("inf")))
        .otherwise(F.try_divide(num, den))
    )


def round_half_even(x, digits: int = 0) -> Column:
    """Banker's rounding; negative digits round to tens, hundreds, ..."""
    return F.bround(_c(x), digits)


def floor_div(a, b) -> Column:
    """Quotient rounded towards minus infinity (SQL integer division truncates instead)."""
    return F.floor(F.try_divide(_c(a), _c(b)))


def floor_mod(a, b) -> Column:
    """Remainder with the sign of the divisor, for positive divisors."""
    return F.pmod(_c(a), _c(b))


def clip(x, low=None, high=None) -> Column:
    """Bound values; nulls stay null."""
    out = _c(x)
    if low is not None:
        out = F.when(out < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(high)).otherwise(out)
    return out


def nan_to_num(x, nan: float = 0.0, posinf: float = 1e6, neginf: float = -1e6) -> Column:
    """Replace NaN and the infinities by numbers."""
    col = _c(x)
    return (
        F.when(F.isnan(col), F.lit(nan))
        .when(col == float("inf"), F.lit(posinf))
        .when(col == float("-inf"), F.lit(neginf))
        .otherwise(col)
    )


def nan_to_null(x) -> Column:
    col = _c(x)
    return F.when(~F.isnan(col), col)


def narrow_int(x) -> Column:
    """Down-cast to 32 bits; values that do not fit become null instead of wrapping."""
    return _c(x).try_cast("int")


def simple_interest(principal, rate_pct) -> Column:
    return _c(principal) * _c(rate_pct) / F.lit(100.0)


def compound_amount(principal, rate, periods) -> Column:
    return _c(principal) * F.pow(F.lit(1.0) + _c(rate), _c(periods))


def linear_score(terms: dict[str, float] | list[tuple[Column, float]]) -> Column:
    """Weighted sum of columns."""
    items = terms.items() if isinstance(terms, dict) else terms
    return reduce(lambda a, b: a + b, [_c(c) * F.lit(float(w)) for c, w in items])


def close_to(a, b, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """|a - b| <= atol + rtol * |b|, the usual floating-point tolerance test."""
    a, b = _c(a), _c(b)
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
