"""Date helpers. The reference date is always an argument: no function reads the clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _day(d) -> Column:
    if isinstance(d, dt.date):
        return F.lit(d.isoformat()).cast("date")
    return _c(d)


def parse_date(x, fmt: str = "yyyy-MM-dd") -> Column:
    """Date from text; text that does not fit becomes null."""
    return F.try_to_timestamp(_c(x), F.lit(fmt)).cast("date")


def parse_mixed(x, formats: Sequence[str] = ("yyyy-MM-dd", "MM/dd/yyyy", "MM-dd-yyyy")) -> Column:
    """First format that fits wins; junk becomes null."""
    return F.coalesce(*[parse_date(x, f) for f in formats])


def days_since(reference, x) -> Column:
    return F.datediff(_day(reference), _c(x))


def days_late(paid, due) -> Column:
    return F.greatest(F.datediff(_c(paid), _c(due)), F.lit(0))


def delay_status(days) -> Column:
    """Bands: on time, minor delay to 15 days, late to 30, beyond that severe."""
    d = _c(days)
    return (
        F.when(d <= 0, "On Time")
        .when(d <= 15, "Minor Delay")
        .when(d <= 30, "Late")
        .when(d > 30, "Severely Delinquent")
    )


def payment_status(days) -> Column:
    d = _c(days)
    return F.when(d <= 0, "On Time").when(d <= 30, "Late").when(d > 30, "Severely Delinquent")


def age_months(reference, start) -> Column:
    """Difference of calendar months, ignoring the day of month."""
    r, s = _day(reference), _c(start)
    return (F.year(r) - F.year(s)) * 12 + (F.month(r) - F.month(s))


def age_years(reference, start, digits: int = 1) -> Column:
    return F.bround(days_since(reference, start) / F.lit(365.0), digits)


def month_key(x) -> Column:
    return F.date_format(_c(x), "yyyy-MM")


def long_date(x) -> Column:
    return F.date_format(_c(x), "MMMM dd, yyyy")
