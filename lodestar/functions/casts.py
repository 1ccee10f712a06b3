"""Safe casts: a bad value becomes NULL, never an error (ANSI mode safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def safe_cast(c, data_type: str) -> Column:
    """``try_cast``: NULL instead of a cast error."""
    return as_col(c).try_cast(data_type)


def parse_date(c, fmt: str = "yyyyMMdd") -> Column:
    """Text (or number) in ``fmt`` to DATE; unreadable values become NULL."""
    return F.try_to_date(as_col(c).try_cast("string"), fmt)


def safe_date(c) -> Column:
    """Date or timestamp text cast straight to DATE; NULL when unreadable."""
    return as_col(c).try_cast("date")


def safe_ratio(num, den) -> Column:
    """``num / nullif(den, 0)`` as a double; zero or NULL divisor gives NULL."""
    return as_col(num).cast("double") / F.nullif(as_col(den).cast("double"), F.lit(0.0))


def exact_mean(c) -> Column:
    """Mean as ``sum / count``. For integer inputs the sum is exact, so the
    result is one correctly rounded division, independent of partitioning."""
    return F.sum(c).cast("double") / F.count(c)
