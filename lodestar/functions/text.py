"""Text normalisation and presentation formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def normalise_text(c, case: str = "lower") -> Column:
    """``lower``/``upper`` after a safe cast to string."""
    s = as_col(c).try_cast("string")
    return F.upper(s) if case == "upper" else F.lower(s)


def split_trim(c, sep: str = ",") -> Column:
    """Split on a literal separator and trim every part (array column)."""
    return F.transform(F.split(as_col(c), _regex_quote(sep)), lambda x: F.trim(x))


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in s)


def currency_text(c, missing: str = "Unknown") -> Column:
    """``$1,234`` with no decimals; NULL becomes ``missing``."""
    x = as_col(c)
    return F.when(x.isNull(), F.lit(missing)).otherwise(
        F.concat(F.lit("$"), F.format_number(x.cast("double"), 0)))


def thousands_text(c) -> Column:
    """``$450k``: value / 1000 with thousands separators and no decimals."""
    return F.concat(F.lit("$"), F.format_number(as_col(c).cast("double") / 1000.0, 0), F.lit("k"))


def date_text(c, pattern: str = "MMM dd, yyyy", missing: str = "Unknown") -> Column:
    """Date as display text, e.g. ``Mar 05, 2024``."""
    return F.coalesce(F.date_format(as_col(c).try_cast("date"), pattern), F.lit(missing))


def fill_text(c, value: str) -> Column:
    return F.coalesce(as_col(c), F.lit(value))
