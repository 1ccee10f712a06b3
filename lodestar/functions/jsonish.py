"""Nested values stored as Python ``str()`` text, and JSON extraction
(S4-S6, H3-H5).

``compat`` repeats the reference repair exactly: the blind replaces
``'`` -> ``"`` and ``None`` -> ``null``, then a safe parse; apostrophes in
values or ``True``/``False`` make it NULL, as there.
``strict`` parses the Python literal exactly.  When a text holds no double
quote, backslash or parenthesis, every string is delimited by single
quotes, so a ``None``/``True``/``False`` token lies outside all strings
exactly when an even number of quotes follows it: those rows are rewritten
on the JVM (one regex lookahead, then the quote swap).  Only the remaining
rows go through an Arrow-batched pandas UDF with ``ast.literal_eval``.
"""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import as_col


def compat_text(c) -> Column:
    """The reference's blind text repair (no parse)."""
    return F.replace(F.replace(as_col(c), F.lit("'"), F.lit('"')), F.lit("None"), F.lit("null"))


@F.pandas_udf(T.StringType())
def _literal_to_json(s: pd.Series) -> pd.Series:
    def conv(v):
        if v is None:
            return None
        try:
            return json.dumps(ast.literal_eval(v), allow_nan=False)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None
    return s.map(conv)


_TOKENS = (("None", "null"), ("True", "true"), ("False", "false"))


def strict_text(c) -> Column:
    """Exact JSON text for a Python literal (NULL if it is not one)."""
    x = as_col(c)
    simple = ~x.rlike(r"[\"\\()]|\b(nan|inf)\b")

    def rewritten(part: Column, i: Column) -> Column:  # every second part lies outside quotes
        out = part
        for word, js in _TOKENS:
            out = F.regexp_replace(out, r"\b" + word + r"\b", js)
        return F.when(i % 2 == 0, out).otherwise(part)

    fast = F.array_join(F.transform(F.split(x, "'"), rewritten), '"')
    # Spark runs a Python function on every row: simple ones reach it as NULL
    hard = _literal_to_json(F.when(~simple, x))
    return F.when(simple, fast).otherwise(hard)


def pydict_to_json(c, mode: str = "compat") -> Column:
    """Python-repr text -> VARIANT (NULL when it does not parse)."""
    text = compat_text(c) if mode == "compat" else strict_text(c)
    return F.try_parse_json(text)


def repaired_text(c, repair: str | None = "compat") -> Column:
    """Nested text as JSON text, by the named repair."""
    x = as_col(c)
    if repair == "compat":
        return compat_text(x)
    return strict_text(x) if repair == "strict" else x


def json_scalar(c, path: str, *, repair: str | None = "compat") -> Column:
    """``json_extract_scalar``: the scalar at ``path`` as text; objects and
    arrays give NULL.  Python-repr input is repaired first (a bare ``None``
    anywhere would otherwise void every key).

    The text is parsed once into a VARIANT (shared by every field read from
    the same column through common-subexpression elimination); a failed
    parse is NULL, not an exception per row."""
    return variant_scalar(repaired_variant(c, repair), path)


def repaired_variant(c, repair: str | None = "compat") -> Column:
    """Parse (repaired) text once into a VARIANT; NULL when invalid."""
    return F.try_parse_json(repaired_text(c, repair))


def variant_scalar(v, path: str) -> Column:
    """Scalar at ``path`` of a VARIANT as text; objects/arrays give NULL.
    Their JSON begins with a bracket, so only a value that does is looked up
    again by its type."""
    v = as_col(v)
    s = F.try_variant_get(v, path, "string")
    nested = (F.try_variant_get(v, path, "map<string,variant>").isNotNull()
              | F.try_variant_get(v, path, "array<variant>").isNotNull())
    return F.when(~(s.startswith("{") | s.startswith("[")), s).when(~nested, s)
