"""Wide <-> long reshaping with the naming rules of the reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_metrics(df: DataFrame, ids: list[str], metrics: list[str], *,
                    name_col: str = "dim_metric_name", value_col: str = "met_metric_value",
                    drop_nulls: bool = True) -> DataFrame:
    """Metrics (cast to double) to (name, value) rows.  ``DataFrame.unpivot``
    keeps NULL values, SQL ``UNPIVOT`` drops them; the default drops them."""
    cast = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    long = cast.unpivot(ids, metrics, name_col, value_col)
    return long.where(F.col(value_col).isNotNull()) if drop_nulls else long


def pivot_wide(df: DataFrame, ids: list[str], name_col: str, values: list[str],
               aggs: dict[str, str], agg_fn=F.max) -> DataFrame:
    """One column per (aggregate, listed value), named ``<alias>_<value>``.

    The value list is given, so Spark runs no extra job to find it; Spark's
    own ``<value>_<alias>`` names are renamed."""
    out = df.groupBy(*ids).pivot(name_col, values).agg(
        *[agg_fn(src).alias(alias) for alias, src in aggs.items()])
    single = len(aggs) == 1
    return out.select(*ids, *[
        F.col(f"`{v}`" if single else f"`{v}_{a}`").alias(f"{a}_{v}")
        for a in aggs for v in values])
