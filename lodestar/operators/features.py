"""Fact-layer flags and ratios.

Every time-dependent flag takes an explicit ``as_of`` date instead of the
current date, so a rebuild reproduces the stored history.  Flags are never
NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import safe_ratio
from ..functions.geo import within_radius


def as_date(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def add_fact_flags(df: DataFrame, as_of, *, created: str = "dim_created_date",
                   removed: str = "dim_removed_date", year_built: str = "met_year_built",
                   stale_days: int = 90) -> DataFrame:
    """is_active (not removed), is_new_construction (built in or after last
    year), is_stale (created more than ``stale_days`` ago and not removed)."""
    d = as_date(as_of)
    active = F.col(removed).isNull()
    return df.withColumns({
        "is_active": _flag(active),
        "is_new_construction": _flag(F.col(year_built) >= F.year(d) - 1),
        "is_stale": _flag((F.date_diff(d, F.col(created)) > stale_days) & active),
    })


def add_target_flag(df: DataFrame, as_of, *, zip_value: str, centre_lon: float,
                    centre_lat: float, radius_m: float = 3000.0, zip_col: str = "dim_zip",
                    lon: str = "info_longitude", lat: str = "info_latitude",
                    name: str = "is_target", **flag_args) -> DataFrame:
    """Target = given zip, within ``radius_m`` of a fixed point, not stale.
    Reuses ``is_stale`` when present."""
    if "is_stale" not in df.columns:
        df = add_fact_flags(df, as_of, **flag_args)
    near = within_radius(F.lit(centre_lon), F.lit(centre_lat), F.col(lon), F.col(lat), radius_m)
    return df.withColumn(
        name, _flag((F.col(zip_col) == F.lit(zip_value)) & near & ~F.col("is_stale")))


def add_fact_metrics(df: DataFrame, as_of, *, bathrooms: str = "met_bathrooms",
                     bedrooms: str = "met_bedrooms", price: str = "met_price",
                     square_feet: str = "met_square_feet",
                     year_built: str = "met_year_built") -> DataFrame:
    """Bath/bed ratio, home age in years, price per square foot; a zero
    divisor gives NULL."""
    d = as_date(as_of)
    return df.withColumns({
        "met_bath_to_bed_ratio": safe_ratio(bathrooms, bedrooms),
        "met_home_age_years": F.year(d).cast("long") - F.col(year_built),
        "met_price_per_sqft": safe_ratio(price, square_feet),
    })
