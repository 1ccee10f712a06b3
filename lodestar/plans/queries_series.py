"""Registered queries: weekly series family (flagship and its parts)."""

from __future__ import annotations

from functools import lru_cache

from ..operators import series as S
from ..operators.features import add_fact_flags, add_fact_metrics, add_target_flag
from . import oracle as O
from .chain import MA_WINDOWS, PRIOR, build_series, series_base, with_moving_averages
from .registry import register, rounded
from .standins import (AS_OF, TARGET_LAT, TARGET_LON, TARGET_RADIUS_M, TARGET_ZIP, listings)

SQFT_ROUND = {"met_price_per_sqft_avg": 6}
SQFT_ROUND_SQL = "round(met_price_per_sqft_avg, 6) AS met_price_per_sqft_avg"


@lru_cache(maxsize=64)
def fact_rows(spark, sf_dir):
    """Stand-in listings with flags and ratios (no comps)."""
    f = add_fact_flags(listings(spark, sf_dir), AS_OF)
    f = add_target_flag(f, AS_OF, zip_value=TARGET_ZIP, centre_lon=TARGET_LON,
                        centre_lat=TARGET_LAT, radius_m=TARGET_RADIUS_M)
    return add_fact_metrics(f, AS_OF)


def market_series_df(spark, sf_dir):
    return rounded(build_series(fact_rows(spark, sf_dir), segment_col="is_urgent"), SQFT_ROUND)


_SERIES_COLS = ", ".join(["dim_collected_date", "is_target_segment", "met_listings_count",
                          "met_price_avg", "met_price_median", SQFT_ROUND_SQL,
                          "met_price_per_sqft_median"])
_ALL_SERIES = _SERIES_COLS + ", " + ", ".join(
    list(MA_WINDOWS) + list(PRIOR.values())
    + ["is_macd_cross_down", "is_macd_cross_up", "is_yoy_cross_down", "is_yoy_cross_up"])


@register("market_series", O.with_(*O.SERIES_CHAIN, select=f"SELECT {_ALL_SERIES} FROM series"))
def market_series(spark, sf_dir):
    """Flagship (P3): fact -> weekly series with MAs, YoY and crossovers."""
    return market_series_df(spark, sf_dir)


@register("grouping_sets_series", O.with_(*O.SERIES_CHAIN[:5], select=f"SELECT {_SERIES_COLS} FROM ts"))
def grouping_sets_series(spark, sf_dir):
    """Overall and per-segment rows in one aggregation pass."""
    return rounded(series_base(fact_rows(spark, sf_dir), segment_col="is_urgent"), SQFT_ROUND)


@register("approx_median", O.with_(*O.FACT_CHAIN, select="""
  SELECT dim_collected_date, quantile_disc(met_price, 0.5) AS met_price_median,
         quantile_disc(met_price_per_sqft, 0.5) AS met_price_per_sqft_median,
         quantile_disc(met_bath_to_bed_ratio, 0.5) AS met_bath_to_bed_median
  FROM facts GROUP BY dim_collected_date"""))
def approx_median(spark, sf_dir):
    """D3: sketch median per week (lower middle value, NULLs skipped)."""
    return S.grouped_metrics(fact_rows(spark, sf_dir), ["dim_collected_date"], medians={
        "met_price_median": "met_price", "met_price_per_sqft_median": "met_price_per_sqft",
        "met_bath_to_bed_median": "met_bath_to_bed_ratio"})


@register("moving_averages", O.with_(*O.SERIES_CHAIN[:6], select="""
  SELECT dim_collected_date, is_target_segment, met_price_median,
         met_04_week_ma, met_12_week_ma, met_52_week_ma FROM ma"""))
def moving_averages(spark, sf_dir):
    """4/12/52-row trailing means of the weekly median."""
    ts = series_base(fact_rows(spark, sf_dir), segment_col="is_urgent")
    return with_moving_averages(ts).select("dim_collected_date", "is_target_segment",
                                           "met_price_median", *MA_WINDOWS)


@register("ma_crossover", O.with_(*O.SERIES_CHAIN, select="""
  SELECT dim_collected_date, is_target_segment, met_12_week_ma, met_52_week_ma,
         is_macd_cross_down, is_macd_cross_up FROM series"""))
def ma_crossover(spark, sf_dir):
    """short/long moving-average crosses."""
    ts = with_moving_averages(series_base(fact_rows(spark, sf_dir), segment_col="is_urgent"))
    out = S.crossover(ts, "met_12_week_ma", "met_52_week_ma", "is_target_segment",
                      "dim_collected_date", down="is_macd_cross_down", up="is_macd_cross_up")
    return out.select("dim_collected_date", "is_target_segment", "met_12_week_ma",
                      "met_52_week_ma", "is_macd_cross_down", "is_macd_cross_up")


@register("yoy_self_join", O.with_(*O.SERIES_CHAIN[:7], select="""
  SELECT dim_collected_date, is_target_segment, met_04_week_ma, met_12_week_ma,
         met_prior_04_week_ma, met_prior_12_week_ma, met_prior_52_week_ma FROM yoy"""))
def yoy_self_join(spark, sf_dir):
    """Left self-join to the same segment exactly 52 weeks earlier."""
    ts = with_moving_averages(series_base(fact_rows(spark, sf_dir), segment_col="is_urgent"))
    out = S.yoy_join(ts, "is_target_segment", "dim_collected_date", PRIOR)
    return out.select("dim_collected_date", "is_target_segment", "met_04_week_ma",
                      "met_12_week_ma", *PRIOR.values())


@register("yoy_crossover", O.with_(*O.SERIES_CHAIN, select="""
  SELECT dim_collected_date, is_target_segment, met_12_week_ma, met_prior_04_week_ma,
         is_yoy_cross_down, is_yoy_cross_up FROM series"""))
def yoy_crossover(spark, sf_dir):
    """12-week average against last year's 4-week average, lags taken
    over the joined rows."""
    s = market_series_df(spark, sf_dir)
    return s.select("dim_collected_date", "is_target_segment", "met_12_week_ma",
                    "met_prior_04_week_ma", "is_yoy_cross_down", "is_yoy_cross_up")

