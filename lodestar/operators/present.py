"""Presentation frames read from the result tables (B12-B19, D10-D13,
F1-F4, H20-H25).  Filters run on Spark before anything reaches the
driver; only display-sized results are ever collected, by the caller."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import currency_text, date_text, fill_text, thousands_text


def _d(v):
    return F.lit(str(v)).cast("date")


def trend_filter(trends: DataFrame, start, end=None, *, segment: str | None = "true",
                 date_col: str = "dim_collected_date",
                 segment_col: str = "is_target_segment") -> DataFrame:
    """Inclusive date range (a single date means that day) and, if the
    column exists, segment ``'true'``/``'all'`` compared case-insensitively;
    oldest first."""
    end = start if end is None else end
    out = trends.where(F.col(date_col).cast("date").between(_d(start), _d(end)))
    if segment is not None and segment_col in trends.columns:
        out = out.where(F.lower(F.col(segment_col).cast("string")) == F.lit(segment.lower()))
    return out.orderBy(date_col)


def recent_listings(listings: DataFrame, as_of, *, days: int = 28, start=None, end=None,
                    target_homes: bool = True, listed_col: str = "dim_listed_date",
                    target_col: str = "is_target") -> DataFrame:
    """Listed between ``as_of - days`` and ``as_of`` (inclusive) unless a
    range is given; unreadable dates drop out.  Target homes only when
    asked and when the column exists."""
    lo = _d(start) if start is not None else F.date_sub(_d(as_of), days)
    hi = _d(end) if end is not None else _d(as_of)
    out = listings
    if listed_col in listings.columns:
        out = out.where(F.col(listed_col).try_cast("date").between(lo, hi))
    if target_homes and target_col in listings.columns:
        out = out.where(F.col(target_col) == F.lit(True))
    return out


def kpi_summary(trends: DataFrame, listings: DataFrame, *, date_col: str = "dim_collected_date",
                median: str = "met_price_median", ma4: str = "met_04_week_ma",
                anomaly_flag: str = "is_price_median_anomaly") -> DataFrame:
    """Long table (kpi, value, display): latest median and 4-week average
    (0 when there is no trend row), number of listings, number of flagged
    anomalies.  Two one-row aggregates unioned, no join."""
    last = lambda c: F.coalesce(F.max_by(F.col(c).cast("double"), F.col(date_col)), F.lit(0.0))
    flag = (F.count_if(F.col(anomaly_flag)) if anomaly_flag in trends.columns else F.lit(0)).cast("double")
    t = trends.agg(last(median).alias("m"), last(ma4).alias("a"), flag.alias("n"))
    rows = F.array(
        F.struct(F.lit("latest_median").alias("kpi"), F.col("m").alias("value"),
                 thousands_text(F.col("m")).alias("display")),
        F.struct(F.lit("latest_4_week_avg").alias("kpi"), F.col("a").alias("value"),
                 thousands_text(F.col("a")).alias("display")),
        F.struct(F.lit("anomalies").alias("kpi"), F.col("n").alias("value"),
                 F.format_number(F.col("n"), 0).alias("display")))
    k1 = t.select(F.explode(rows).alias("k")).select("k.*")
    k2 = listings.agg(F.count("*").cast("double").alias("value")).select(
        F.lit("listings").alias("kpi"), "value", F.format_number("value", 0).alias("display"))
    return reduce(DataFrame.unionByName, [k1, k2])


def date_bounds(trends: DataFrame, date_col: str = "dim_collected_date",
                default_start: str = "2024-01-01", default_end: str = "2024-12-31") -> DataFrame:
    """First and last date, or the defaults when there is no row."""
    return trends.agg(F.coalesce(F.min(F.col(date_col).cast("date")), _d(default_start)).alias("min_date"),
                      F.coalesce(F.max(F.col(date_col).cast("date")), _d(default_end)).alias("max_date"))


def map_points(listings: DataFrame, *, lat: str = "info_latitude", lon: str = "info_longitude",
               price: str = "met_price", listed: str = "dim_listed_date",
               street: str = "info_street1") -> DataFrame:
    """Rows with both coordinates, renamed for a map, with display text for
    price, listed date and address."""
    if lat not in listings.columns:
        return listings.limit(0)
    out = listings.na.drop(subset=[lat, lon]).withColumnsRenamed({lat: "latitude", lon: "longitude"})
    cols = {"price_formatted": currency_text(F.col(price)) if price in out.columns else F.lit("Unknown"),
            "listed_date_str": date_text(F.col(listed)) if listed in out.columns else F.lit("Unknown"),
            "address_str": fill_text(F.col(street), "Unknown Address") if street in out.columns
            else F.lit("Unknown Address")}
    return out.withColumns(cols)


def map_centre(points: DataFrame) -> DataFrame:
    return points.agg(F.avg("latitude").alias("centre_lat"), F.avg("longitude").alias("centre_lon"))


def distinct_dates(trends: DataFrame, date_col: str = "dim_collected_date") -> DataFrame:
    return trends.select(date_col).distinct()


def inventory_by_ratio(listings: DataFrame, ratio: str = "met_price_vs_comps_ratio", *,
                       tie_break: list[str] | None = None, n: int | None = None) -> DataFrame:
    """Sorted by ratio ascending, missing ratios last; ``n`` makes it a
    top-n report (per-partition top-n, then a merge)."""
    order = ([F.col(ratio).asc_nulls_last()] if ratio in listings.columns else []) + \
        [F.col(c).asc() for c in (tie_break or [])]
    out = listings.orderBy(*order) if order else listings
    return out.limit(n) if n else out


def latest_trend_row(trends: DataFrame, *, segment_col: str = "is_target_segment",
                     date_col: str = "dim_collected_date", cols: list[str] | None = None) -> DataFrame:
    """The newest row of each segment (max_by: partial aggregation, no sort)."""
    cols = cols or [c for c in trends.columns if c not in (segment_col,)]
    row = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(date_col))
    return trends.groupBy(segment_col).agg(row.alias("r")).select(
        segment_col, *[F.col("r")[c].alias(c) for c in cols])
