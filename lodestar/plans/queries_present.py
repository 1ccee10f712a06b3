"""Registered queries: dashboard frames over the anomalies table and the
latest-listings table (P6)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from ..operators import present as P
from ..operators.snapshot import latest_per_key
from ..operators.spatial import add_comps_ratio
from . import oracle as O
from .queries_facts import COMPS_CHAIN, COMPS_KEYS
from .queries_models import _WIDE_R, anomaly_wide_rounded
from .queries_series import fact_rows
from ..session import scratch_path, stored
from ..sources.tables import rebuild_table
from .registry import register
from .standins import COMPS_RADIUS_M, RECENT_AS_OF

T0, T1 = "1997-01-01", "1998-12-31"
LATEST_SQL = """latest AS (
  SELECT * EXCLUDE (rn, comps_count, comps_avg) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY dim_collected_date DESC, listing_key DESC) AS rn
    FROM fact_table) WHERE rn = 1)"""
LIST_CHAIN = COMPS_CHAIN + [LATEST_SQL]
TREND_CHAIN = O.WIDE_CHAIN + [_WIDE_R]
BOTH_CHAIN = TREND_CHAIN + COMPS_CHAIN[len(O.FACT_CHAIN):] + [LATEST_SQL]
TF_SQL = f"""tf AS (SELECT * FROM wide_r WHERE dim_collected_date BETWEEN DATE '{T0}' AND DATE '{T1}'
  AND lower(CAST(is_target_segment AS STRING)) = 'true')"""
RECENT_SQL = f"""recent AS (SELECT * FROM latest
  WHERE TRY_CAST(dim_listed_date AS DATE) BETWEEN DATE '{RECENT_AS_OF}' - INTERVAL 28 DAY AND DATE '{RECENT_AS_OF}')"""


@lru_cache(maxsize=64)
def _stored(spark, sf_dir, build):
    """The result of ``build`` as a stored table, written once a session: the
    display frames read the two result tables back (A16), as a dashboard does
    between two runs of the chain, and recompute nothing."""
    return rebuild_table(build(spark, sf_dir), scratch_path(spark, build.__name__))


def build_latest(spark, sf_dir):
    """The latest-state listings table (facts with comps, one row per id).  A
    row's ratio comes from its own price and point and the whole fact rows, so
    the newest rows are found first and theirs alone are computed."""
    facts = fact_rows(spark, sf_dir)
    latest = stored(latest_per_key(facts, "id", ["dim_collected_date", "listing_key"]), "latest-facts")
    return add_comps_ratio(latest, keys=COMPS_KEYS, lon="info_longitude", lat="info_latitude", value="met_price",
                           radius_m=COMPS_RADIUS_M, reference=facts)


def latest_listings(spark, sf_dir):
    return _stored(spark, sf_dir, build_latest)


def anomalies(spark, sf_dir):
    return _stored(spark, sf_dir, anomaly_wide_rounded)


def trends_filtered(spark, sf_dir):
    return P.trend_filter(anomalies(spark, sf_dir), T0, T1, segment="true")


def recent(spark, sf_dir):
    return P.recent_listings(latest_listings(spark, sf_dir), RECENT_AS_OF, target_homes=False)


@register("trend_filter", O.with_(*TREND_CHAIN, TF_SQL, select="SELECT * FROM tf ORDER BY dim_collected_date"))
def trend_filter(spark, sf_dir):
    """Inclusive collected-date range, segment 'true', oldest first."""
    return trends_filtered(spark, sf_dir)


@register("recent_listings", O.with_(*LIST_CHAIN, RECENT_SQL, select="SELECT * FROM recent"))
def recent_listings(spark, sf_dir):
    """Listings listed in the 28 days up to the as-of date."""
    return recent(spark, sf_dir)


@register("optional_columns", O.with_(*LIST_CHAIN, select="""
  SELECT 'no listed date' AS input, count(*) AS rows, count(met_price) AS priced FROM latest WHERE is_target
  UNION ALL SELECT 'no target flag', count(*), count(met_price) FROM latest
    WHERE TRY_CAST(dim_listed_date AS DATE) BETWEEN DATE '%s' - INTERVAL 28 DAY AND DATE '%s'
  UNION ALL SELECT 'neither', count(*), count(met_price) FROM latest""" % (RECENT_AS_OF, RECENT_AS_OF)))
def optional_columns(spark, sf_dir):
    """The listings filter on tables that lack its optional columns;
    a filter whose column is missing is left out."""
    l = latest_listings(spark, sf_dir)
    out = None
    for name, lacking in (("no listed date", ["dim_listed_date"]), ("no target flag", ["is_target"]),
                          ("neither", ["dim_listed_date", "is_target"])):
        got = P.recent_listings(l.drop(*lacking), RECENT_AS_OF).agg(
            F.count("*").alias("rows"), F.count("met_price").alias("priced")).select(
            F.lit(name).alias("input"), "rows", "priced")
        out = got if out is None else out.unionByName(got)
    return out


def _kdisp(x: str) -> str:
    return f"'$' || format('{{:,.0f}}', {x} / 1000.0) || 'k'"


@register("kpi_summary", O.with_(*BOTH_CHAIN, TF_SQL, RECENT_SQL, f"""k AS (
  SELECT coalesce(CAST(arg_max(met_price_median, dim_collected_date) AS DOUBLE), 0.0) AS m,
         coalesce(CAST(arg_max(met_04_week_ma, dim_collected_date) AS DOUBLE), 0.0) AS a,
         CAST(count_if(is_price_median_anomaly) AS DOUBLE) AS n FROM tf)""", select=f"""
  SELECT 'latest_median' AS kpi, m AS value, {_kdisp('m')} AS display FROM k
  UNION ALL SELECT 'latest_4_week_avg', a, {_kdisp('a')} FROM k
  UNION ALL SELECT 'anomalies', n, format('{{:,.0f}}', n) FROM k
  UNION ALL SELECT 'listings', CAST(count(*) AS DOUBLE), format('{{:,.0f}}', CAST(count(*) AS DOUBLE)) FROM recent"""))
def kpi_summary(spark, sf_dir):
    """The four dashboard KPIs as a long table."""
    return P.kpi_summary(trends_filtered(spark, sf_dir), recent(spark, sf_dir))


@register("date_bounds", O.with_(*TREND_CHAIN, select="""
  SELECT coalesce(min(dim_collected_date), DATE '2024-01-01') AS min_date,
         coalesce(max(dim_collected_date), DATE '2024-12-31') AS max_date FROM wide_r"""))
def date_bounds(spark, sf_dir):
    """First and last collected date (defaults when empty)."""
    return P.date_bounds(anomalies(spark, sf_dir))


_MAP_SQL = """mpts AS (
  SELECT * EXCLUDE (info_latitude, info_longitude), info_latitude AS latitude, info_longitude AS longitude,
    CASE WHEN met_price IS NULL THEN 'Unknown' ELSE '$' || format('{:,.0f}', CAST(met_price AS DOUBLE)) END AS price_formatted,
    coalesce(strftime(TRY_CAST(dim_listed_date AS DATE), '%b %d, %Y'), 'Unknown') AS listed_date_str,
    coalesce(info_street1, 'Unknown Address') AS address_str
  FROM recent WHERE info_latitude IS NOT NULL AND info_longitude IS NOT NULL)"""


@register("map_points", O.with_(*LIST_CHAIN, RECENT_SQL, _MAP_SQL, select="SELECT * FROM mpts"))
def map_points(spark, sf_dir):
    """Located listings with display text."""
    return P.map_points(recent(spark, sf_dir))


@register("map_centre", O.with_(*LIST_CHAIN, RECENT_SQL, _MAP_SQL, select="""
  SELECT round(avg(latitude), 9) AS centre_lat, round(avg(longitude), 9) AS centre_lon FROM mpts"""))
def map_centre(spark, sf_dir):
    """Mean coordinates of the map points."""
    c = P.map_centre(P.map_points(recent(spark, sf_dir)))
    return c.select(F.round("centre_lat", 9).alias("centre_lat"), F.round("centre_lon", 9).alias("centre_lon"))


@register("distinct_dates", O.with_(*TREND_CHAIN, TF_SQL, select="SELECT DISTINCT dim_collected_date FROM tf"))
def distinct_dates(spark, sf_dir):
    """The distinct dates of the filtered trend rows."""
    return P.distinct_dates(trends_filtered(spark, sf_dir))


@register("inventory_by_ratio", O.with_(*LIST_CHAIN, select="""
  SELECT id, listing_key, met_price, met_price_vs_comps_ratio, info_street1, dim_listed_date
  FROM latest ORDER BY met_price_vs_comps_ratio ASC NULLS LAST, listing_key"""))
def inventory_by_ratio(spark, sf_dir):
    """the whole inventory, priced lowest against its comps first,
    missing ratios last."""
    l = latest_listings(spark, sf_dir).select("id", "listing_key", "met_price", "met_price_vs_comps_ratio",
                                              "info_street1", "dim_listed_date")
    return P.inventory_by_ratio(l, tie_break=["listing_key"])


@register("latest_trend_row", O.with_(*TREND_CHAIN, select="""
  SELECT is_target_segment, max(dim_collected_date) AS dim_collected_date,
         arg_max(met_price_median, dim_collected_date) AS met_price_median,
         arg_max(met_04_week_ma, dim_collected_date) AS met_04_week_ma,
         arg_max(is_price_median_anomaly, dim_collected_date) AS is_price_median_anomaly
  FROM wide_r GROUP BY is_target_segment"""))
def latest_trend_row(spark, sf_dir):
    """the newest trend row per segment."""
    return P.latest_trend_row(anomalies(spark, sf_dir),
                              cols=["dim_collected_date", "met_price_median", "met_04_week_ma",
                                    "is_price_median_anomaly"])
