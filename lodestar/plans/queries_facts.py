"""Registered queries: fact flags and metrics, geo, spatial comps, latest
snapshot (B8-B11, C1, C2, E8, H7-H17, P2, P4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo as G
from ..operators.snapshot import latest_per_key
from ..operators.spatial import add_comps_ratio, neighbour_stats
from . import oracle as O
from .queries_series import fact_rows
from .registry import register
from .standins import COMPS_RADIUS_M, TARGET_LAT, TARGET_LON, table

COMPS_KEYS = ["dim_collected_date", "met_bedrooms"]


def fact_table_df(spark, sf_dir):
    """Base rows with flags, metrics and the spatial comps ratio."""
    return add_comps_ratio(fact_rows(spark, sf_dir), keys=COMPS_KEYS, lon="info_longitude",
                           lat="info_latitude", value="met_price", radius_m=COMPS_RADIUS_M)


_VALID_A = O.valid_sql("a.info_longitude", "a.info_latitude")
_VALID_B = O.valid_sql("b.info_longitude", "b.info_latitude")
_HAV_AB = O.haversine_sql("a.info_longitude", "a.info_latitude", "b.info_longitude", "b.info_latitude")

COMPS_PTS = f"""pts AS (
  SELECT DISTINCT dim_collected_date, met_bedrooms, info_longitude, info_latitude FROM facts a
  WHERE {_VALID_A} AND dim_collected_date IS NOT NULL AND met_bedrooms IS NOT NULL)"""

COMPS_STATS = f"""pstats AS (
  SELECT a.dim_collected_date, a.met_bedrooms, a.info_longitude, a.info_latitude,
         count(b.met_price) AS comps_count,
         CAST(sum(b.met_price) AS DOUBLE) / count(b.met_price) AS comps_avg
  FROM pts a LEFT JOIN facts b
    ON a.dim_collected_date = b.dim_collected_date AND a.met_bedrooms = b.met_bedrooms
   AND {_VALID_B} AND {_HAV_AB} <= {COMPS_RADIUS_M}
  GROUP BY a.dim_collected_date, a.met_bedrooms, a.info_longitude, a.info_latitude)"""

FACT_TABLE = """fact_table AS (
  SELECT f.*, s.comps_count, s.comps_avg,
         CAST(f.met_price AS DOUBLE) / nullif(s.comps_avg, 0.0) AS met_price_vs_comps_ratio
  FROM facts f LEFT JOIN pstats s
    ON f.dim_collected_date = s.dim_collected_date AND f.met_bedrooms = s.met_bedrooms
   AND f.info_longitude = s.info_longitude AND f.info_latitude = s.info_latitude)"""

COMPS_CHAIN = O.FACT_CHAIN + [COMPS_PTS, COMPS_STATS, FACT_TABLE]


@register("fact_flags", O.with_(*O.FACT_CHAIN, select="""
  SELECT listing_key, id, is_active, is_new_construction, is_stale, is_target FROM facts"""))
def fact_flags(spark, sf_dir):
    """B8-B10 (+B11): never-NULL flags against a fixed as-of date."""
    return fact_rows(spark, sf_dir).select("listing_key", "id", "is_active",
                                           "is_new_construction", "is_stale", "is_target")


@register("fact_metrics", O.with_(*O.FACT_CHAIN, select="""
  SELECT listing_key, met_bath_to_bed_ratio, met_home_age_years, met_price_per_sqft FROM facts"""))
def fact_metrics(spark, sf_dir):
    """Ratios with zero divisors as NULL, age in years."""
    return fact_rows(spark, sf_dir).select("listing_key", "met_bath_to_bed_ratio",
                                           "met_home_age_years", "met_price_per_sqft")


@register("target_flag", O.with_(*O.FACT_CHAIN, select="""
  SELECT listing_key, dim_zip, is_stale, is_target FROM facts"""))
def target_flag(spark, sf_dir):
    """Zip equality, within 3000 m of a fixed point, not stale."""
    return fact_rows(spark, sf_dir).select("listing_key", "dim_zip", "is_stale", "is_target")


_GEO_LON, _GEO_LAT = "c_acctbal / 50.0", "CAST(c_nationkey AS DOUBLE) * 7.5 - 90.0"
_GV = O.valid_sql(_GEO_LON, _GEO_LAT)


@register("geo_point", f"""
  SELECT c_custkey,
    CASE WHEN {_GV} THEN {_GEO_LON} END AS lon,
    CASE WHEN {_GV} THEN {_GEO_LAT} END AS lat,
    round(CASE WHEN {_GV} THEN cos(radians({_GEO_LAT})) * cos(radians({_GEO_LON})) END, 9) AS x,
    round(CASE WHEN {_GV} THEN cos(radians({_GEO_LAT})) * sin(radians({_GEO_LON})) END, 9) AS y,
    round(CASE WHEN {_GV} THEN sin(radians({_GEO_LAT})) END, 9) AS z
  FROM customer""")
def geo_point(spark, sf_dir):
    """(lon, lat) point, NULL when missing or out of range, and its
    unit-sphere vector."""
    c = table(spark, sf_dir, "customer")
    lon, lat = F.col("c_acctbal") / 50.0, F.col("c_nationkey") * 7.5 - 90.0
    p = G.geo_point(lon, lat)
    x, y, z = G.unit_vector(lon, lat)
    return c.select("c_custkey", p["lon"].alias("lon"), p["lat"].alias("lat"),
                    F.round(x, 9).alias("x"), F.round(y, 9).alias("y"), F.round(z, 9).alias("z"))


_HAV_T = O.haversine_sql(str(TARGET_LON), str(TARGET_LAT), "info_longitude", "info_latitude")
_VT = O.valid_sql("info_longitude", "info_latitude")


@register("within_radius", O.with_(O.LISTINGS, select=f"""
  SELECT listing_key,
    round({_HAV_T}, 3) AS distance_m,
    coalesce({_VT} AND {_HAV_T} <= 1000.0, false) AS within_1000,
    coalesce({_VT} AND {_HAV_T} <= 3000.0, false) AS within_3000
  FROM listings"""))
def within_radius(spark, sf_dir):
    """Inclusive great-circle radius test against a fixed point."""
    from .standins import listings
    df = listings(spark, sf_dir)
    t_lon, t_lat = F.lit(TARGET_LON), F.lit(TARGET_LAT)
    return df.select(
        "listing_key",
        F.round(G.haversine_m(t_lon, t_lat, "info_longitude", "info_latitude"), 3).alias("distance_m"),
        G.within_radius(t_lon, t_lat, "info_longitude", "info_latitude", 1000.0).alias("within_1000"),
        G.within_radius(t_lon, t_lat, "info_longitude", "info_latitude", 3000.0).alias("within_3000"))


@register("spatial_comps", O.with_(*COMPS_CHAIN, select="""
  SELECT listing_key, dim_collected_date, met_bedrooms, met_price, comps_count, comps_avg,
         met_price_vs_comps_ratio FROM fact_table"""))
def spatial_comps(spark, sf_dir):
    """Price against the mean price of same-date, same-bedroom listings
    within 1000 m (the listing itself included), per listing."""
    df = add_comps_ratio(fact_rows(spark, sf_dir), keys=COMPS_KEYS, lon="info_longitude",
                         lat="info_latitude", value="met_price", radius_m=COMPS_RADIUS_M,
                         keep_stats=True)
    return df.select("listing_key", "dim_collected_date", "met_bedrooms", "met_price",
                     "comps_count", "comps_avg", "met_price_vs_comps_ratio")


@register("spatial_comps_grid", O.with_(*O.FACT_CHAIN, COMPS_PTS, COMPS_STATS,
                                        select="SELECT * FROM pstats"))
def spatial_comps_grid(spark, sf_dir):
    """C1, point level: neighbour count and mean per distinct (date,
    bedrooms, point) from the 27-cell grid join."""
    return neighbour_stats(fact_rows(spark, sf_dir), keys=COMPS_KEYS, lon="info_longitude",
                           lat="info_latitude", value="met_price", radius_m=COMPS_RADIUS_M)


DENSE_RADIUS_M = 2000.0


@register("spatial_comps_dense", O.with_(*O.FACT_CHAIN, select=f"""
  SELECT a.met_bedrooms, a.info_longitude, a.info_latitude, count(b.met_price) AS comps_count,
         CAST(sum(b.met_price) AS DOUBLE) / count(b.met_price) AS comps_avg
  FROM (SELECT DISTINCT met_bedrooms, info_longitude, info_latitude FROM facts a
        WHERE {_VALID_A} AND met_bedrooms IS NOT NULL) a
  LEFT JOIN facts b ON a.met_bedrooms = b.met_bedrooms AND {_VALID_B} AND {_HAV_AB} <= {DENSE_RADIUS_M}
  GROUP BY a.met_bedrooms, a.info_longitude, a.info_latitude"""))
def spatial_comps_dense(spark, sf_dir):
    """C1 over all weeks at once: few, dense groups, whose neighbours are
    counted by the pyramid of cells."""
    return neighbour_stats(fact_rows(spark, sf_dir), keys=["met_bedrooms"], lon="info_longitude",
                           lat="info_latitude", value="met_price", radius_m=DENSE_RADIUS_M)


@register("fact_table", O.with_(*COMPS_CHAIN, select="""
  SELECT * EXCLUDE (comps_count, comps_avg) FROM fact_table"""))
def fact_table(spark, sf_dir):
    """The whole fact layer."""
    return fact_table_df(spark, sf_dir)


@register("latest_snapshot", O.with_(*O.FACT_CHAIN, select="""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY dim_collected_date DESC, listing_key DESC) AS rn
    FROM facts) WHERE rn = 1"""))
def latest_snapshot(spark, sf_dir):
    """Newest row per id (tie-break on the row key)."""
    return latest_per_key(fact_rows(spark, sf_dir), "id", ["dim_collected_date", "listing_key"])
