"""DuckDB oracle SQL: independent SQL text for each registered query.

CTE fragments are shared so that the text of a later layer states exactly
which earlier layer it reads.  Column aliases equal the Spark names.
"""

from __future__ import annotations

from .standins import AS_OF, TARGET_LAT, TARGET_LON, TARGET_RADIUS_M, TARGET_ZIP, listings_sql

R2 = 2.0 * 6371008.8


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (f"{R2} * asin(sqrt(least(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
            f" + cos(radians({lat1})) * cos(radians({lat2}))"
            f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2), 1.0)))")


def valid_sql(lon: str, lat: str) -> str:
    return (f"({lon} IS NOT NULL AND {lat} IS NOT NULL AND {lon} BETWEEN -180.0 AND 180.0"
            f" AND {lat} BETWEEN -90.0 AND 90.0)")


def with_(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


LISTINGS = f"listings AS ({listings_sql()})"

FLAGS = f"""flagged AS (
  SELECT l.*,
    l.dim_removed_date IS NULL AS is_active,
    coalesce(l.met_year_built >= year(DATE '{AS_OF}') - 1, false) AS is_new_construction,
    coalesce(date_diff('day', l.dim_created_date, DATE '{AS_OF}') > 90
             AND l.dim_removed_date IS NULL, false) AS is_stale
  FROM listings l)"""

TARGET = f"""targeted AS (
  SELECT f.*,
    coalesce(f.dim_zip = '{TARGET_ZIP}'
      AND coalesce({valid_sql(str(TARGET_LON), str(TARGET_LAT))} AND {valid_sql('f.info_longitude', 'f.info_latitude')}
          AND {haversine_sql(str(TARGET_LON), str(TARGET_LAT), 'f.info_longitude', 'f.info_latitude')} <= {TARGET_RADIUS_M}, false)
      AND NOT f.is_stale, false) AS is_target
  FROM flagged f)"""

FACTS = f"""facts AS (
  SELECT t.*,
    t.met_bathrooms / nullif(t.met_bedrooms, 0.0) AS met_bath_to_bed_ratio,
    CAST(year(DATE '{AS_OF}') AS BIGINT) - t.met_year_built AS met_home_age_years,
    CAST(t.met_price AS DOUBLE) / nullif(CAST(t.met_square_feet AS DOUBLE), 0.0) AS met_price_per_sqft
  FROM targeted t)"""


def ts_cte(segment: str = "is_urgent") -> str:
    return f"""ts AS (
  SELECT dim_collected_date,
    CASE WHEN grouping({segment}) = 1 THEN 'all' ELSE CAST({segment} AS STRING) END AS is_target_segment,
    count(id) AS met_listings_count,
    CAST(sum(met_price) AS DOUBLE) / count(met_price) AS met_price_avg,
    quantile_disc(met_price, 0.5) AS met_price_median,
    sum(met_price_per_sqft) / count(met_price_per_sqft) AS met_price_per_sqft_avg,
    quantile_disc(met_price_per_sqft, 0.5) AS met_price_per_sqft_median
  FROM facts WHERE is_active
  GROUP BY GROUPING SETS ((dim_collected_date), (dim_collected_date, {segment})))"""


def _ma(n: int) -> str:
    w = f"(PARTITION BY is_target_segment ORDER BY dim_collected_date NULLS FIRST ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CAST(sum(met_price_median) OVER {w} AS DOUBLE) / count(met_price_median) OVER {w}"


MA = f"""ma AS (
  SELECT ts.*,
    {_ma(4)} AS met_04_week_ma,
    {_ma(12)} AS met_12_week_ma,
    {_ma(52)} AS met_52_week_ma
  FROM ts)"""

YOY = """yoy AS (
  SELECT m.*,
    p.met_04_week_ma AS met_prior_04_week_ma,
    p.met_12_week_ma AS met_prior_12_week_ma,
    p.met_52_week_ma AS met_prior_52_week_ma
  FROM ma m LEFT JOIN ma p
    ON m.is_target_segment = p.is_target_segment
   AND p.dim_collected_date = CAST(m.dim_collected_date - INTERVAL 364 DAY AS DATE))"""

_W = "OVER (PARTITION BY is_target_segment ORDER BY dim_collected_date NULLS FIRST)"

SERIES = f"""series AS (
  SELECT dim_collected_date, is_target_segment,
    met_listings_count, met_price_avg, met_price_median, met_price_per_sqft_avg, met_price_per_sqft_median,
    met_04_week_ma, met_12_week_ma, met_52_week_ma,
    met_prior_04_week_ma, met_prior_12_week_ma, met_prior_52_week_ma,
    CASE WHEN met_12_week_ma < met_52_week_ma AND lag(met_12_week_ma, 1) {_W} > lag(met_52_week_ma, 1) {_W} THEN true ELSE false END AS is_macd_cross_down,
    CASE WHEN met_12_week_ma > met_52_week_ma AND lag(met_12_week_ma, 1) {_W} < lag(met_52_week_ma, 1) {_W} THEN true ELSE false END AS is_macd_cross_up,
    CASE WHEN met_12_week_ma < met_prior_04_week_ma AND lag(met_12_week_ma, 1) {_W} > lag(met_prior_04_week_ma, 1) {_W} THEN true ELSE false END AS is_yoy_cross_down,
    CASE WHEN met_12_week_ma > met_prior_04_week_ma AND lag(met_12_week_ma, 1) {_W} < lag(met_prior_04_week_ma, 1) {_W} THEN true ELSE false END AS is_yoy_cross_up
  FROM yoy)"""

FACT_CHAIN = [LISTINGS, FLAGS, TARGET, FACTS]
SERIES_CHAIN = FACT_CHAIN + [ts_cte(), MA, YOY, SERIES]

# ---- models -------------------------------------------------------------
from ..functions.stats import AS_A, AS_P  # noqa: E402
from . import oracle_models as M  # noqa: E402

METRICS = ["met_listings_count", "met_price_avg", "met_price_median",
           "met_price_per_sqft_avg", "met_price_per_sqft_median"]

SERIES_R = """series_r AS (
  SELECT * REPLACE (round(met_price_per_sqft_avg, 6) AS met_price_per_sqft_avg) FROM series)"""

LONG = "long AS (\n  SELECT * FROM (SELECT dim_collected_date, is_target_segment, " + ", ".join(
    f"CAST({m} AS DOUBLE) AS {m}" for m in METRICS) + """ FROM series_r)
  UNPIVOT (met_metric_value FOR dim_metric_name IN (""" + ", ".join(METRICS) + ")))"

def _erf_sql(x: str) -> str:
    a1, a2, a3, a4, a5 = AS_A
    t = f"(1.0 / (1.0 + {AS_P} * {x}))"
    poly = f"{t} * ({a1} + {t} * ({a2} + {t} * ({a3} + {t} * ({a4} + {t} * {a5}))))"
    return f"(1.0 - {poly} * exp(-({x} * {x})))"


DETECT = M.detect(_erf_sql(f"({{z}} / {2.0 ** 0.5})"))

PIVOT_AGGS = [("is_anomaly", "is_anomaly"), ("lower_bound", "lower_bound"),
              ("upper_bound", "upper_bound"), ("anomaly_prob", "anomaly_probability")]

PIVOT = "pivoted AS (\n  SELECT dim_collected_date, is_target_segment, " + ",\n    ".join(
    f"max(CASE WHEN dim_metric_name = '{m}' THEN {src} END) AS {alias}_{m}"
    for alias, src in PIVOT_AGGS for m in METRICS) + "\n  FROM det GROUP BY dim_collected_date, is_target_segment)"


def wide_names(m: str) -> dict[str, str]:
    """Pivot column -> presentation name for metric ``m`` (``met_<x>``)."""
    x = m[len("met_"):]
    return {f"is_anomaly_{m}": f"is_{x}_anomaly", f"lower_bound_{m}": f"{m}_lower_bound",
            f"upper_bound_{m}": f"{m}_upper_bound",
            f"anomaly_prob_{m}": f"{m}_anomaly_probability"}


WIDE = "wide AS (\n  SELECT s.*, " + ",\n    ".join(
    f"pv.{src} AS {dst}" for m in METRICS for src, dst in wide_names(m).items()) + """
  FROM series_r s LEFT JOIN pivoted pv
    ON s.dim_collected_date = pv.dim_collected_date AND s.is_target_segment = pv.is_target_segment)"""

MODEL_CHAIN = SERIES_CHAIN + [SERIES_R, LONG] + M.FIT
DETECT_CHAIN = MODEL_CHAIN + DETECT
WIDE_CHAIN = DETECT_CHAIN + [PIVOT, WIDE]
