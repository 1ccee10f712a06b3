"""Registered queries: reshaping, series models, anomaly bands, calendar
(D7-D9, I1-I7, A17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anomaly as A
from ..operators import calendar as C
from ..operators.decompose import decompose
from ..operators.reshape import pivot_wide, unpivot_metrics
from . import oracle as O
from .chain import SCORES, SERIES_METRICS, wide_scores
from .queries_series import market_series_df
from .registry import register
from .standins import table
from ..session import materialize

IDS = ["is_target_segment", "dim_metric_name"]
KEYS = ["dim_collected_date", "is_target_segment"]
ROUND_DET = {"lower_bound": 2, "upper_bound": 2, "anomaly_probability": 6}


def series_table(spark, sf_dir):
    """The weekly series, computed once from the facts and checkpointed:
    fit, detect and the final join all read this small table."""
    return materialize(market_series_df(spark, sf_dir))


def long_series(spark, sf_dir, series=None):
    s = series_table(spark, sf_dir) if series is None else series
    return unpivot_metrics(s, KEYS, SERIES_METRICS)


def params_df(spark, sf_dir):
    return A.fit_series_models(long_series(spark, sf_dir), IDS, "dim_collected_date",
                               "met_metric_value")


def detections_df(spark, sf_dir, series=None, **options):
    """Decomposition (checkpointed: fit and scores read it), models, scores."""
    long = long_series(spark, sf_dir, series)
    parts = materialize(decompose(long, IDS, "dim_collected_date", "met_metric_value"))
    params = A.fit_series_models(long, IDS, "dim_collected_date", "met_metric_value", parts=parts)
    return A.detect_anomalies(long, params, IDS, "dim_collected_date", "met_metric_value", 0.95,
                              parts=parts, **options)


def anomaly_wide_df(spark, sf_dir):
    """Series + detector output pivoted back to wide, left joined."""
    series = series_table(spark, sf_dir)
    det = detections_df(spark, sf_dir, series)
    return series.join(wide_scores(det), KEYS, "left")


def _round_sql(cols: dict[str, int], others: list[str]) -> str:
    return ", ".join(others + [f"round({c}, {d}) AS {c}" for c, d in cols.items()])


@register("unpivot_metrics", O.with_(*O.SERIES_CHAIN, O.SERIES_R, O.LONG, select="SELECT * FROM long"))
def unpivot_metrics_q(spark, sf_dir):
    """Five metrics to (name, value) rows, NULL values left out."""
    return unpivot_metrics(market_series_df(spark, sf_dir), KEYS, SERIES_METRICS)


PARAM_ROUND = {"intercept": 4, "phi1": 6, "phi2": 6, "theta": 6, "sigma": 4, "aic": 4}


@register("arima_fit", O.with_(*O.MODEL_CHAIN, select="SELECT " + _round_sql(
    PARAM_ROUND, ["is_target_segment", "dim_metric_name", "d", "p", "q", "n"]) + " FROM params"))
def arima_fit(spark, sf_dir):
    """Per (segment, metric) series an ARIMA model of the remainder by
    exact likelihood, its order by corrected AIC."""
    return params_df(spark, sf_dir).withColumns({c: F.round(c, n) for c, n in PARAM_ROUND.items()})


@register("anomaly_detect", O.with_(*O.DETECT_CHAIN, select="SELECT " + _round_sql(
    ROUND_DET, ["is_target_segment", "dim_metric_name", "dim_collected_date", "met_metric_value",
                "is_anomaly"]) + " FROM det"))
def anomaly_detect(spark, sf_dir):
    """In-sample anomaly flag, band and probability at threshold 0.95."""
    d = detections_df(spark, sf_dir)
    return d.withColumns({c: F.round(c, n) for c, n in ROUND_DET.items()})


_PIVOT_ROUND = {f"{a}_{m}": n for m in O.METRICS
                for a, n in (("lower_bound", 2), ("upper_bound", 2), ("anomaly_prob", 6))}


@register("pivot_wide", O.with_(*O.DETECT_CHAIN, O.PIVOT, select="SELECT " + _round_sql(
    _PIVOT_ROUND, KEYS + [f"is_anomaly_{m}" for m in O.METRICS]) + " FROM pivoted"))
def pivot_wide_q(spark, sf_dir):
    """4 max-aggregates x 5 listed metric names -> 20 columns."""
    w = pivot_wide(detections_df(spark, sf_dir), KEYS, "dim_metric_name", SERIES_METRICS, SCORES)
    return w.withColumns({c: F.round(c, n) for c, n in _PIVOT_ROUND.items()})


_WIDE_ROUND = {O.wide_names(m)[f"{a}_{m}"]: n for m in O.METRICS
               for a, n in (("lower_bound", 2), ("upper_bound", 2), ("anomaly_prob", 6))}
_WIDE_COLS = (["dim_collected_date", "is_target_segment"] + O.METRICS
              + ["met_04_week_ma", "met_12_week_ma", "met_52_week_ma", "met_prior_04_week_ma",
                 "met_prior_12_week_ma", "met_prior_52_week_ma", "is_macd_cross_down",
                 "is_macd_cross_up", "is_yoy_cross_down", "is_yoy_cross_up"]
              + [f"is_{m[4:]}_anomaly" for m in O.METRICS])


def anomaly_wide_rounded(spark, sf_dir):
    w = anomaly_wide_df(spark, sf_dir)
    return w.withColumns({c: F.round(c, n) for c, n in _WIDE_ROUND.items()})


@register("anomaly_wide", O.with_(*O.WIDE_CHAIN, select="SELECT " + _round_sql(
    _WIDE_ROUND, _WIDE_COLS) + " FROM wide ORDER BY dim_collected_date DESC, is_target_segment"))
def anomaly_wide(spark, sf_dir):
    """The 37-column anomalies table, newest first."""
    return anomaly_wide_rounded(spark, sf_dir).orderBy(F.desc("dim_collected_date"),
                                                      "is_target_segment")


# Dashboard metric choices, label -> (metric column, anomaly flag).
METRIC_MAP = {
    "Median Price": ("met_price_median", "is_price_median_anomaly"),
    "Average Price": ("met_price_avg", "is_price_avg_anomaly"),
    "Median Price / SqFt": ("met_price_per_sqft_median", "is_price_per_sqft_median_anomaly"),
    "Average Price / SqFt": ("met_price_per_sqft_avg", "is_price_per_sqft_avg_anomaly"),
}


def band_series_df(wide, labels=None):
    """Long (date, segment, label, metric, value, lower, upper,
    is_anomaly) rows for the chosen dashboard metrics."""
    labels = labels or list(METRIC_MAP)
    rows = F.array(*[F.struct(F.lit(lab).alias("metric_label"), F.lit(m).alias("dim_metric_name"),
                              F.col(m).cast("double").alias("value"),
                              F.col(f"{m}_lower_bound").alias("lower_bound"),
                              F.col(f"{m}_upper_bound").alias("upper_bound"),
                              F.col(flag).alias("is_anomaly"))
                     for lab in labels for m, flag in [METRIC_MAP[lab]]])
    return wide.select("dim_collected_date", "is_target_segment", F.explode(rows).alias("b")).select(
        "dim_collected_date", "is_target_segment", "b.*")


_BAND_SQL = " UNION ALL ".join(
    f"SELECT dim_collected_date, is_target_segment, '{lab}' AS metric_label, '{m}' AS dim_metric_name, "
    f"CAST({m} AS DOUBLE) AS value, {m}_lower_bound AS lower_bound, {m}_upper_bound AS upper_bound, "
    f"{flag} AS is_anomaly FROM wide_r" for lab, (m, flag) in METRIC_MAP.items())
_WIDE_R = "wide_r AS (SELECT " + _round_sql(_WIDE_ROUND, _WIDE_COLS) + " FROM wide)"


@register("band_series", O.with_(*O.WIDE_CHAIN, _WIDE_R, select=_BAND_SQL))
def band_series(spark, sf_dir):
    """Value and band per chosen metric, long form for plotting."""
    return band_series_df(anomaly_wide_rounded(spark, sf_dir))


@register("anomaly_points", O.with_(*O.WIDE_CHAIN, _WIDE_R, select=f"SELECT * FROM ({_BAND_SQL}) WHERE is_anomaly"))
def anomaly_points(spark, sf_dir):
    """Only the flagged points."""
    return band_series_df(anomaly_wide_rounded(spark, sf_dir)).where(F.col("is_anomaly"))


_WEEKS = "CAST(date_trunc('week', o_orderdate) AS DATE)"


@register("date_spine", f"""
  SELECT CAST(gs AS DATE) AS dim_collected_date FROM (
    SELECT unnest(generate_series(min({_WEEKS}), max({_WEEKS}), INTERVAL 7 DAY)) AS gs FROM orders)""")
def date_spine(spark, sf_dir):
    """Every week from the first to the last order week."""
    o = table(spark, sf_dir, "orders").select(
        F.date_trunc("week", "o_orderdate").cast("date").alias("dim_collected_date"))
    return C.date_spine(o, "dim_collected_date")


_SER = f"""wk AS (
  SELECT o_orderpriority, o_orderstatus, {_WEEKS} AS dim_collected_date, count(*) AS n_orders,
         CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS cents
  FROM orders GROUP BY ALL)"""


@register("regularise_series", O.with_(_SER, f"""bounds AS (
  SELECT o_orderpriority, o_orderstatus, min(dim_collected_date) AS lo, max(dim_collected_date) AS hi
  FROM wk GROUP BY ALL)""", """spine AS (
  SELECT o_orderpriority, o_orderstatus, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS dim_collected_date
  FROM bounds)""", select="""
  SELECT s.o_orderpriority, s.o_orderstatus, s.dim_collected_date,
         coalesce(w.n_orders, 0) AS n_orders, w.cents, w.n_orders IS NULL AS is_filled
  FROM spine s LEFT JOIN wk w USING (o_orderpriority, o_orderstatus, dim_collected_date)"""))
def regularise_series(spark, sf_dir):
    """Weekly series per (priority, status) with missing weeks inserted."""
    o = table(spark, sf_dir, "orders")
    wk = o.groupBy("o_orderpriority", "o_orderstatus",
                   F.date_trunc("week", "o_orderdate").cast("date").alias("dim_collected_date")).agg(
        F.count("*").alias("n_orders"),
        F.sum(F.round(F.col("o_totalprice") * 100)).cast("long").alias("cents"))
    return C.regularise_series(wk, ["o_orderpriority", "o_orderstatus"], "dim_collected_date",
                               ["n_orders", "cents"], fill={"n_orders": 0})


_HOLIDAYS = O.M.holiday_days("(SELECT min(o_orderdate) FROM orders)", "(SELECT max(o_orderdate) FROM orders)")


@register("holiday_weeks", O.with_(
    f"cal AS (SELECT CAST(date_trunc('week', d) AS DATE) AS week_start, min(name) AS holiday_name, count(*) AS n_holidays FROM ({_HOLIDAYS}) GROUP BY 1)",
    f"weeks AS (SELECT DISTINCT {_WEEKS} AS dim_collected_date FROM orders)",
    select="""SELECT w.dim_collected_date, c.holiday_name IS NOT NULL AS is_holiday_week, c.holiday_name,
                     coalesce(c.n_holidays, 0) AS n_holidays
              FROM weeks w LEFT JOIN cal c ON w.dim_collected_date = c.week_start"""))
def holiday_weeks(spark, sf_dir):
    """I4: US holiday weeks, computed by rule for the years in the data."""
    o = table(spark, sf_dir, "orders")
    return C.holiday_weeks(o, "o_orderdate").withColumnRenamed("o_orderdate", "dim_collected_date")


PART_ROUND = {"level": 2, "trend": 2, "holiday_effect": 2, "season": 2}


@register("anomaly_detect_seasonal", O.with_(*O.DETECT_CHAIN, select="SELECT " + _round_sql(
    ROUND_DET | PART_ROUND, ["is_target_segment", "dim_metric_name", "dim_collected_date", "met_metric_value",
                             "is_anomaly", "is_level_shift", "is_spike"]) + " FROM det"))
def anomaly_detect_seasonal(spark, sf_dir):
    """The scores with what each week's band is made of: level (by
    change points), trend, US-holiday effect and season."""
    d = detections_df(spark, sf_dir, components=True)
    return d.withColumns({c: F.round(c, n) for c, n in (ROUND_DET | PART_ROUND).items()})
