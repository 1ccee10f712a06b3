"""Whole layers as plain functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import series as S
from ..operators.features import add_fact_flags, add_fact_metrics

MA_WINDOWS = {"met_04_week_ma": 4, "met_12_week_ma": 12, "met_52_week_ma": 52}
PRIOR = {"met_04_week_ma": "met_prior_04_week_ma",
         "met_12_week_ma": "met_prior_12_week_ma",
         "met_52_week_ma": "met_prior_52_week_ma"}
SERIES_KEYS = ["dim_collected_date", "is_target_segment"]
SERIES_METRICS = ["met_listings_count", "met_price_avg", "met_price_median",
                  "met_price_per_sqft_avg", "met_price_per_sqft_median"]


def series_base(facts: DataFrame, *, segment_col: str = "is_target",
                date_col: str = "dim_collected_date",
                sketch: int = S.DEFAULT_SKETCH) -> DataFrame:
    return S.listing_series(facts.filter(F.col("is_active")), date_col, segment_col, sketch=sketch)


def with_moving_averages(ts: DataFrame, date_col: str = "dim_collected_date") -> DataFrame:
    return S.moving_averages(ts, "met_price_median", "is_target_segment", date_col, MA_WINDOWS)


def build_series(facts: DataFrame, *, segment_col: str = "is_target",
                 date_col: str = "dim_collected_date",
                 sketch: int = S.DEFAULT_SKETCH, fill_gaps: bool = False) -> DataFrame:
    """fact -> weekly series: grouping sets, medians, 3 moving averages,
    52-week prior join, 4 crossover signals (17 columns).

    Moving averages count rows, as in the reference, so a missed weekly run
    widens the span.  ``fill_gaps=True`` first inserts the missing weeks of
    each segment (metrics NULL, count 0), so the frames count calendar
    weeks instead."""
    ts = series_base(facts, segment_col=segment_col, date_col=date_col, sketch=sketch)
    return series_windows(ts, date_col=date_col, fill_gaps=fill_gaps)


def series_windows(ts: DataFrame, *, date_col: str = "dim_collected_date",
                   fill_gaps: bool = False) -> DataFrame:
    """The window part of the series over the aggregated (date, segment)
    table: moving averages, 52-week prior values, crossovers."""
    if fill_gaps:
        from ..operators.calendar import regularise_series
        ts = regularise_series(ts, ["is_target_segment"], date_col, SERIES_METRICS,
                               fill={"met_listings_count": 0}).drop("is_filled")
    ma = with_moving_averages(ts, date_col)
    yoy = S.yoy_join(ma, "is_target_segment", date_col, PRIOR)
    out = S.crossover(yoy, "met_12_week_ma", "met_52_week_ma", "is_target_segment", date_col,
                      down="is_macd_cross_down", up="is_macd_cross_up")
    out = S.crossover(out, "met_12_week_ma", "met_prior_04_week_ma", "is_target_segment",
                      date_col, down="is_yoy_cross_down", up="is_yoy_cross_up")
    return out.select(date_col, "is_target_segment", *SERIES_METRICS, *MA_WINDOWS,
                      *PRIOR.values(), "is_macd_cross_down", "is_macd_cross_up",
                      "is_yoy_cross_down", "is_yoy_cross_up")


# Pivoted column prefix -> column of the scores.
SCORES = {"is_anomaly": "is_anomaly", "lower_bound": "lower_bound", "upper_bound": "upper_bound",
          "anomaly_prob": "anomaly_probability"}


def wide_scores(det: DataFrame) -> DataFrame:
    """Scores of all metrics side by side, one row per date and segment, under
    their presentation names (I5)."""
    from ..operators.reshape import pivot_wide
    wide = pivot_wide(det, SERIES_KEYS, "dim_metric_name", SERIES_METRICS, SCORES)
    names = {}
    for m in SERIES_METRICS:
        names |= {f"is_anomaly_{m}": f"is_{m.removeprefix('met_')}_anomaly", f"lower_bound_{m}": f"{m}_lower_bound",
                  f"upper_bound_{m}": f"{m}_upper_bound", f"anomaly_prob_{m}": f"{m}_anomaly_probability"}
    return wide.select(*SERIES_KEYS, *[F.col(a).alias(b) for a, b in names.items()])


# ---- P7: the whole chain over stored tables --------------------------------

def run_chain(spark, raw_dir: str, warehouse: str, as_of, *, target_zip: str,
              centre_lon: float, centre_lat: float, target_radius_m: float = 3000.0,
              comps_radius_m: float = 1000.0, segment_col: str = "is_target") -> dict:
    """raw CSV snapshots -> base (incremental) -> fact (incremental, comps
    against the whole base) -> series, anomalies and latest.

    Each layer is a stored table under ``warehouse`` with atomic versions.  A
    table knows what it has taken in: the base its source files, the others
    the loads of the table they read.  So a rerun with nothing new appends
    nothing, a run that died at any point goes on where it stopped, and a load
    without dated or active rows holds up nothing that comes later.  Returns
    DataFrames over the stored tables."""
    from ..functions.casts import parse_date
    from ..operators import anomaly as A
    from ..operators.cleanse import BASE_SPEC, typed_projection
    from ..operators.decompose import decompose
    from ..operators.features import add_target_flag
    from ..operators.reshape import unpivot_metrics
    from ..operators.snapshot import latest_per_key
    from ..operators.spatial import add_comps_ratio
    from ..session import materialize
    from ..sources.csvio import read_snapshots, snapshot_files
    from ..sources.tables import append_load, current_version, not_taken, read_table, rebuild_table, replace_table
    from ..streaming.incremental import after_mark

    base_p, fact_p = f"{warehouse}/base", f"{warehouse}/fact"
    day = "dim_collected_date"

    # Base: files not taken in yet, and of those the rows newer than the mark
    # (S11); without a mark every row, also those without a readable date.
    files = snapshot_files(spark, raw_dir)
    fresh = not_taken(spark, base_p, list(files))
    if fresh:
        raw = read_snapshots(spark, [files[k] for k in fresh])
        new_raw = after_mark(raw, parse_date("collected_date"), read_table(spark, base_p), day, empty_loads_all=True)
        append_load(typed_projection(new_raw, BASE_SPEC), base_p, day, taken=fresh)
    base = read_table(spark, base_p)
    if base is None:
        raise FileNotFoundError(f"no CSV snapshot below {raw_dir}")

    fresh = not_taken(spark, fact_p, current_version(spark, base_p).loads)
    if fresh:
        new_base = read_table(spark, base_p, fresh)
        f = add_fact_metrics(add_target_flag(add_fact_flags(new_base, as_of), as_of, zip_value=target_zip,
                                             centre_lon=centre_lon, centre_lat=centre_lat,
                                             radius_m=target_radius_m), as_of)
        # Comps match on the date, and by the mark each date lies in one load
        # of the base, so the new rows are their own complete reference
        # (S17): no run re-aggregates the points of the whole history.
        f = add_comps_ratio(f, keys=[day, "met_bedrooms"], lon="info_longitude", lat="info_latitude",
                            value="met_price", radius_m=comps_radius_m)
        append_load(f, fact_p, day, taken=fresh)
    fact = read_table(spark, fact_p)
    fact_loads = current_version(spark, fact_p).loads

    # Series: by the mark a week's facts lie in one load, so its aggregate
    # never changes once they landed.  Only new loads are aggregated; the
    # windows are recomputed over the small (week, segment) table.
    agg_p = f"{warehouse}/series_base"
    fresh = not_taken(spark, agg_p, fact_loads)
    if fresh:
        append_load(series_base(read_table(spark, fact_p, fresh), segment_col=segment_col), agg_p, taken=fresh)
    series = rebuild_table(series_windows(read_table(spark, agg_p)), f"{warehouse}/series")
    long = unpivot_metrics(series, SERIES_KEYS, SERIES_METRICS)
    ids = ["is_target_segment", "dim_metric_name"]
    parts = materialize(decompose(long, ids, day, "met_metric_value"))
    params = A.fit_series_models(long, ids, day, "met_metric_value", parts=parts)
    det = A.detect_anomalies(long, params, ids, day, "met_metric_value", 0.95, parts=parts)
    wide = wide_scores(det)
    anomalies = rebuild_table(series.join(wide, SERIES_KEYS, "left"), f"{warehouse}/anomalies")
    # Latest state: latest(stored latest + facts it has not taken in) is exact,
    # also after a run that stopped between the tables.
    latest_p = f"{warehouse}/latest"
    fresh = not_taken(spark, latest_p, fact_loads)
    latest = read_table(spark, latest_p)
    if fresh:
        src = read_table(spark, fact_p, fresh)
        src = src if latest is None else latest.unionByName(src)
        latest = replace_table(latest_per_key(src, "id", [day, "mls_number"]), latest_p, taken=fact_loads)
    return {"base": base, "fact": fact, "series": series, "anomalies": anomalies, "latest": latest}
