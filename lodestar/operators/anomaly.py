"""Per-series models and anomaly bands (I1-I4 together).

A weekly series is decomposed into level, trend, US-holiday effect, season
and remainder (``decompose``); an ARIMA model is fitted to the remainder with
spikes left out as gaps (``arma``); every point of the training history is
scored against parts + one-step forecast:

  band = parts + forecast +- z_q s,  s the forecast error's deviation,
  probability = P(|N(0,1)| < |e| / s),  is_anomaly = |e| > z_q s

(z_q: two-sided quantile of the threshold).  A point without a forecast (the
first of a differenced series, or a row without a date) has NULL bounds and is
no anomaly; with s = 0 the band is the forecast and the probability NULL.

All steps are windows, aggregates and array expressions by series id, so many
series run side by side; the long series holds one row per week and id, so its
size does not depend on the fact table.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame

from ..functions._util import q as _q
from ..functions.stats import two_sided_probability_sql
from .arma import fit_arma, forecast_arma
from .decompose import decompose

PARTS = ["__level", "__trend", "__effect", "__season"]


def _remainder(parts: DataFrame) -> DataFrame:
    """The weekly remainder with spikes as gaps."""
    return parts.selectExpr("*", "CASE WHEN NOT __spike THEN __rest END AS __fit")


def fit_series_models(long: DataFrame, ids: list[str], ts: str, value: str, *,
                      parts: DataFrame | None = None) -> DataFrame:
    """One row of parameters per series id: d, p, q, n, intercept, phi1, phi2,
    theta, sigma, aic.  ``parts``: the decomposition, if it is at hand."""
    parts = decompose(long, ids, ts, value) if parts is None else parts
    return fit_arma(_remainder(parts), ids, "__slot", "__fit")


def score_weeks(parts: DataFrame, params: DataFrame, ids: list[str]) -> DataFrame:
    """The decomposition with ``__expected`` (parts + forecast) and
    ``__deviation`` of every week."""
    f = forecast_arma(_remainder(parts), params, ids, "__slot", "__fit")
    return parts.join(f, [*ids, "__slot"], "left").selectExpr(
        "*", f"{' + '.join(PARTS)} + __forecast AS __expected")


def detect_anomalies(long: DataFrame, params: DataFrame, ids: list[str], ts: str, value: str,
                     threshold: float = 0.95, *, parts: DataFrame | None = None,
                     components: bool = False) -> DataFrame:
    """Score every row of the training history against its series model: adds
    is_anomaly, lower_bound, upper_bound, anomaly_probability; with
    ``components`` also level, trend, holiday_effect, season, is_level_shift
    and is_spike of its week."""
    zq = NormalDist().inv_cdf((1.0 + threshold) / 2.0)
    qi, T, V = ", ".join(_q(i) for i in ids), _q(ts), _q(value)
    parts = decompose(long, ids, ts, value) if parts is None else parts
    weeks = score_weeks(parts, params, ids).selectExpr(
        *[_q(i) for i in ids], "__slot", "__expected", "__deviation", *PARTS, "__shift", "__spike")
    day = f"CAST({T} AS DATE)"
    first = f"min(CASE WHEN {V} IS NOT NULL THEN {day} END) OVER (PARTITION BY {qi})"
    x = long.selectExpr("*", f"CAST(floor(datediff({day}, {first}) / 7) AS INT) AS __slot")
    x = x.join(weeks, [*ids, "__slot"], "left").selectExpr("*", f"{V} - __expected AS __e")
    band = f"({zq!r}D * __deviation)"
    more = ["__level AS level", "__trend AS trend", "__effect AS holiday_effect", "__season AS season",
            "coalesce(__shift, false) AS is_level_shift", "coalesce(__spike, false) AS is_spike"]
    return x.selectExpr(
        *[_q(i) for i in ids], T, V,
        f"coalesce(abs(__e) > {band}, false) AS is_anomaly",
        f"__expected - {band} AS lower_bound", f"__expected + {band} AS upper_bound",
        f"CASE WHEN __deviation > 0 THEN {two_sided_probability_sql('__e / __deviation')} END "
        "AS anomaly_probability", *(more if components else []))
