"""ARIMA(p, d, q) models by exact likelihood, one per series.

y_t = d y_{t-1} + c + a_t, with a_t an ARMA(p, q), p <= 2 and q <= 1.  d is 1
where the weekly steps have less than ``STEADY`` of the variance of the values
(an autocorrelation beyond 1 - STEADY / 2), else 0.  c is the mean, or for
d = 1 the mean step.

The likelihood comes from a Kalman filter over the weekly values with state
(y_{t-1}, a_t, the part of a_{t+1} known at t).  A missing week is a step
without an observation, so gaps of any length need no filling in and no
differences are lost beside them.  The filter starts from the stationary
covariance of a_t; for d = 1 it starts at the first value, which it takes as
known.  The variance is profiled out: the sum of v^2 / F over n gives it, and
n ln(variance) + sum of ln F + 2 k n / (n - k - 1) is the corrected AIC, with k
counting p + q coefficients, c and the variance.

Each order is fitted by a search on a lattice: partial autocorrelations
(r1, r2) and the moving average th start from ``COARSE`` on every axis of the
order and the step is halved ``HALVINGS`` times around the best point.  All
points stay inside the stationary and invertible region.  Criteria are
compared to six decimals, ties going to fewer coefficients, then to the
smaller point.  An order whose correction is undefined (n <= k + 1) is no
candidate, but (0, 0) always is.

The recursion is ``aggregate`` over the array of a series' weekly values, so
everything runs in the JVM; rows are dealt out by (series, order), a series'
six searches being independent.  ``filter_sql`` is the one place that holds
the recursion; fit and forecast differ in what they keep of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import q as _q
from .decompose import let

ORDERS = [(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (2, 1)]
COARSE = (-0.8, -0.4, 0.0, 0.4, 0.8)
FIRST_STEP = 0.2
HALVINGS = 5
LIMIT = 0.98
STEADY = 0.1
LEAST_VARIANCE = 1e-12
UNDEFINED = 1e300  # criterion of an order that is no candidate


def coefficients_sql(r1: str, r2: str, th: str) -> str:
    """Struct (f1, f2, th) of the ARMA coefficients, and the stationary
    covariance (p11, p12, p22) for innovations of variance one."""
    return let("f", f"named_struct('f1', {r1} * (1D - {r2}), 'f2', {r2}, 'th', {th})", let(
        "p", "(2D * f.f1 * f.th / (1D - f.f2) + f.th * f.th + 1D) / "
             "(1D - f.f1 * f.f1 - f.f2 * f.f2 - 2D * f.f1 * f.f1 * f.f2 / (1D - f.f2))",
        "named_struct('f1', f.f1, 'f2', f.f2, 'th', f.th, 'p11', p, 'p12', (f.f1 * f.f2 * p + f.th) / (1D - f.f2), "
        "'p22', f.f2 * f.f2 * p + f.th * f.th)"))


def _stationary_step(c: str, m: str) -> tuple[str, str]:
    """Start and step for d = 0, where y_{t-1} is no part of the state."""
    start = (f"named_struct('a1', 0D, 'a2', 0D, 'p11', {m}.p11, 'p12', {m}.p12, 'p22', {m}.p22, 'v2', 0D, 'lf', 0D")
    seen = let("g", "s.p12 / s.p11", let("e", f"y - {c} - s.a1", (
        f"named_struct('a1', {m}.f1 * (s.a1 + e) + s.a2 + g * e, 'a2', {m}.f2 * (s.a1 + e), "
        f"'p11', s.p22 - g * s.p12 + 1D, 'p12', {m}.th, 'p22', {m}.th * {m}.th, "
        "'v2', s.v2 + e * e / s.p11, 'lf', s.lf + ln(s.p11)%s)")))
    missed = (f"named_struct('a1', {m}.f1 * s.a1 + s.a2, 'a2', {m}.f2 * s.a1, "
              f"'p11', {m}.f1 * {m}.f1 * s.p11 + 2D * {m}.f1 * s.p12 + s.p22 + 1D, "
              f"'p12', {m}.f1 * {m}.f2 * s.p11 + {m}.f2 * s.p12 + {m}.th, "
              f"'p22', {m}.f2 * {m}.f2 * s.p11 + {m}.th * {m}.th, 'v2', s.v2, 'lf', s.lf%s)")
    return start, f"IF(y IS NULL, {missed}, {seen})"


def _integrated_step(c: str, first: str, m: str) -> tuple[str, str]:
    """Start and step for d = 1, with y_{t-1} as part l of the state."""
    start = (f"named_struct('l', CAST({first} AS DOUBLE), 'a1', 0D, 'a2', 0D, 'pl', 0D, 'q1', 0D, 'q2', 0D, "
             f"'p11', {m}.p11, 'p12', {m}.p12, 'p22', {m}.p22, 'v2', 0D, 'lf', 0D")
    gain = (f"named_struct('e', coalesce(y - s.l - s.a1 - {c}, 0D), 'v', v, 'l', IF(y IS NULL, 0D, (s.pl + s.q1) / v), "
            "'a1', IF(y IS NULL, 0D, (s.q1 + s.p11) / v), 'a2', IF(y IS NULL, 0D, (s.q2 + s.p12) / v))")
    seen = ("named_struct('l', s.l + g.l * g.e, 'a1', s.a1 + g.a1 * g.e, 'a2', s.a2 + g.a2 * g.e, "
            "'pl', s.pl - g.l * g.l * g.v, 'q1', s.q1 - g.l * g.a1 * g.v, 'q2', s.q2 - g.l * g.a2 * g.v, "
            "'p11', s.p11 - g.a1 * g.a1 * g.v, 'p12', s.p12 - g.a1 * g.a2 * g.v, 'p22', s.p22 - g.a2 * g.a2 * g.v)")
    ahead = (f"named_struct('l', u.l + u.a1 + {c}, 'a1', {m}.f1 * u.a1 + u.a2, 'a2', {m}.f2 * u.a1, "
             f"'pl', u.pl + 2D * u.q1 + u.p11, 'q1', {m}.f1 * (u.q1 + u.p11) + u.q2 + u.p12, "
             f"'q2', {m}.f2 * (u.q1 + u.p11), "
             f"'p11', {m}.f1 * {m}.f1 * u.p11 + 2D * {m}.f1 * u.p12 + u.p22 + 1D, "
             f"'p12', {m}.f1 * {m}.f2 * u.p11 + {m}.f2 * u.p12 + {m}.th, "
             f"'p22', {m}.f2 * {m}.f2 * u.p11 + {m}.th * {m}.th, "
             "'v2', s.v2 + IF(y IS NULL, 0D, g.e * g.e / g.v), 'lf', s.lf + IF(y IS NULL, 0D, ln(g.v))%s)")
    return start, let("v", "s.pl + 2D * s.q1 + s.p11", let("g", gain, let("u", seen, ahead)))


def filter_sql(values: str, d: str, c: str, first: str, m: str, keep: bool) -> str:
    """SQL text of the filter over an array of values.

    ``first``: the value before the array (used if d is 1); ``m``: a variable
    holding ``coefficients_sql``.  The result is a struct with the sums v2
    (of v^2 / F) and lf (of ln F); with ``keep`` also ``out``, an array of the
    one-step forecasts and their variances (f, v)."""
    def run(start: str, step: str, forecast: str, variance: str) -> str:
        kept0 = ", 'out', slice(array(named_struct('f', 0D, 'v', 0D)), 1, 0)" if keep else ""
        kept = f", 'out', concat(s.out, array(named_struct('f', {forecast}, 'v', {variance})))" if keep else ""
        last = "named_struct('v2', s.v2, 'lf', s.lf" + (", 'out', s.out)" if keep else ")")
        return f"aggregate({values}, {start}{kept0}), (s, y) -> {step.replace('%s', kept)}, s -> {last})"

    plain = run(*_stationary_step(c, m), f"{c} + s.a1", "s.p11")
    summed = run(*_integrated_step(c, first, m), f"s.l + s.a1 + {c}", "s.pl + 2D * s.q1 + s.p11")
    return f"IF({d} = 0, {plain}, {summed})"


def series_arrays(weeks: DataFrame, ids: list[str], slot: str, value: str) -> DataFrame:
    """One row a series: __y (values by week, NULL in gaps), __n (observed),
    __d, __c, __at (slot of the first value) and __first (that value)."""
    qi, S, V = ", ".join(_q(i) for i in ids), _q(slot), _q(value)
    x = weeks.selectExpr(*[_q(i) for i in ids], f"{S} AS __slot", f"CAST({V} AS DOUBLE) AS __v",
                         f"{V} - lag({V}, 1) OVER (PARTITION BY {qi} ORDER BY {S}) AS __dv")
    g = x.groupBy(*ids).agg(*[F.expr(e) for e in (
        "transform(sort_array(collect_list(named_struct('t', __slot, 'v', __v))), r -> r.v) AS __all",
        "count(__v) AS __n0", "avg(__v) AS __mean",
        f"coalesce(CAST(var_samp(__dv) < {STEADY!r}D * var_samp(__v) AS INT), 0) AS __d",
        "min(__slot) AS __lo", "min(__slot) FILTER (WHERE __v IS NOT NULL) AS __at",
        "max(__slot) FILTER (WHERE __v IS NOT NULL) AS __end",
        "min_by(__v, __slot) FILTER (WHERE __v IS NOT NULL) AS __first",
        "max_by(__v, __slot) FILTER (WHERE __v IS NOT NULL) AS __last")])
    g = g.where("__n0 > 0")
    return g.selectExpr(
        *[_q(i) for i in ids], "CAST(__at - __lo AS INT) AS __at", "__d", "__n0 - __d AS __n", "__first",
        "CASE WHEN __d = 1 THEN (__last - __first) / (__end - __at) ELSE __mean END AS __c",
        "CASE WHEN __d = 1 THEN slice(__all, __at - __lo + 2, size(__all)) ELSE __all END AS __y")


def _criterion_sql(k: str) -> str:
    """Corrected AIC (six decimals) of a filter result ``r``."""
    body = f"__n * ln(greatest(r.v2 / __n, {LEAST_VARIANCE!r}D)) + r.lf"
    return (f"round(CASE WHEN __n > {k} + 1 THEN {body} + 2D * {k} * __n / (__n - {k} - 1) "
            f"WHEN {k} = 2 THEN {body} + 4D ELSE {UNDEFINED!r}D END, 6)")


def _searched(points: str) -> str:
    """SQL text: the best of an array of points (r1, r2, th)."""
    run = let("m", coefficients_sql("x.r1", "x.r2", "x.th"), filter_sql("__y", "__d", "__c", "__first", "m", False))
    return (f"array_min(transform({points}, x -> " + let(
        "r", run, f"named_struct('aic', {_criterion_sql('__k')}, 'r1', x.r1, 'r2', x.r2, 'th', x.th, "
                  "'v2', r.v2)") + "))")


def _lattice(a: str, b: str, c: str) -> str:
    return (f"flatten(transform({a}, i -> flatten(transform({b}, j -> transform({c}, h -> "
            "named_struct('r1', i, 'r2', j, 'th', h))))))")


def fit_arma(weeks: DataFrame, ids: list[str], slot: str, value: str) -> DataFrame:
    """One row of parameters per series id: d, p, q, n (scored values),
    intercept, phi1, phi2, theta, sigma, aic."""
    axis = "array(" + ", ".join(f"{x!r}D" for x in COARSE) + ")"
    near = "array(-1D, 0D, 1D)"
    orders = ", ".join(f"named_struct('p', {p}, 'q', {q})" for p, q in ORDERS)
    qs = [_q(i) for i in ids]
    x = series_arrays(weeks, ids, slot, value).selectExpr("*", f"inline(array({orders}))").selectExpr(
        "*", "CAST(p + q + 2 AS LONG) AS __k")
    # a fixed number of partitions: the searches are work, not bytes
    x = x.repartition(4 * weeks.sparkSession.sparkContext.defaultParallelism, *ids, "p", "q")
    used = ["p >= 1", "p = 2", "q = 1"]
    axes = [f"IF({u}, {axis}, array(0D))" for u in used]
    x = x.selectExpr("*", f"{_searched(_lattice(*axes))} AS __best")
    step = FIRST_STEP
    for _ in range(HALVINGS):
        axes = [f"transform(IF({u}, {near}, array(0D)), o -> greatest({-LIMIT!r}D, least({LIMIT!r}D, "
                f"__best.{r} + o * {step!r}D)))" for u, r in zip(used, ("r1", "r2", "th"))]
        x = x.selectExpr("* except (__best)", f"{_searched(_lattice(*axes))} AS __best")
        step /= 2
    # no filter on __best: pushed down, it would repeat the searches
    rows = x.groupBy(*ids).agg(
        F.expr("min(named_struct('aic', __best.aic, 'k', p + q, 'p', p, 'r1', __best.r1, 'r2', __best.r2, "
               "'th', __best.th, 'q', q, 'v2', __best.v2, 'd', __d, 'n', __n, 'c', __c))").alias("b"))
    return rows.selectExpr(*qs, "b.d AS d", "b.p AS p", "b.q AS q", "b.n AS n", "b.c AS intercept",
                           "b.r1 * (1D - b.r2) AS phi1", "b.r2 AS phi2", "b.th AS theta",
                           "sqrt(b.v2 / b.n) AS sigma", "b.aic AS aic")


def forecast_arma(weeks: DataFrame, params: DataFrame, ids: list[str], slot: str, value: str) -> DataFrame:
    """One-step forecasts within the history: ids, slot, __forecast and
    __deviation (of the forecast error), one row a week and series; NULL up to
    the first value of a series with d = 1."""
    qs, S = [_q(i) for i in ids], _q(slot)
    x = series_arrays(weeks, ids, slot, value).join(
        params.selectExpr(*qs, "phi1 AS __f1", "phi2 AS __f2", "theta AS __th", "sigma AS __sigma"), ids)
    run = let("m", coefficients_sql("(__f1 / (1D - __f2))", "__f2", "__th"),
              filter_sql("__y", "__d", "__c", "__first", "m", True) + ".out")
    head = "IF(__d = 1, array_repeat(CAST(NULL AS STRUCT<f: DOUBLE, v: DOUBLE>), __at + 1), slice(array(" \
           "CAST(NULL AS STRUCT<f: DOUBLE, v: DOUBLE>)), 1, 0))"
    x = x.selectExpr(*qs, "__sigma", f"posexplode(concat({head}, {run})) AS (__slot, __o)")
    return x.selectExpr(*qs, f"__slot AS {S}", "__o.f AS __forecast", "__sigma * sqrt(__o.v) AS __deviation")
