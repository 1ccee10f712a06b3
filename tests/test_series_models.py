"""Decomposition and ARIMA models against closed forms, brute force and
planted events."""

import datetime as dt
import math

import numpy as np
import pytest

from lodestar.operators import anomaly as A
from lodestar.operators import arma as R
from lodestar.operators import decompose as D

START = dt.date(2015, 1, 5)  # a Monday
LONG = "sid string, d date, v double"


def weekly(spark, series):
    rows = [(sid, START + dt.timedelta(days=7 * t), None if y is None else float(y))
            for sid, ys in series.items() for t, y in enumerate(ys) if y is not None]
    return spark.createDataFrame(rows, LONG)


def arma_covariance(f1, f2, th, n):
    """Covariance of n values, from 600 terms of the moving-average form."""
    psi = [1.0, f1 + th]
    while len(psi) < 600:
        psi.append(f1 * psi[-1] + f2 * psi[-2])
    psi = np.array(psi)
    gamma = [float(psi[:len(psi) - k] @ psi[k:]) for k in range(n)]
    return np.array([[gamma[abs(i - j)] for j in range(n)] for i in range(n)])


@pytest.mark.parametrize("d", [0, 1])
@pytest.mark.parametrize("r1,r2,th", [(0.0, 0.0, 0.0), (0.6, 0.0, 0.0), (0.0, 0.0, 0.7), (-0.5, 0.0, 0.4),
                                      (0.5, -0.4, 0.0), (0.7, 0.3, -0.6)])
def test_likelihood_equals_the_normal_density(spark, d, r1, r2, th):
    rng = np.random.default_rng(4)
    y = rng.normal(size=25) * 2
    gone = {3, 4, 5, 11, 24}
    f1, f2, c, first = r1 * (1 - r2), r2, 0.3, 1.5
    cov = arma_covariance(f1, f2, th, len(y))
    if d:
        step = np.tril(np.ones((len(y), len(y))))
        cov, mean = step @ cov @ step.T, first + c * np.arange(1, len(y) + 1)
    else:
        mean = np.full(len(y), c)
    seen = [i for i in range(len(y)) if i not in gone]
    e, s = (y - mean)[seen], cov[np.ix_(seen, seen)]
    values = "array(" + ", ".join("CAST(NULL AS DOUBLE)" if i in gone else f"{v!r}D" for i, v in enumerate(y.tolist())) + ")"
    sql = D.let("m", R.coefficients_sql(f"{r1!r}D", f"{r2!r}D", f"{th!r}D"),
                R.filter_sql(values, str(d), f"{c!r}D", f"{first!r}D", "m", True))
    got = spark.range(1).selectExpr(f"{sql} AS r").first().r
    assert math.isclose(got.v2, float(e @ np.linalg.solve(s, e)), rel_tol=1e-8)
    assert math.isclose(got.lf, float(np.linalg.slogdet(s)[1]), rel_tol=1e-8, abs_tol=1e-8)
    # one-step forecasts: regression on all that was seen before
    for t in range(len(y)):
        past = [i for i in seen if i < t]
        w = np.linalg.solve(cov[np.ix_(past, past)], cov[past, t]) if past else np.zeros(0)
        assert math.isclose(got.out[t].f, float(mean[t] + w @ (y - mean)[past]), rel_tol=1e-7, abs_tol=1e-7)
        assert math.isclose(got.out[t].v, float(cov[t, t] - w @ cov[past, t]), rel_tol=1e-7)


def simulate(rng, n, f1=0.0, th=0.0):
    e = rng.normal(size=n + 50)
    a = [0.0]
    for t in range(1, n + 50):
        a.append(f1 * a[-1] + e[t] + th * e[t - 1])
    return np.array(a[50:])


def test_orders_and_coefficients_found(spark):
    rng = np.random.default_rng(9)
    series = {"ar": simulate(rng, 400, 0.7), "ma": simulate(rng, 400, 0.0, 0.8),
              "walk": np.cumsum(rng.normal(size=400)) * 3, "flat": [5.0] * 60, "two": [1.0, 2.0], "one": [4.0]}
    series = {k: [None if k in ("ar", "ma") and rng.random() < 0.2 and 0 < t < 399 else y for t, y in enumerate(v)]
              for k, v in series.items()}
    weeks = D.weekly_spine(weekly(spark, series), ["sid"], "d", "v")
    got = {r.sid: r for r in R.fit_arma(weeks, ["sid"], "__slot", "__value").collect()}
    assert set(got) == set(series)
    assert got["ar"].d == 0 and abs(got["ar"].phi1 + got["ar"].theta - 0.7) < 0.2 and abs(got["ar"].sigma - 1) < 0.15
    assert got["ma"].d == 0 and got["ma"].q == 1 and got["ma"].theta > 0.6

    def criterion(sid, f1, f2, th, k):
        seen = [i for i, v in enumerate(series[sid]) if v is not None]
        v = np.array([series[sid][i] for i in seen])
        cov, n = arma_covariance(f1, f2, th, 400)[np.ix_(seen, seen)], len(v)
        e = v - v.mean()
        return (n * math.log(e @ np.linalg.solve(cov, e) / n) + np.linalg.slogdet(cov)[1] + 2 * k * n / (n - k - 1))

    for sid, truth in (("ar", (0.7, 0.0, 0.0, 3)), ("ma", (0.0, 0.0, 0.8, 3))):
        r = got[sid]
        mine = criterion(sid, r.phi1, r.phi2, r.theta, r.p + r.q + 2)
        assert abs(mine - r.aic) < 1e-4 and mine <= criterion(sid, *truth)
    assert got["walk"].d == 1 and abs(got["walk"].sigma - 3) < 0.5
    assert (got["flat"].p, got["flat"].q, got["flat"].intercept, got["flat"].sigma) == (0, 0, 5.0, 0.0)
    assert got["one"].n == 1 and got["two"].n == 2 and got["two"].p == 0


def plain_cuts(y, noise, penalty, least):
    """Optimal partition by trying every last segment for every prefix."""
    n = len(y)
    cost = lambda a, b: float(np.square(y[a:b] - y[a:b].mean()).sum()) / noise + penalty * math.log(n)
    best = {0: (0.0, [])}
    for t in range(least, n + 1):
        best[t] = min((best[s][0] + cost(s, t), best[s][1] + [s]) for s in best if s <= t - least)
    return best[n][1]


def test_change_points_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    for k in range(6):
        y = rng.normal(size=60) + np.repeat(rng.normal(size=6) * 4, 10)
        centred = y - y.mean()
        s, q = np.cumsum(centred), np.cumsum(centred ** 2)
        prefix = "array(" + ", ".join(f"named_struct('s', {a!r}D, 'q', {b!r}D)" for a, b in
                                      zip([0.0, *s.tolist()], [0.0, *q.tolist()])) + ")"
        sql = D.let("z", f"named_struct('n', 60, 'prefix', {prefix}, 'var', 1.5D)",
                    D.level_cuts_sql("z.n", "z.prefix", "z.var", 2.0, 5))
        assert list(spark.range(1).selectExpr(f"{sql} AS c").first().c) == plain_cuts(y, 1.5, 2.0, 5)


def test_planted_shifts_spikes_and_holidays(spark):
    rng = np.random.default_rng(6)
    n = 330
    days = [START + dt.timedelta(days=7 * t) for t in range(n)]
    thanks = [any((d + dt.timedelta(days=k)).month == 11 and (d + dt.timedelta(days=k)).weekday() == 3
                  and 22 <= (d + dt.timedelta(days=k)).day <= 28 for k in range(7)) for d in days]
    base = rng.normal(size=n)
    shifted = base + np.where(np.arange(n) >= 120, 9.0, 0.0) - np.where(np.arange(n) >= 250, 5.0, 0.0)
    spiked = base.copy()
    spiked[[70, 200]] += 25.0
    feast = base + np.where(thanks, 12.0, 0.0)
    season = base + 6 * np.sin(2 * np.pi * np.arange(n) / (365.25 / 7))
    long = weekly(spark, {"shifted": shifted, "spiked": spiked, "feast": feast, "season": season, "base": base})
    got = {}
    for r in D.decompose(long, ["sid"], "d", "v").collect():
        got.setdefault(r.sid, {})[r["__slot"]] = r
    shifts = {sid: [t for t, r in sorted(rows.items()) if r["__shift"]] for sid, rows in got.items()}
    assert len(shifts["shifted"]) == 2 and abs(shifts["shifted"][0] - 120) <= 1 and abs(shifts["shifted"][1] - 250) <= 2
    assert shifts["base"] == [] and shifts["spiked"] == [] and shifts["season"] == []
    assert {70, 200} <= {t for t, r in got["spiked"].items() if r["__spike"]}
    effect = [r["__effect"] for t, r in got["feast"].items() if thanks[t]]
    assert len(effect) >= 6 and all(abs(e - 12.0) < 2.0 for e in effect)
    wave = np.array([got["season"][t]["__season"] for t in range(n)])
    assert np.corrcoef(wave, 6 * np.sin(2 * np.pi * np.arange(n) / (365.25 / 7)))[0, 1] > 0.9
    for rows in got.values():
        for r in rows.values():
            assert math.isclose(r["__value"], r["__level"] + r["__trend"] + r["__effect"] + r["__season"] + r["__rest"],
                                abs_tol=1e-9)


def test_scores_keep_every_row(spark):
    rng = np.random.default_rng(7)
    y = 50 + rng.normal(size=150)
    y[90] += 20
    rows = [("a", START + dt.timedelta(days=7 * t + (1 if t == 40 else 0)), float(v)) for t, v in enumerate(y) if t % 11 != 5]
    rows += [("a", None, 3.0), ("b", None, 1.0), ("a", START + dt.timedelta(days=7 * 150), None), rows[0]]
    long = spark.createDataFrame(rows, LONG)
    params = A.fit_series_models(long, ["sid"], "d", "v")
    got = A.detect_anomalies(long, params, ["sid"], "d", "v", components=True).collect()
    assert len(got) == len(rows)
    late = next(r for r in got if r.d == START + dt.timedelta(days=281))
    assert late.lower_bound is not None  # a run on another weekday is scored in its week
    assert all(r.lower_bound is None and not r.is_anomaly for r in got if r.d is None)
    hit = next(r for r in got if r.d == START + dt.timedelta(days=630))
    assert hit.is_anomaly and hit.is_spike and hit.anomaly_probability > 0.999
    share = np.mean([r.is_anomaly for r in got if r.lower_bound is not None])
    assert share < 0.15


def test_models_of_an_empty_table(spark):
    none = spark.createDataFrame([], LONG)
    params = A.fit_series_models(none, ["sid"], "d", "v")
    assert params.collect() == [] and A.detect_anomalies(none, params, ["sid"], "d", "v").collect() == []


def test_no_pair_join_in_the_plan(spark):
    long = weekly(spark, {"a": [1.0, 2.0, 3.0], "b": [2.0, 1.0, 5.0]})
    parts = D.decompose(long, ["sid"], "d", "v")
    plan = A.detect_anomalies(long, A.fit_series_models(long, ["sid"], "d", "v", parts=parts), ["sid"], "d", "v",
                              parts=parts)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
