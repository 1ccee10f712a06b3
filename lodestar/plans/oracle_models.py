"""DuckDB oracle SQL of the series models: weekly spine, change points,
seasonal-trend smoothing and ARIMA by a Kalman filter, each re-stated as plain
windows and recursive CTEs over rows (the engine folds arrays).

All fragments read ``long`` (is_target_segment, dim_metric_name,
dim_collected_date, met_metric_value) and ``hol`` (week_start, holiday_name).
Fixed values of the model (spans, penalties, lattices, thresholds) are stated
here once more, as the contract of the query.
"""

from __future__ import annotations

from statistics import NormalDist

Z95 = NormalDist().inv_cdf(0.975)
_I = "is_target_segment, dim_metric_name"

# Federal holidays since 1986, stated apart from the engine's rules
# as (month, ISO weekday, n-th) and as month and day.
_NTH = {"Martin Luther King Jr. Day": (1, 1, 3), "Washington''s Birthday": (2, 1, 3), "Labor Day": (9, 1, 1),
        "Columbus Day": (10, 1, 2), "Thanksgiving Day": (11, 4, 4)}
_FIXED = {"New Year''s Day": "01-01", "Independence Day": "07-04", "Veterans Day": "11-11", "Christmas Day": "12-25"}


def holiday_days(first: str, last: str) -> str:
    """Every day from the year of ``first`` to that of ``last`` that is a
    holiday, with its name: the n-th given weekday of its month, the last
    Monday of May, or a fixed day."""
    nth = " ".join(f"WHEN month(d) = {m} AND isodow(d) = {w} AND (day(d) + 6) // 7 = {n} THEN '{name}'"
                   for name, (m, w, n) in _NTH.items())
    fixed = " ".join(f"WHEN strftime(d, '%m-%d') = '{md}' THEN '{name}'" for name, md in _FIXED.items())
    return f"""SELECT d, name FROM (
    SELECT d, CASE {nth} {fixed}
      WHEN month(d) = 5 AND isodow(d) = 1 AND day(d) > 24 THEN 'Memorial Day'
      WHEN strftime(d, '%m-%d') = '06-19' AND year(d) >= 2021 THEN 'Juneteenth' END AS name
    FROM (SELECT CAST(unnest(generate_series(date_trunc('year', {first}),
      date_trunc('year', {last}) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d))
  WHERE name IS NOT NULL"""


def _holidays() -> str:
    days = holiday_days("(SELECT min(wk) FROM weeks)", "(SELECT max(wk) FROM weeks)")
    return f"""hol AS MATERIALIZED (
  SELECT CAST(date_trunc('week', d) AS DATE) AS week_start, min(name) AS holiday_name FROM ({days}) GROUP BY 1)"""


WEEKS = [f"""dated AS MATERIALIZED (
  SELECT *, date_diff('day', min(CAST(dim_collected_date AS DATE)) OVER (PARTITION BY {_I}), CAST(dim_collected_date AS DATE)) // 7 AS slot,
         min(CAST(dim_collected_date AS DATE)) OVER (PARTITION BY {_I}) AS day0
  FROM long WHERE dim_collected_date IS NOT NULL AND met_metric_value IS NOT NULL)""",
         f"""weeks AS MATERIALIZED (
  SELECT s.*, v.value, CAST(s.day0 + CAST(7 * s.slot AS INTEGER) AS DATE) AS wk FROM (
    SELECT {_I}, day0, unnest(range(max(slot) + 1)) AS slot FROM dated GROUP BY {_I}, day0) s
  LEFT JOIN (SELECT {_I}, slot, avg(met_metric_value) AS value FROM dated GROUP BY {_I}, slot) v USING ({_I}, slot))""",
         _holidays(),
         f"""r0 AS MATERIALIZED (
  SELECT {_I}, slot, value, holiday_name, least(weekofyear(wk), 52) AS phase,
         coalesce(value, 0.0) AS x, CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END AS w
  FROM weeks LEFT JOIN hol ON week_start = CAST(date_trunc('week', wk) AS DATE))"""]


def _smooth(src: str, dst: str) -> list[str]:
    """One smoothing round: ``src`` has x and w, ``dst`` adds the parts, the
    remainder and the weights nw of a next round."""
    near = f"OVER (PARTITION BY {_I} ORDER BY slot ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING)"
    return [f"""{dst}_t AS (
  SELECT *, CASE WHEN sw * b - a * a > 1e-6 * sw * sw THEN (b * sx - a * ax) / (sw * b - a * a)
                 WHEN sw > 0 THEN sx / sw ELSE 0.0 END AS trend
  FROM (SELECT *, st - slot * sw AS a, stt - 2 * slot * st + slot * slot * sw AS b, stx - slot * sx AS ax FROM (
    SELECT *, sum(w) {near} AS sw, sum(w * slot) {near} AS st, sum(w * slot * slot) {near} AS stt,
           sum(w * x) {near} AS sx, sum(w * slot * x) {near} AS stx FROM {src})))""",
            f"""{dst}_h AS (
  SELECT t.*, CASE WHEN t.holiday_name IS NOT NULL AND h.n >= 2 AND h.w > 0 THEN h.wd / h.w - coalesce(b.base, 0.0) ELSE 0.0 END AS effect
  FROM {dst}_t t
  LEFT JOIN (SELECT {_I}, holiday_name, count(value) AS n, sum(w) AS w, sum(w * (x - trend)) AS wd FROM {dst}_t
             GROUP BY {_I}, holiday_name) h USING ({_I}, holiday_name)
  LEFT JOIN (SELECT {_I}, sum(w * (x - trend)) / nullif(sum(w), 0) AS base FROM {dst}_t WHERE holiday_name IS NULL
             GROUP BY {_I}) b USING ({_I}))""",
            f"""{dst}_s AS (
  SELECT h.*, CASE WHEN max(slot) OVER (PARTITION BY {_I}) + 1 >= 104
    THEN raw - avg(raw) OVER (PARTITION BY {_I}) ELSE 0.0 END AS season
  FROM (SELECT h.*, coalesce(p.raw, 0.0) AS raw FROM {dst}_h h LEFT JOIN (
    SELECT {_I}, phase, sum(w * (x - trend - effect)) / nullif(sum(w), 0) AS raw FROM {dst}_h GROUP BY {_I}, phase) p
    USING ({_I}, phase)) h)""",
            f"""{dst} AS MATERIALIZED (
  SELECT *, CASE WHEN value IS NULL THEN 0.0 WHEN far = 0 THEN 1.0 WHEN abs(rest) >= far THEN 0.0
                 ELSE pow(1 - pow(rest / far, 2), 2) END AS nw
  FROM (SELECT *, 6.0 * median(abs(rest)) OVER (PARTITION BY {_I}) AS far
        FROM (SELECT *, CASE WHEN value IS NOT NULL THEN x - trend - effect - season END AS rest FROM {dst}_s)))"""]


# Optimal partitioning: one step a week, the costs of all prefixes so far in a
# list; then the cuts followed back from the end.
LEVELS = [f"""plain AS MATERIALIZED (
  SELECT *, count(p) OVER (PARTITION BY {_I} ORDER BY slot ROWS UNBOUNDED PRECEDING) AS k,
         p - avg(p) OVER (PARTITION BY {_I}) AS c, avg(p) OVER (PARTITION BY {_I}) AS mean,
         lag(r) OVER (PARTITION BY {_I} ORDER BY slot) AS r1
  FROM (SELECT *, CASE WHEN nw > 0 THEN value - effect - season END AS p, CASE WHEN nw > 0 THEN rest END AS r FROM f1))""",
          f"""op_in AS MATERIALIZED (
  SELECT {_I}, count(p) AS n, any_value(mean) AS mean,
         list_prepend(0.0, list(sc ORDER BY slot) FILTER (WHERE p IS NOT NULL)) AS ss,
         list_prepend(0.0, list(sq ORDER BY slot) FILTER (WHERE p IS NOT NULL)) AS qq,
         pow(coalesce(median(abs(r)), 0.0) / 0.6744897501960817, 2) * (1 + any_value(rho)) / (1 - any_value(rho)) AS var
  FROM (SELECT *, sum(c) OVER (PARTITION BY {_I} ORDER BY slot ROWS UNBOUNDED PRECEDING) AS sc,
               sum(c * c) OVER (PARTITION BY {_I} ORDER BY slot ROWS UNBOUNDED PRECEDING) AS sq FROM plain)
  JOIN (SELECT {_I}, greatest(0.0, least(0.9, coalesce(sum(r * r1) / nullif(sum(r * r) FILTER (WHERE r1 IS NOT NULL), 0), 0.0))) AS rho
        FROM plain GROUP BY {_I}) USING ({_I})
  GROUP BY {_I})""",
          f"""op AS (
  SELECT {_I}, 8 AS t, list_concat([floor(-6.0 * ln(n) * 1e6 + 0.5) / 1e6], list_transform(range(7), lambda i: 1e12)) AS f,
         list_transform(range(8), lambda i: CAST(0 AS BIGINT)) AS b
  FROM op_in WHERE n >= 16 AND var > 0
  UNION ALL
  SELECT {_I}, t + 1, list_append(f, best.c), list_append(b, best.s) FROM (
    SELECT o.*, list_min(list_transform(range(t - 8 + 1), lambda s: {{'c': floor((o.f[s + 1]
        + greatest(0.0, i.qq[t + 1] - i.qq[s + 1] - (i.ss[t + 1] - i.ss[s + 1]) * (i.ss[t + 1] - i.ss[s + 1]) / (t - s)) / i.var + 6.0 * ln(i.n)) * 1e6 + 0.5) / 1e6, 's': s}})) AS best
    FROM op o JOIN op_in i USING ({_I}) WHERE t <= i.n) o)""",
          f"""cuts AS (
  SELECT o.{_I.replace(', ', ', o.')}, i.n AS b, o.b[i.n + 1] AS a, o.b AS back FROM op o JOIN op_in i USING ({_I}) WHERE o.t = i.n + 1
  UNION ALL
  SELECT {_I}, a, back[a + 1], back FROM cuts WHERE a > 0)""",
          f"""segments AS MATERIALIZED (
  SELECT {_I}, a, b, mean + (ss[b + 1] - ss[a + 1]) / (b - a) AS level FROM (
    SELECT {_I}, a, b FROM cuts
    UNION ALL SELECT {_I}, 0, n FROM op_in WHERE NOT (n >= 16 AND var > 0)) JOIN op_in USING ({_I}))""",
          f"""g0 AS MATERIALIZED (
  SELECT p.{_I.replace(', ', ', p.')}, p.slot, p.value, p.holiday_name, p.phase, s.level,
         s.a > 0 AND p.k = s.a + 1 AND p.p IS NOT NULL AS is_shift,
         coalesce(p.value - s.level, 0.0) AS x, CASE WHEN p.value IS NULL THEN 0.0 ELSE 1.0 END AS w
  FROM plain p JOIN segments s ON s.is_target_segment = p.is_target_segment AND s.dim_metric_name = p.dim_metric_name
    AND greatest(p.k, 1) > s.a AND p.k <= s.b)"""]

_BASE = f"{_I}, slot, value, holiday_name, phase, level, is_shift, x"
PARTS = WEEKS + _smooth("r0", "f1") + LEVELS + _smooth("g0", "f2") + [
    f"g1 AS (SELECT {_BASE}, nw AS w FROM f2)"] + _smooth("g1", "f3") + [f"""parts AS MATERIALIZED (
  SELECT {_I}, slot, level, trend, effect, season, is_shift, value IS NOT NULL AND far > 0 AND abs(rest) >= far AS is_spike,
         CASE WHEN NOT (value IS NOT NULL AND far > 0 AND abs(rest) >= far) THEN rest END AS y
  FROM f3)"""]

HEADS = [f"""heads AS MATERIALIZED (
  SELECT *, CASE WHEN d = 1 THEN (y_last - y_first) / (s_last - s_first) ELSE mean END AS c, n0 - d AS n,
         CASE WHEN d = 1 THEN s_first + 1 ELSE 0 END AS s0 FROM (
    SELECT {_I}, coalesce(CAST(var_samp(y - y1) < 0.1 * var_samp(y) AS INT), 0) AS d, count(y) AS n0, avg(y) AS mean,
           max(slot) AS s_end, min(slot) FILTER (WHERE y IS NOT NULL) AS s_first, max(slot) FILTER (WHERE y IS NOT NULL) AS s_last,
           arg_min(y, slot) FILTER (WHERE y IS NOT NULL) AS y_first, arg_max(y, slot) FILTER (WHERE y IS NOT NULL) AS y_last
    FROM (SELECT *, lag(y) OVER (PARTITION BY {_I} ORDER BY slot) AS y1 FROM parts) GROUP BY {_I})
  WHERE n0 > 0)"""]


def _kalman(name: str, points: str, key: str) -> str:
    """Recursion over the weeks for each row of ``points`` (ids, ``key``, f1,
    f2, th): state before week t, sums so far, forecast and variance of t."""
    keys = f"{_I}, {key}" if key else _I
    return f"""{name} AS (
  SELECT {keys}, f1, f2, th, d, c, s_end, s0 AS t, CASE WHEN d = 1 THEN y_first ELSE 0.0 END AS l, 0.0::DOUBLE AS m1, 0.0::DOUBLE AS m2,
         0.0::DOUBLE AS pl, 0.0::DOUBLE AS q1, 0.0::DOUBLE AS q2, p11, (f1 * f2 * p11 + th) / (1 - f2) AS p12, f2 * f2 * p11 + th * th AS p22,
         0.0::DOUBLE AS v2, 0.0::DOUBLE AS lf, NULL::DOUBLE AS f, NULL::DOUBLE AS fv
  FROM (SELECT *, (2 * f1 * th / (1 - f2) + th * th + 1) / (1 - f1 * f1 - f2 * f2 - 2 * f1 * f1 * f2 / (1 - f2)) AS p11
        FROM {points} JOIN heads USING ({_I}))
  UNION ALL
  SELECT {keys}, f1, f2, th, d, c, s_end, t + 1, d * (ul + u1 + c), f1 * u1 + u2, f2 * u1,
         d * (upl + 2 * uq1 + up11), d * (f1 * (uq1 + up11) + uq2 + up12), d * f2 * (uq1 + up11),
         f1 * f1 * up11 + 2 * f1 * up12 + up22 + 1, f1 * f2 * up11 + f2 * up12 + th, f2 * f2 * up11 + th * th,
         v2 + CASE WHEN y IS NULL THEN 0 ELSE e * e / vv END, lf + CASE WHEN y IS NULL THEN 0 ELSE ln(vv) END, ff, vv
  FROM (SELECT *, l + gl * e AS ul, m1 + g1 * e AS u1, m2 + g2 * e AS u2,
               pl - gl * gl * vv AS upl, q1 - gl * g1 * vv AS uq1, q2 - gl * g2 * vv AS uq2,
               p11 - g1 * g1 * vv AS up11, p12 - g1 * g2 * vv AS up12, p22 - g2 * g2 * vv AS up22
        FROM (SELECT *, coalesce(y - ff, 0.0) AS e, CASE WHEN y IS NULL THEN 0 ELSE d * (pl + q1) / vv END AS gl,
                     CASE WHEN y IS NULL THEN 0 ELSE (d * q1 + p11) / vv END AS g1,
                     CASE WHEN y IS NULL THEN 0 ELSE (d * q2 + p12) / vv END AS g2
              FROM (SELECT k.*, w.y, d * l + m1 + c AS ff, d * (pl + 2 * q1) + p11 AS vv
                    FROM {name} k JOIN parts w ON w.is_target_segment = k.is_target_segment
                     AND w.dim_metric_name = k.dim_metric_name AND w.slot = k.t))))"""


ORDERS = "(VALUES (0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (2, 1)) orders(p, q)"


def _search() -> list[str]:
    coarse = "[-0.8, -0.4, 0.0, 0.4, 0.8]"
    out = [f"""pt0 AS MATERIALIZED (
  SELECT {_I}, p, q, r1, r2, th FROM (SELECT {_I}, p, q,
    unnest(CASE WHEN p >= 1 THEN {coarse}::DOUBLE[] ELSE [0.0::DOUBLE] END) AS r1,
    CASE WHEN p = 2 THEN {coarse}::DOUBLE[] ELSE [0.0::DOUBLE] END AS r2s, CASE WHEN q = 1 THEN {coarse}::DOUBLE[] ELSE [0.0::DOUBLE] END AS ths
    FROM heads, {ORDERS}), unnest(r2s) u2(r2), unnest(ths) u3(th))"""]
    step = 0.2
    for k in range(6):
        out += [f"ab{k} AS MATERIALIZED (SELECT *, r1 * (1 - r2) AS f1, r2 AS f2 FROM pt{k})",
                _kalman(f"kf{k}", f"ab{k}", "p, q, r1, r2"),
                f"""best{k} AS MATERIALIZED (
  SELECT {_I}, p, q, min({{'aic': aic, 'r1': r1, 'r2': r2, 'th': th, 'v2': v2}}) AS b FROM (
    SELECT x.*, round(CASE WHEN n > p + q + 3 THEN n * ln(greatest(v2 / n, 1e-12)) + lf + 2.0 * (p + q + 2) * n / (n - (p + q + 2) - 1)
                           WHEN p + q = 0 THEN n * ln(greatest(v2 / n, 1e-12)) + lf + 4.0 ELSE 1e300 END, 6) AS aic
    FROM kf{k} x JOIN (SELECT {_I}, n FROM heads) USING ({_I}) WHERE t = s_end + 1) GROUP BY {_I}, p, q)"""]
        if k < 5:
            around = "greatest(-0.98, least(0.98, b.{} + o * " + repr(step) + "))"
            axes = [f"CASE WHEN {u} THEN list_transform([-1.0, 0.0, 1.0], lambda o: {around.format(r)})::DOUBLE[] "
                    f"ELSE [0.0::DOUBLE] END" for u, r in (("p >= 1", "r1"), ("p = 2", "r2"), ("q = 1", "th"))]
            out.append(f"""pt{k + 1} AS MATERIALIZED (
  SELECT {_I}, p, q, r1, r2, th FROM (SELECT {_I}, p, q, unnest({axes[0]}) AS r1, {axes[1]} AS r2s, {axes[2]} AS ths FROM best{k}),
    unnest(r2s) u2(r2), unnest(ths) u3(th))""")
            step /= 2
    out.append(f"""params AS MATERIALIZED (
  SELECT {_I}, d, b.p, b.q, n, c AS intercept, b.r1 * (1 - b.r2) AS phi1, b.r2 AS phi2, b.th AS theta, sqrt(b.v2 / n) AS sigma, b.aic
  FROM (SELECT {_I}, min({{'aic': b.aic, 'k': p + q, 'p': p, 'r1': b.r1, 'r2': b.r2, 'th': b.th, 'q': q, 'v2': b.v2}}) AS b
        FROM best5 GROUP BY {_I}) JOIN heads USING ({_I}))""")
    return out


FIT = PARTS + HEADS + _search()

DETECT = [f"chosen AS MATERIALIZED (SELECT {_I}, phi1 AS f1, phi2 AS f2, theta AS th, sigma FROM params)",
          _kalman("path", f"(SELECT {_I}, f1, f2, th FROM chosen)", ""),
          f"""scored AS (
  SELECT p.*, p.level + p.trend + p.effect + p.season + k.f AS expected, c.sigma * sqrt(k.fv) AS dev
  FROM parts p LEFT JOIN path k ON k.is_target_segment = p.is_target_segment AND k.dim_metric_name = p.dim_metric_name
    AND k.t = p.slot + 1 AND k.f IS NOT NULL
  LEFT JOIN chosen c ON c.is_target_segment = p.is_target_segment AND c.dim_metric_name = p.dim_metric_name)"""]


def detect(probability: str) -> list[str]:
    """``probability``: SQL of P(|N(0, 1)| < |z|) with the variable z as {z}."""
    return DETECT + [f"""det AS (
  SELECT l.is_target_segment, l.dim_metric_name, l.dim_collected_date, l.met_metric_value,
    coalesce(abs(l.met_metric_value - expected) > {Z95} * dev, false) AS is_anomaly,
    expected - {Z95} * dev AS lower_bound, expected + {Z95} * dev AS upper_bound,
    CASE WHEN dev > 0 THEN {probability.format(z='abs((l.met_metric_value - expected) / dev)')} END AS anomaly_probability,
    s.level, s.trend, s.effect AS holiday_effect, s.season,
    coalesce(s.is_shift, false) AS is_level_shift, coalesce(s.is_spike, false) AS is_spike
  FROM long l LEFT JOIN dated w ON w.is_target_segment = l.is_target_segment AND w.dim_metric_name = l.dim_metric_name
    AND w.dim_collected_date = l.dim_collected_date
  LEFT JOIN scored s ON s.is_target_segment = l.is_target_segment AND s.dim_metric_name = l.dim_metric_name AND s.slot = w.slot)"""]
