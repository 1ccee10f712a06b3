"""Weekly spine, level shifts and robust seasonal-trend-holiday smoothing
(I2-I4): what a series is besides its ARMA remainder.

value = level + trend + holiday + season + remainder, per series id:

* **weeks**: a date belongs to the week slot floor(days since the series'
  first date / 7), so a run on another weekday keeps its place.  Rows of one
  slot are averaged; slots without a row stay as gaps (NULL).
* **level**: piecewise constant.  The cuts minimise the sum of squares within
  segments over the noise variance plus ``penalty * ln(n)`` a segment, by
  optimal partitioning: an exact dynamic programme over prefix sums, with
  segments of at least ``min_segment`` observed weeks.  It runs on what a
  first smoothing without levels leaves after holidays and season, without
  that smoothing's spikes.  The noise is the long-run variance of its
  remainder: (median |r| / 0.6745)^2 (1 + rho) / (1 - rho), rho being the
  autocorrelation at one week, between 0 and 0.9.
* **trend**: local line over ``span`` weeks to either side, by windowed sums
  of w, w t, w t^2, w x, w t x.
* **holiday**: per holiday name, weighted mean of the detrended weeks that
  hold it, less that of weeks without a holiday (two weeks at least).
* **season**: weighted mean by ISO week of what is left, centred, once a
  series covers ``min_cycles`` years.
* **robustness**: weights (1 - (r / 6 median|r|)^2)^2 from the remainder go
  into the next round; a week with weight 0 in the end is a spike.

Every step is a window or an aggregate partitioned by the series id: one
shuffle deals the weekly rows out by id and all of them run on it.  A series
has one row a week, so its size does not depend on the fact table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import q as _q
from .calendar import holidays_of, regularise_series

NORMAL_MEDIAN = 0.6744897501960817  # median of |standard normal|
TRICKLE = 1e-6  # least spread of weeks, by weight, that holds a line
OUTLYING = 6.0  # medians of the remainder from which a week has no weight


def let(name: str, value: str, body: str) -> str:
    """SQL text that evaluates ``value`` once for all uses in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def weekly_rows(long: DataFrame, ids: list[str], ts: str, value: str) -> DataFrame:
    """Rows with a date and a value, numbered by week slot (``__slot``)."""
    qi = ", ".join(_q(i) for i in ids)
    return long.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).selectExpr(
        *[_q(i) for i in ids], f"CAST({_q(ts)} AS DATE) AS __day", f"CAST({_q(value)} AS DOUBLE) AS __value",
        f"CAST(datediff(CAST({_q(ts)} AS DATE), min(CAST({_q(ts)} AS DATE)) OVER (PARTITION BY {qi})) DIV 7 AS INT) AS __slot")


def weekly_spine(long: DataFrame, ids: list[str], ts: str, value: str) -> DataFrame:
    """One row a week slot from each series' first to its last: ids, __week
    (its first day), __slot, __value (NULL in a gap)."""
    rows = weekly_rows(long, ids, ts, value)
    slots = rows.groupBy(*ids, "__slot").agg(F.avg("__value").alias("__value"), F.min("__day").alias("__first"))
    qi = ", ".join(_q(i) for i in ids)
    dated = slots.selectExpr(*[_q(i) for i in ids], "__value",
                             f"date_add(min(__first) OVER (PARTITION BY {qi}), 7 * __slot) AS __week")
    return regularise_series(dated, ids, "__week", ["__value"]).selectExpr(
        *[_q(i) for i in ids], "__week", "__value",
        f"CAST(datediff(__week, min(__week) OVER (PARTITION BY {qi})) DIV 7 AS INT) AS __slot")


def with_holidays(weeks: DataFrame) -> DataFrame:
    """Adds ``__holiday``: the first holiday by name in the seven days from the
    week's Monday, else NULL.  The rules of the two years that the days may
    fall in are evaluated in place, without a calendar to join."""
    monday = F.date_trunc("week", F.col("__week")).cast("date")
    days = F.array_union(holidays_of(F.year(monday)), holidays_of(F.year(F.date_add(monday, 6))))
    return weeks.withColumn("__holiday", F.array_min(F.transform(
        F.filter(days, lambda h: h["holiday_date"].between(monday, F.date_add(monday, 6))), lambda h: h["holiday"])))


def level_cuts_sql(n: str, prefix: str, noise: str, penalty: float, least: int) -> str:
    """SQL text for the segments (a, b] of the observed weeks 1..n.

    ``prefix`` names an array whose element k + 1 holds (s, q): the sums of
    the first k centred values and of their squares.  Costs are compared to
    six decimals, ties going to the earlier cut."""
    spread = f"greatest(0D, e.q - p.q - (e.s - p.s) * (e.s - p.s) / (t - i)) / {noise}"
    price = f"({penalty!r}D * ln({n}))"
    step = let("e", f"element_at({prefix}, t + 1)", let(
        "best", f"array_min(transform(slice({prefix}, 1, t - {least - 1}), (p, i) -> named_struct("
                f"'c', floor((a.f[i] + {spread} + {price}) * 1e6D + 0.5D) / 1e6D, 's', i)))",
        "named_struct('f', concat(a.f, array(best.c)), 'b', concat(a.b, array(best.s)))"))
    start = (f"named_struct('f', concat(array(floor(-{price} * 1e6D + 0.5D) / 1e6D), array_repeat(1e12D, {least - 1})), "
             f"'b', array_repeat(0, {least}))")
    back = (f"aggregate(sequence(1, {n}), named_struct('at', {n}, 'cuts', slice(array(0), 1, 0)), (w, i) -> "
            f"if(w.at <= 0, w, named_struct('at', element_at(run.b, w.at + 1), "
            f"'cuts', concat(array(element_at(run.b, w.at + 1)), w.cuts)))).cuts")
    return (f"CASE WHEN {n} >= {2 * least} AND {noise} > 0 THEN "
            + let("run", f"aggregate(sequence({least}, {n}), {start}, (a, t) -> {step})", back)
            + " ELSE array(0) END")


def with_levels(weeks: DataFrame, ids: list[str], carry: list[str], *, penalty: float = 6.0,
                min_segment: int = 8) -> DataFrame:
    """Adds ``__level`` (mean of the week's segment of ``__plain``) and
    ``__shift`` (first week of a later segment).  A week without a value
    belongs to the segment of the last one before it that has one."""
    qs = [_q(i) for i in ids]
    qi = ", ".join(qs)
    run = f"OVER (PARTITION BY {qi} ORDER BY __slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    x = weeks.selectExpr("*", f"avg(__plain) OVER (PARTITION BY {qi}) AS __mean",
                         f"CAST(count(__plain) {run} AS INT) AS __k",
                         f"lag(__rest, 1) OVER (PARTITION BY {qi} ORDER BY __slot) AS __before")
    x = x.selectExpr("*", "coalesce(__plain - __mean, 0D) AS __c")
    x = x.selectExpr("*", f"sum(__c) {run} AS __s", f"sum(__c * __c) {run} AS __sq")
    row = ", ".join(f"'{c}', {_q(c)}" for c in ["__slot", "__value", "__k", *carry])
    g = x.groupBy(*ids).agg(*[F.expr(e) for e in (
        f"sort_array(collect_list(named_struct({row}))) AS __rows",
        "transform(sort_array(collect_list(named_struct('k', __k, 's', __s, 'q', __sq)) "
        "FILTER (WHERE __plain IS NOT NULL)), p -> named_struct('s', p.s, 'q', p.q)) AS __sums",
        "CAST(count(__plain) AS INT) AS __n", "first(__mean) AS __mean", "median(abs(__rest)) AS __noise",
        "greatest(0D, least(0.9D, coalesce(sum(__rest * __before) / nullif(sum(__rest * __rest) "
        "FILTER (WHERE __before IS NOT NULL), 0D), 0D))) AS __rho")])
    g = g.selectExpr(*qs, "__rows", "__n", "__mean", f"pow(coalesce(__noise, 0D) / {NORMAL_MEDIAN!r}D, 2) "
                     "* (1D + __rho) / (1D - __rho) AS __var",
                     "concat(array(named_struct('s', 0D, 'q', 0D)), __sums) AS __prefix")
    cuts = level_cuts_sql("z.n", "z.prefix", "z.var", penalty, min_segment)
    g = g.selectExpr(*qs, "__rows", "__n", "__mean", "__prefix",
                     let("z", "named_struct('n', __n, 'prefix', __prefix, 'var', __var)", cuts) + " AS __cuts")
    segment = let("b", "coalesce(try_element_at(__cuts, i + 2), __n)", let(
        "a", "element_at(__cuts, i + 1)",
        "named_struct('a', a, 'b', b, 'level', __mean + (element_at(__prefix, b + 1).s - element_at(__prefix, a + 1).s) "
        "/ (b - a))"))
    g = g.selectExpr(*qs, "__rows", f"transform(__cuts, (c, i) -> {segment}) AS __segments")
    g = g.selectExpr(*qs, "__segments", "inline(__rows)")
    mine = "element_at(filter(__segments, g -> greatest(__k, 1) > g.a AND __k <= g.b), 1)"
    g = g.selectExpr(*qs, "__slot", "__value", *[_q(c) for c in carry], "__k", f"{mine} AS __mine")
    return g.selectExpr(*qs, "__slot", "__value", *[_q(c) for c in carry], "__mine.level AS __level",
                        "__mine.a > 0 AND __k = __mine.a + 1 AND "
                        f"coalesce(lag(__k, 1) OVER (PARTITION BY {qi} ORDER BY __slot) < __k, false) AS __shift")


def _smooth(x: DataFrame, ids: list[str], span: int, min_cycles: int, period: int) -> DataFrame:
    """One round: trend, holiday, season and remainder under weights ``__w``,
    and the weights of the next round."""
    qi = ", ".join(_q(i) for i in ids)
    near = f"OVER (PARTITION BY {qi} ORDER BY __slot ROWS BETWEEN {span} PRECEDING AND {span} FOLLOWING)"
    alike = f"OVER (PARTITION BY {qi}, __holiday)"
    phase = f"OVER (PARTITION BY {qi}, __phase)"
    whole = f"OVER (PARTITION BY {qi})"
    x = x.selectExpr("*", f"sum(__w) {near} AS __sw", f"sum(__w * __slot) {near} AS __st",
                     f"sum(__w * __slot * __slot) {near} AS __stt", f"sum(__w * __x0) {near} AS __sx",
                     f"sum(__w * __slot * __x0) {near} AS __stx")
    x = x.selectExpr("*", "__st - __slot * __sw AS __a", "__stt - 2D * __slot * __st + __slot * __slot * __sw AS __b",
                     "__stx - __slot * __sx AS __ax")
    x = x.selectExpr("*", f"CASE WHEN __sw * __b - __a * __a > {TRICKLE!r}D * __sw * __sw "
                          "THEN (__b * __sx - __a * __ax) / (__sw * __b - __a * __a) "
                          "WHEN __sw > 0 THEN __sx / __sw ELSE 0D END AS __trend")
    x = x.selectExpr("*", "__w * (__x0 - __trend) AS __wd")
    x = x.selectExpr("*", f"coalesce(sum(CASE WHEN __holiday IS NULL THEN __wd END) {whole} / "
                          f"nullif(sum(CASE WHEN __holiday IS NULL THEN __w END) {whole}, 0D), 0D) AS __base",
                     f"sum(__wd) {alike} AS __hd", f"sum(__w) {alike} AS __hw", f"count(__value) {alike} AS __hn")
    x = x.selectExpr("*", "CASE WHEN __holiday IS NOT NULL AND __hn >= 2 AND __hw > 0 "
                          "THEN __hd / __hw - __base ELSE 0D END AS __effect")
    x = x.selectExpr("*", f"coalesce(sum(__wd - __w * __effect) {phase} / nullif(sum(__w) {phase}, 0D), 0D) AS __raw",
                     f"max(__slot) {whole} + 1 >= {min_cycles * period} AS __long")
    x = x.selectExpr("*", f"CASE WHEN __long THEN __raw - avg(__raw) {whole} ELSE 0D END AS __season")
    x = x.selectExpr("*", "CASE WHEN __value IS NOT NULL THEN __x0 - __trend - __effect - __season END AS __rest")
    x = x.selectExpr("*", f"{OUTLYING!r}D * median(abs(__rest)) {whole} AS __far")
    return x.selectExpr("*", "CASE WHEN __value IS NULL THEN 0D WHEN __far = 0 THEN 1D WHEN abs(__rest) >= __far THEN 0D "
                             "ELSE pow(1 - pow(__rest / __far, 2), 2) END AS __next")


ROUND = ["__sw", "__st", "__stt", "__sx", "__stx", "__a", "__b", "__ax", "__trend", "__wd", "__base", "__hd", "__hw",
         "__hn", "__effect", "__raw", "__long", "__season", "__rest", "__far", "__w"]


def decompose(long: DataFrame, ids: list[str], ts: str, value: str, *, span: int = 26, rounds: int = 1,
              min_cycles: int = 2, period: int = 52, penalty: float = 6.0, min_segment: int = 8) -> DataFrame:
    """One row a series and week slot: ids, __slot, __week, __value, __level,
    __shift, __trend, __effect (holiday), __season, __rest, __spike.

    Rows without a date or a value take no part.  The parts are known for
    gaps too; a gap's remainder is NULL."""
    weeks = with_holidays(weekly_spine(long, ids, ts, value))
    # a fixed number of partitions: change points are work, not bytes
    weeks = weeks.repartition(long.sparkSession.sparkContext.defaultParallelism, *ids)
    first = weeks.selectExpr("*", "coalesce(__value, 0D) AS __x0", "least(weekofyear(__week), 52) AS __phase",
                             "CASE WHEN __value IS NULL THEN 0D ELSE 1D END AS __w")
    first = _smooth(first, ids, span, min_cycles, period).selectExpr(
        *[_q(i) for i in ids], "__slot", "__week", "__holiday", "__phase", "__value",
        "CASE WHEN __next > 0 THEN __value - __effect - __season END AS __plain",
        "CASE WHEN __next > 0 THEN __rest END AS __rest")
    x = with_levels(first, ids, ["__week", "__holiday", "__phase"], penalty=penalty, min_segment=min_segment)
    x = x.selectExpr("*", "coalesce(__value - __level, 0D) AS __x0",
                     "CASE WHEN __value IS NULL THEN 0D ELSE 1D END AS __w")
    for _ in range(rounds):
        x = _smooth(x, ids, span, min_cycles, period).drop(*ROUND).withColumnRenamed("__next", "__w")
    x = _smooth(x, ids, span, min_cycles, period)
    return x.selectExpr(*[_q(i) for i in ids], "__slot", "__week", "__value", "__level", "__shift", "__trend", "__effect",
                        "__season", "__rest", "__value IS NOT NULL AND __far > 0 AND abs(__rest) >= __far AS __spike")
