"""Regular date spines, gap filling and holiday weeks.

Spines are generated per series from that series' own first and last date
(``sequence`` + ``explode`` on the grouped bounds), never by crossing a
calendar with all series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def date_spine(df: DataFrame, date_col: str, *, step_days: int = 7,
               ids: list[str] | None = None, out: str | None = None) -> DataFrame:
    """Every ``step_days`` from the first to the last date (per id)."""
    ids = ids or []
    out = out or date_col
    b = df.groupBy(*ids).agg(F.min(date_col).alias("__lo"), F.max(date_col).alias("__hi"))
    seq = F.sequence(F.col("__lo"), F.col("__hi"), F.make_interval(days=F.lit(step_days)))
    return b.select(*ids, F.explode(seq).alias(out))


def regularise_series(df: DataFrame, ids: list[str], date_col: str, values: list[str], *,
                      step_days: int = 7, fill: dict[str, object] | None = None) -> DataFrame:
    """Insert the missing dates of each series (values NULL, or ``fill``)
    and add ``is_filled`` for the inserted rows.  Every row brings the dates up
    to the next one of its series, so one window does it, without a join."""
    w = Window.partitionBy(*ids).orderBy(date_col)
    upto = F.greatest(F.date_sub(F.lead(date_col).over(w), step_days), F.col(date_col))
    dates = F.sequence(F.col(date_col), F.coalesce(upto, F.col(date_col)), F.make_interval(days=F.lit(step_days)))
    rows = df.where(F.col(date_col).isNotNull()).select(*ids, date_col, *values, dates.alias("__dates"))
    j = rows.select(*ids, *values, F.posexplode("__dates").alias("__pos", date_col))
    cols = {v: F.when(F.col("__pos") == 0, F.col(v)) for v in values}
    cols = {v: F.coalesce(c, F.lit(fill[v])) if fill and v in fill else c for v, c in cols.items()}
    return j.select(*ids, date_col, *[c.alias(v) for v, c in cols.items()], (F.col("__pos") > 0).alias("is_filled"))


# US federal holidays as (name, month, rule, first year).
# rule: ("day", d) a fixed day; ("nth", weekday, n) the n-th weekday of the
# month (weekday 0 = Monday); ("last", weekday) the last weekday of the month.
US_HOLIDAYS = [
    ("New Year's Day", 1, ("day", 1), 1870),
    ("Martin Luther King Jr. Day", 1, ("nth", 0, 3), 1986),
    ("Washington's Birthday", 2, ("nth", 0, 3), 1971),
    ("Memorial Day", 5, ("last", 0), 1971),
    ("Juneteenth", 6, ("day", 19), 2021),
    ("Independence Day", 7, ("day", 4), 1870),
    ("Labor Day", 9, ("nth", 0, 1), 1894),
    ("Columbus Day", 10, ("nth", 0, 2), 1971),
    ("Veterans Day", 11, ("day", 11), 1938),
    ("Thanksgiving Day", 11, ("nth", 3, 4), 1942),
    ("Christmas Day", 12, ("day", 25), 1870),
]


def _weekday(d: Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return (F.dayofweek(d) + 5) % 7


def _holiday_date(year: Column, month: int, rule) -> Column:
    if rule[0] == "day":
        return F.make_date(year, F.lit(month), F.lit(rule[1]))
    if rule[0] == "nth":
        first = F.make_date(year, F.lit(month), F.lit(1))
        off = (F.lit(rule[1]) - _weekday(first) + 7) % 7 + 7 * (rule[2] - 1)
        return F.date_add(first, off.cast("int"))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    back = (_weekday(last) - F.lit(rule[1]) + 7) % 7
    return F.date_sub(last, back.cast("int"))


def holidays_of(year: Column) -> Column:
    """The holidays of a year as an array of (holiday, holiday_date); the date
    is NULL before a holiday's first year."""
    return F.array(*[F.struct(F.lit(name).alias("holiday"),
                              F.when(year >= since, _holiday_date(year, m, rule)).alias("holiday_date"))
                     for name, m, rule, since in US_HOLIDAYS])


def holiday_calendar(df: DataFrame, date_col: str) -> DataFrame:
    """Holidays of every year spanned by ``df[date_col]``:
    (year, holiday, holiday_date, week_start)."""
    years = df.agg(F.year(F.min(date_col)).alias("__y0"), F.year(F.max(date_col)).alias("__y1"))
    ys = years.select(F.explode(F.sequence("__y0", "__y1")).alias("year"))
    h = ys.select("year", F.explode(holidays_of(F.col("year"))).alias("h")).select("year", "h.holiday", "h.holiday_date")
    h = h.where(F.col("holiday_date").isNotNull())
    return h.withColumn("week_start", F.date_trunc("week", F.col("holiday_date")).cast("date"))


def holiday_weeks(df: DataFrame, date_col: str) -> DataFrame:
    """Per distinct week start in ``df``: is_holiday_week and the (first by
    name) holiday in it.  The holiday table has about 11 rows per year, so
    the join is broadcast by size."""
    cal = holiday_calendar(df, date_col).groupBy("week_start").agg(
        F.min("holiday").alias("holiday_name"), F.count("*").alias("n_holidays"))
    weeks = df.select(F.date_trunc("week", F.col(date_col)).cast("date").alias(date_col)).distinct()
    j = weeks.join(F.broadcast(cal), weeks[date_col] == cal["week_start"], "left")
    return j.select(date_col, F.col("holiday_name").isNotNull().alias("is_holiday_week"),
                    "holiday_name", F.coalesce("n_holidays", F.lit(0)).cast("long").alias("n_holidays"))
