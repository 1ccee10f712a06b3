"""Grouped weekly series, moving averages, year-over-year join, crossovers
(D1-D5, E1-E7, C3).

The series is small (one row per date and segment), so the windows that
follow the aggregation partition by segment only.  The aggregation of the
full fact table has two levels: per (date, segment, group of scan tasks), then
per (date, segment) and date.  Quantile sketches merge at both, so a hot date
never brings one sketch of every scan task into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import q as _q

# Size of a quantile sketch: exact up to about as many values, relative rank
# error about 1e-4 beyond; the largest sketch is below a megabyte.
DEFAULT_SKETCH = 32_768
TASKS_TOGETHER = 256  # scan tasks whose sketches of a group meet in one task


def _sketch_kind(df: DataFrame, column: str) -> str:
    kind = df.schema[column].dataType
    return "bigint" if isinstance(kind, T.IntegralType) else "double"


def salted_partials(df: DataFrame, keys: list[str], *, counts: dict[str, str], means: dict[str, str],
                    medians: dict[str, str], sketch: int = DEFAULT_SKETCH,
                    tasks: int = TASKS_TOGETHER) -> DataFrame:
    """First level: one row per key and ``tasks`` neighbouring scan tasks
    (``__salt``), with counts, sums and mergeable quantile sketches.  The
    sketches that meet in one task are those of ``tasks`` scan tasks, however
    hot a key is."""
    aggs = [F.expr(f"count({_q(c)}) AS {_q('n ' + out)}") for out, c in counts.items()]
    for out, c in means.items():
        aggs += [F.expr(f"sum({_q(c)}) AS {_q('s ' + out)}"), F.expr(f"count({_q(c)}) AS {_q('n ' + out)}")]
    for out, c in medians.items():
        kind = _sketch_kind(df, c)
        aggs += [F.expr(f"count({_q(c)}) AS {_q('n ' + out)}"),
                 F.expr(f"kll_sketch_agg_{kind}(CAST({_q(c)} AS {kind}), {int(sketch)}) AS {_q('k ' + out)}")]
    salted = df.withColumn("__salt", F.floor(F.spark_partition_id() / F.lit(tasks)).cast("int"))
    return salted.groupBy(*keys, "__salt").agg(*aggs)


def merged_metrics(partials: DataFrame, source: DataFrame, groups, *, counts: dict[str, str],
                   means: dict[str, str], medians: dict[str, str], extra: list[Column] = ()) -> DataFrame:
    """Second level: ``groups`` (a grouping of the first level's rows) merged
    to counts, means (exact sum / count) and medians: the lower middle value,
    an actual one, NULLs skipped, NULL without a value."""
    aggs = [F.expr(f"coalesce(sum({_q('n ' + out)}), 0) AS {_q(out)}") for out in counts]
    aggs += [F.expr(f"CAST(sum({_q('s ' + out)}) AS DOUBLE) / nullif(sum({_q('n ' + out)}), 0) AS {_q(out)}")
             for out in means]
    for out, c in medians.items():
        kind, n, k = _sketch_kind(source, c), _q("n " + out), _q("k " + out)
        aggs.append(F.expr(f"CASE WHEN sum({n}) > 0 THEN kll_sketch_get_quantile_{kind}("
                           f"kll_merge_agg_{kind}({k}) FILTER (WHERE {n} > 0), 0.5D) END AS {_q(out)}"))
    return groups(partials).agg(*aggs, *extra)


def grouped_metrics(df: DataFrame, keys: list[str], *, counts: dict[str, str] | None = None,
                    means: dict[str, str] | None = None, medians: dict[str, str] | None = None,
                    sketch: int = DEFAULT_SKETCH, tasks: int = TASKS_TOGETHER) -> DataFrame:
    """Counts, means and medians per key by two levels of aggregation."""
    parts = dict(counts=counts or {}, means=means or {}, medians=medians or {})
    partials = salted_partials(df, keys, **parts, sketch=sketch, tasks=tasks)
    return merged_metrics(partials, df, lambda x: x.groupBy(*keys), **parts)


LISTING_COUNTS = {"met_listings_count": "id"}
LISTING_MEANS = {"met_price_avg": "met_price", "met_price_per_sqft_avg": "met_price_per_sqft"}
LISTING_MEDIANS = {"met_price_median": "met_price", "met_price_per_sqft_median": "met_price_per_sqft"}
LISTING_METRICS = ["met_listings_count", "met_price_avg", "met_price_median", "met_price_per_sqft_avg",
                   "met_price_per_sqft_median"]


def listing_series(df: DataFrame, date_col: str, segment_col: str, *, label_col: str = "is_target_segment",
                   overall_label: str = "all", sketch: int = DEFAULT_SKETCH,
                   tasks: int = TASKS_TOGETHER) -> DataFrame:
    """The listing metrics by grouping sets ((date), (date, segment)).

    Rows are aggregated once, by (date, segment, salt); the grouping sets
    expand those few partial rows, not the facts."""
    parts = dict(counts=LISTING_COUNTS, means=LISTING_MEANS, medians=LISTING_MEDIANS)
    partials = salted_partials(df, [date_col, segment_col], **parts, sketch=sketch, tasks=tasks)
    out = merged_metrics(partials, df, lambda x: x.groupingSets([[date_col], [date_col, segment_col]],
                                                                date_col, segment_col),
                         **parts, extra=[F.grouping(segment_col).alias("__rolled")])
    label = (F.when(F.col("__rolled") == 1, F.lit(overall_label))
             .otherwise(F.col(segment_col).cast("string")))
    return out.select(date_col, label.alias(label_col), *LISTING_METRICS)


def segment_series(df: DataFrame, date_col: str, segment_col: str,
                   aggs: dict[str, Column], *, label_col: str = "is_target_segment",
                   overall_label: str = "all") -> DataFrame:
    """One pass over the input with grouping sets ((date), (date, segment)).

    The rolled-up level is labelled via ``grouping()``, so a genuine NULL
    segment is not mistaken for the overall row."""
    g = df.groupingSets([[date_col], [date_col, segment_col]], date_col, segment_col)
    out = g.agg(*[c.alias(n) for n, c in aggs.items()],
                F.grouping(segment_col).alias("__rolled"))
    label = (F.when(F.col("__rolled") == 1, F.lit(overall_label))
             .otherwise(F.col(segment_col).cast("string")))
    return out.select(date_col, label.alias(label_col), *aggs.keys())


def moving_averages(df: DataFrame, value: str, partition: str, order: str,
                    windows: dict[str, int]) -> DataFrame:
    """Trailing means over the last N rows (rows, not calendar weeks); the
    first rows average what exists.  All frames share one window spec, so
    Spark evaluates them in a single Window operator."""
    base = Window.partitionBy(partition).orderBy(order)
    cols = {}
    for name, n in windows.items():
        w = base.rowsBetween(-(n - 1), 0)
        cols[name] = F.sum(value).over(w).cast("double") / F.count(value).over(w)
    return df.withColumns(cols)


def yoy_join(df: DataFrame, partition: str, date_col: str, columns: dict[str, str],
             shift_days: int = 364) -> DataFrame:
    """Values of the row exactly ``shift_days`` earlier in the same
    partition (NULL when there is none): the left self-join on
    ``date - shift_days``, written as a RANGE frame [-shift, -shift] over
    the day number.  It reuses the partitioning of the other series
    windows, so there is no join and no second pass over the input."""
    day = F.unix_date(F.col(date_col).cast("date"))
    w = Window.partitionBy(partition).orderBy(day).rangeBetween(-shift_days, -shift_days)
    dated = F.col(date_col).isNotNull()  # a row without a date has no earlier one
    return df.withColumns({dst: F.when(dated, F.first(F.col(src)).over(w)) for src, dst in columns.items()})


def crossover(df: DataFrame, fast: str, slow: str, partition: str, order: str,
              *, down: str, up: str) -> DataFrame:
    """Strict sign change of (fast - slow) between the previous row and this
    one. Never NULL; the first row of a partition is false."""
    w = Window.partitionBy(partition).orderBy(order)
    pf, ps = F.lag(fast, 1).over(w), F.lag(slow, 1).over(w)
    f, s = F.col(fast), F.col(slow)
    return df.withColumns({
        down: F.when((f < s) & (pf > ps), F.lit(True)).otherwise(F.lit(False)),
        up: F.when((f > s) & (pf < ps), F.lit(True)).otherwise(F.lit(False)),
    })
