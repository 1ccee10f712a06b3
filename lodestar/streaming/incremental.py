"""Incremental loads (A14, B7, D6, S11, S12): a high-water mark over dates, and
an exactly-once log over batches.

Mark semantics: a run loads only source rows whose date is strictly greater
than the largest date already in the target.  Rows at or below the mark are
dropped (late data) and a NULL date never passes.  A target without a dated
row has no mark: everything is loaded (``after_mark`` with a target of that
kind can also load nothing, as a plain comparison with NULL does).

The mark is one scalar: collected to a literal it lets Spark prune the
source's date partitions statically; the lazy form keeps it a scalar
subquery.

The streaming form does not read a mark: each micro-batch is one load of the
target, known by the stream's checkpoint and the batch's number.  A batch that
is replayed after a crash finds its key in the target's manifest and appends
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import append_once, append_partitions, read_table


def high_water_mark(target: DataFrame, col: str):
    """The target's largest value of ``col`` (None when empty)."""
    return target.agg(F.max(col).alias("m")).first()["m"]


def after_mark(source: DataFrame, source_col: str | Column, target: DataFrame | None,
               target_col: str, *, lazy: bool = False, empty_loads_all: bool = False) -> DataFrame:
    """Rows of ``source`` strictly newer than the target's mark; without a
    mark none, or all if ``empty_loads_all``."""
    c = F.col(source_col) if isinstance(source_col, str) else source_col
    if target is None:
        return source
    if lazy:
        return source.where(c > target.agg(F.max(target_col)).scalar())
    mark = high_water_mark(target, target_col)
    if mark is None:
        return source if empty_loads_all else source.limit(0)
    return source.where(c > F.lit(mark))


def incremental_append(spark: SparkSession, source: DataFrame, path: str, date_col: str) -> None:
    """Append the rows of ``source`` newer than the table at ``path`` into
    date folders (one pass over the source; nothing is counted first).  A
    first load keeps every row, also those without a date."""
    new = after_mark(source, date_col, read_table(spark, path), date_col, empty_loads_all=True)
    append_partitions(new, path, date_col)


def stream_incremental(spark: SparkSession, source_dir: str, schema, path: str, date_col: str,
                       checkpoint: str, *, glob: str = "*.parquet", transform=None):
    """Structured Streaming form: the new files under ``source_dir`` are
    micro-batches, each appended once as one load of the table at ``path``;
    runs what is available now and stops."""
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", glob)
              .parquet(source_dir))
    if transform is not None:
        stream = transform(stream)

    def batch(df: DataFrame, number: int) -> None:
        append_once(df, path, date_col, f"{checkpoint}#{number}")

    q = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
