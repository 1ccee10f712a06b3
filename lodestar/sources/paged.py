"""Paged, keyed source as a Python DataSource (A1-A3).

Planning happens on the driver.  With ``counts`` (records per key, as an API's
total tells) a key's pages are cut into equal ranges of ``pages_per_task``
pages, so tasks are alike however uneven the keys; without, ``strides`` tasks
share a key and take pages s, s + n, s + 2n, ... until one is short.  A task
calls ``fetch(key, offset, limit)`` page by page and hands each page on as one
Arrow record batch: it never holds more than a page.  Pages and keys form a bag
union (no dedup).  Equality filters on the key column are pushed into the
reader and drop whole keys.  A failed task is retried by Spark from its first
page, so an executor loss costs one task's pages.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions._util import q as _q
from ..session import ship_package

PAGE_LIMIT = 500


class KeyPartition(InputPartition):
    """Pages first, first + step, ... of a key, up to ``last`` (excluded; None:
    until a page is short)."""

    def __init__(self, key, first: int = 0, step: int = 1, last: int | None = None):
        super().__init__((key, first, step, last))
        self.key, self.first, self.step, self.last = key, first, step, last


class _PagedReader(DataSourceReader):
    def __init__(self, src: "PagedSource", schema):
        self.src, self.schema = src, schema
        self.keys = list(src.keys)

    def partitions(self):
        src = self.src
        if src.counts is None:
            return [KeyPartition(k, s, src.strides) for k in self.keys for s in range(src.strides)]
        out = []
        for k in self.keys:
            pages = -(-int(src.counts.get(k, 0)) // src.limit)
            out += [KeyPartition(k, lo, 1, min(lo + src.pages_per_task, pages))
                    for lo in range(0, pages, src.pages_per_task)]
        return out or [KeyPartition(None, 0, 1, 0)]

    def read(self, partition: KeyPartition):
        arrow = to_arrow_schema(self.schema)
        limit, page = self.src.limit, partition.first
        while partition.last is None or page < partition.last:
            records = self.src.fetch(partition.key, page * limit, limit, **self.src.params)
            n = len(records) if isinstance(records, list) else records.num_rows
            if n:
                yield _batch(records, arrow)
            if n < limit and partition.last is None:
                break
            page += partition.step


def _batch(records, arrow: pa.Schema) -> pa.RecordBatch:
    """A page (list of dicts, or Arrow) under the source's schema; fields that
    a record lacks are null."""
    if isinstance(records, list):
        return pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in arrow} for r in records], arrow)
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays(c.chunks) if isinstance(c := records.column(f.name).cast(f.type), pa.ChunkedArray) else c
         for f in arrow], schema=arrow)


class _PushdownPagedReader(_PagedReader):
    """Used when the session enables Python data source filter pushdown:
    equality / IN filters on the key column drop whole key partitions."""

    def pushFilters(self, filters):
        for f in filters:
            col = getattr(f, "attribute", None)
            if col == (self.src.key_column,) and isinstance(f, EqualTo):
                self.keys = [k for k in self.keys if str(k) == str(f.value)]
            elif col == (self.src.key_column,) and isinstance(f, In):
                vals = {str(v) for v in f.value}
                self.keys = [k for k in self.keys if str(k) in vals]
            else:
                yield f


class PagedSource(DataSource):
    """Configured by ``paged_source`` below; not used directly."""
    fetch: Callable = None
    keys: list = []
    ddl: str = ""
    key_column: str | None = None
    limit: int = PAGE_LIMIT
    strides: int = 1
    pushdown: bool = False
    params: dict = {}
    counts: dict | None = None
    pages_per_task: int = 1

    @classmethod
    def name(cls):
        return cls._name

    def schema(self):
        return self.ddl

    def reader(self, schema):
        return (_PushdownPagedReader if self.pushdown else _PagedReader)(self, schema)


def paged_source(spark: SparkSession, fetch: Callable, keys: list, ddl: str, *,
                 key_column: str | None = None, limit: int = PAGE_LIMIT, name: str = "paged",
                 strides: int = 1, params: dict | None = None, counts: dict | None = None,
                 pages_per_task: int = 20):
    """A DataFrame over a paged API.  ``fetch(key, offset, limit, **params)``
    returns a page: a list of dicts, or an Arrow table or batch.  ``params``
    are fixed request filters applied at the source (e.g. a property type);
    ``ddl`` is the record schema; ``counts`` (records per key, under the same
    filters) has tasks planned as equal page ranges, else ``strides`` tasks
    share the pages of a key until one is short."""
    pushdown = (key_column is not None and str(spark.conf.get(
        "spark.sql.python.filterPushdown.enabled", "false")).lower() == "true")
    cls = type(f"PagedSource_{name}", (PagedSource,),
               {"fetch": staticmethod(fetch), "keys": list(keys), "ddl": ddl,
                "key_column": key_column, "limit": int(limit), "strides": int(strides), "_name": name,
                "pushdown": pushdown, "params": dict(params or {}),
                "counts": None if counts is None else dict(counts), "pages_per_task": int(pages_per_task)})
    ship_package(spark)  # the tasks import this module
    spark.dataSource.register(cls)
    return spark.read.format(name).load()


def write_pages(df: DataFrame, path: str, key: str, order: Column | str, limit: int = PAGE_LIMIT) -> dict:
    """Lay a table out as an API would serve it: per key, pages of ``limit``
    rows in order, each a small Parquet file of its own (for ``PageFiles``).
    Returns the rows per key.

    Rows are dealt out by range of (key, order); a row's number in its key is
    its number in the range plus the rows of the ranges before, so no task
    sorts or numbers a whole key."""
    spark = df.sparkSession
    order = F.col(order) if isinstance(order, str) else order
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = (df.withColumn("__o", order).repartitionByRange(n, F.col(key), F.col("__o"))
             .sortWithinPartitions(key, "__o").drop("__o")
             .withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}))
    ranged = f"{path}/ranged"
    dealt.write.parquet(ranged)  # numbers are taken once
    dealt = spark.read.schema(dealt.schema).parquet(ranged)
    ranges = dealt.groupBy(key, "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__lo"))
    ranges = ranges.selectExpr("*", f"sum(__n) OVER (PARTITION BY {_q(key)} ORDER BY __part) - __n AS __before")
    mine = ranges.select(F.col(key).alias("__k"), F.col("__part").alias("__p"), "__lo", "__before")
    rows = dealt.join(mine, (F.col("__part") == F.col("__p")) & F.col(key).eqNullSafe(F.col("__k")))
    rows = rows.selectExpr(*[_q(c) for c in df.columns], f"{_q(key)} AS __key", "__at",
                           f"(__before + __at - __lo) DIV {int(limit)} AS __page")
    (rows.repartition(n, "__key", "__page").sortWithinPartitions("__key", "__page", "__at").drop("__at")
     .write.partitionBy("__key", "__page").parquet(f"{path}/pages"))
    return {r[key]: r["n"] for r in ranges.groupBy(key).agg(F.sum("__n").alias("n")).collect()}


# Characters that Spark writes as %XX in partition folder names.
ESCAPED = {*map(chr, range(32)), *"\"#%'*/:=?\\{[]^", "\x7f"}
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def _folder(key) -> str:
    if key is None or key == "":
        return NO_KEY
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in str(key))


class PageFiles:
    """A ``fetch`` that serves the pages of ``write_pages``: each call opens the
    one file of its page.  Request filters are served from pages laid out for
    them, as an API filters before it pages."""

    def __init__(self, path: str, limit: int = PAGE_LIMIT, params: dict | None = None):
        self.path, self.limit, self.params = path, limit, dict(params or {})

    def __call__(self, key, offset: int, limit: int, **params):
        import pyarrow.parquet as pq
        from pyarrow import fs

        if limit != self.limit or offset % limit or params != self.params:
            raise ValueError("pages are laid out for another request")
        store, top = fs.FileSystem.from_uri(self.path) if ":" in self.path.split("/")[0] else (fs.LocalFileSystem(), self.path)
        folder = f"{top}/pages/__key={_folder(key)}/__page={offset // limit}"
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        tables = [pq.read_table(f.path, filesystem=store, partitioning=None) for f in found if f.path.endswith(".parquet")]
        return pa.concat_tables(tables) if tables else []
