"""CSV snapshots: one object per load date, header may change between days
(A8-A10, S8-S10).

Reading a glob in one pass would align columns by position, which is wrong
when headers differ, and values may hold line feeds, so that no line by itself
tells whether a record starts there.  Reading has two passes over the lines of
all files, both split by byte range like any text:

1. per split, its number of quotes, and per file its first line, the header.
   The parities of the splits before it tell whether a split begins inside a
   quoted value;
2. each task walks the lines of its splits in order, keeps that parity, and
   puts lines together to records.  The pieces of records that reach over the
   end of a split are put together by file; each split has at most two.

Records are parsed by Spark's own CSV parser under their file's header and
come out under the union of all columns.  So one file of any size is read by
many tasks.  The driver sees the files' headers and which splits begin inside
a value: as much as planning a scan of them takes, and no row.

A quote inside a value has to be doubled and the value quoted, as RFC 4180 has
it; a header is one line.
"""

from __future__ import annotations

import csv
import io
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import q as _q
from ..session import ship_package

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true",
               "nullValue": "", "emptyValue": ""}
WRITE_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "nullValue": "",
                 "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                 "quoteAll": "false"}


def write_snapshot(df: DataFrame, path: str, *, partition_col: str | None = None,
                   compression: str = "none") -> bool:
    """Write ``df`` as CSV with a header; an empty input writes nothing and
    leaves what is there.  With ``partition_col``, each value is its own folder
    and a rerun of the same value replaces only that folder.  Files with
    ``compression`` ("gzip") are read whole by a task each.

    The rows are computed once: they are counted while they are written beside
    the target, and moved into place if there are any."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.options(**WRITE_OPTIONS, compression=compression)
    (w.partitionBy(partition_col) if partition_col else w).csv(staged)
    try:
        if not seen.get["n"]:
            return False
        moves = [(staged, path)]
        if partition_col:
            names = [s.getPath().getName() for s in fs.listStatus(Path(staged)) if s.isDirectory()]
            moves = [(f"{staged}/{n}", f"{path}/{n}") for n in names]
        for source, target in moves:
            fs.delete(Path(target), True)
            fs.mkdirs(Path(target).getParent())
            if not fs.rename(Path(source), Path(target)):
                raise OSError(f"{source} could not be moved to {target}")
        return True
    finally:
        fs.delete(Path(staged), True)


def snapshot_files(spark: SparkSession, path: str, suffix: str = ".csv") -> dict[str, str]:
    """Files below ``path``, gzipped ones too, by a key of their own: the path
    below it, the size and the time of writing.  A file written anew has a new key."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return {}
    root = fs.makeQualified(top).toString().rstrip("/")
    found, files = {}, fs.listFiles(top, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().toString()
        below = name[len(root):]
        if name.endswith((suffix, f"{suffix}.gz")) and not any(x.startswith((".", "_")) and "=" not in x for x in below.split("/")):
            found[f"{below}|{f.getLen()}|{f.getModificationTime()}"] = name
    return dict(sorted(found.items()))


QUOTE = '"'


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their file and the first byte of their split, in file order
    within a task; a carriage return stays at the end of its line."""
    return spark.read.option("lineSep", "\n").text(paths).selectExpr(
        "value", "_metadata.file_path AS file", "_metadata.file_block_start AS block")


def _splits(lines: DataFrame) -> list:
    """Per split: its parity of quotes, and for a file's first one the header."""
    numbered = lines.withColumn("at", F.monotonically_increasing_id())
    return numbered.groupBy("file", "block").agg(
        F.expr("sum(length(value) - length(replace(value, '\"', ''))) % 2 AS odd"),
        F.expr("min_by(CASE WHEN block = 0 THEN value END, at) AS header")).collect()


def _walker(kinds: dict[str, int], inside: set[tuple[str, int]]):
    """Function over batches of lines (in order): records with their file's
    kind, and pieces of records at the ends of splits."""
    def walk(batches):
        place, held, part, state = None, [], "whole", 0
        out: list[tuple] = []

        def close(kind_of_piece):
            if held:
                text = "\n".join(held)
                if kind_of_piece in ("whole", "head") and text.endswith("\r"):
                    text = text[:-1]  # of the line end, not of a value
                out.append((kinds[place[0]], text, kind_of_piece, *place))
            held.clear()

        def done():
            cols = list(zip(*out)) if out else [[], [], [], [], []]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64())],
                ["kind", "record", "part", "file", "block"])

        for batch in batches:
            for value, file, block in zip(*(batch.column(c).to_pylist() for c in ("value", "file", "block"))):
                if (file, block) != place:
                    close("tail" if part == "whole" else "middle")
                    place, state = (file, block), int((file, block) in inside)
                    part = "head" if state else "whole"
                    skip = block == 0
                if skip:  # the header
                    skip = False
                    continue
                held.append(value)
                state ^= value.count(QUOTE) & 1
                if not state:
                    close(part)
                    part = "whole"
            yield done()
        close("tail" if part == "whole" else "middle")
        yield done()

    return walk


def read_snapshots(spark: SparkSession, path: str | list[str], glob: str = ".csv") -> DataFrame:
    """All CSV files below ``path`` (or the files of a list), columns matched
    by header name, every value as text (no inference: leading zeros are kept).

    No file is left out by its path: rows carry their own load stamp, and an
    incremental run compares that with the target's mark."""
    paths = list(snapshot_files(spark, path, glob).values()) if isinstance(path, str) else list(path)
    if not paths:
        return spark.createDataFrame([], T.StructType([]))
    ship_package(spark)  # the tasks import this module
    lines = _lines(spark, paths)
    splits = sorted(_splits(lines), key=lambda r: (r["file"], r["block"]))
    headers: dict[str, int] = {}
    kinds: dict[str, int] = {}
    inside: set[tuple[str, int]] = set()
    parity, file = 0, None
    for r in splits:
        if r["file"] != file:
            file, parity = r["file"], 0
            kinds[file] = headers.setdefault((r["header"] or "").lstrip("\ufeff").rstrip("\r"), len(headers))
        if parity:
            inside.add((file, r["block"]))
        parity ^= int(r["odd"])
    found = lines.mapInArrow(_walker(kinds, inside), "kind int, record string, part string, file string, block long")
    records = found.where("part = 'whole'").select("kind", "record")
    if inside:
        # pieces: a tail, then middles, then a head, split after split of a file
        pieces = found.where("part <> 'whole'").selectExpr(
            "*", "sum(CASE WHEN part = 'tail' THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY block, "
                 "CASE part WHEN 'tail' THEN 1 ELSE 0 END) AS nr")
        joined = pieces.groupBy("file", "nr", "kind").agg(F.expr(
            "array_join(transform(sort_array(collect_list(named_struct('block', block, 'record', record))), "
            "p -> p.record), '\n') AS record"))
        records = records.unionByName(joined.select("kind", "record"))
    records = records.where("record <> ''")
    names = [next(csv.reader(io.StringIO(h)), []) for h in headers]
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    parsed = [F.when(F.col("kind") == i, F.from_csv("record", ", ".join(f"{_q(c)} STRING" for c in cols), options))
              for i, cols in enumerate(names)]
    rows = records.select(*[p.alias(f"k{i}") for i, p in enumerate(parsed)])
    union = list(dict.fromkeys(c for cols in names for c in cols))
    return rows.select(*[F.coalesce(*[F.col(f"k{i}")[c] for i, cols in enumerate(names) if c in cols]).alias(c)
                         for c in union])
