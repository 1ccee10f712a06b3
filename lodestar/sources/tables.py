"""Stored tables with atomic versions and a commit log.

A table is a folder of loads and a folder of manifests:

    <path>/__load=<id>/[<date>=.../]part-*.parquet
    <path>/_manifest/00000007.json

A write puts its files into a load folder of its own and then renames one
manifest into place.  The newest manifest names the loads that make up the
table, the schema, and the keys of everything the table has taken in (source
files, loads of another table, micro-batches).  So

* a run that dies at any point leaves the table as it was; its files belong to
  no manifest and ``vacuum`` removes them;
* a reader sees one version whole, also while the next one is written;
* a batch whose key is in the manifest is not taken in again, whatever dates
  its rows have, and an empty load is a load.

One writer at a time: the manifest's number is claimed by the rename, and a
second writer of the same number fails without harm.  All of it goes through
the Hadoop file system of the path, so any store that Spark reaches will do.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LOAD = "__load"
MANIFESTS = "_manifest"


class ConcurrentWrite(RuntimeError):
    """Another writer has committed the version this one was based on."""


@dataclass(frozen=True)
class Version:
    """What one manifest says."""

    number: int = 0
    schema: dict | None = None
    partition_col: str | None = None
    loads: list[str] = field(default_factory=list)
    taken: list[str] = field(default_factory=list)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, Path = _fs(spark, path)
    if not fs.exists(Path(path)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(Path(path)))


def _read(spark: SparkSession, path: str) -> str:
    fs, Path = _fs(spark, path)
    stream = fs.open(Path(path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The newest manifest of a table; None if nothing was ever committed."""
    names = [n for n in _names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json") and not n.startswith(".")]
    if not names:
        return None
    return Version(**json.loads(_read(spark, f"{path}/{MANIFESTS}/{names[-1]}")))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the table has a committed version."""
    return current_version(spark, path) is not None


def _commit(spark: SparkSession, path: str, version: Version) -> None:
    """Switch the table to ``version``: the last step of every write."""
    fs, Path = _fs(spark, path)
    folder = f"{path}/{MANIFESTS}"
    fs.mkdirs(Path(folder))
    draft, final = Path(f"{folder}/.{uuid.uuid4().hex}"), Path(f"{folder}/{version.number:08d}.json")
    out = fs.create(draft, False)
    try:
        out.write(json.dumps(version.__dict__).encode())
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise ConcurrentWrite(f"{path}: version {version.number} was committed by another writer")


def _write_load(df: DataFrame, path: str, partition_col: str | None) -> str:
    """A load folder with the rows; not yet part of the table."""
    load = "w" + uuid.uuid4().hex
    writer = (df.hint("rebalance", partition_col) if partition_col else df).write.mode("errorifexists")
    if partition_col:
        writer = writer.partitionBy(partition_col)
    writer.parquet(f"{path}/{LOAD}={load}")
    return load


def read_version(spark: SparkSession, path: str, version: Version, loads: list[str] | None = None) -> DataFrame:
    """The rows of a version, or of some of its loads."""
    schema = T.StructType.fromJson(version.schema)
    mine = [x for x in version.loads if loads is None or x in loads]
    # a load without rows may be a folder without files
    mine = [x for x in mine if any(not n.startswith(("_", ".")) for n in _names(spark, f"{path}/{LOAD}={x}"))]
    if not mine:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("basePath", path)
            .parquet(*[f"{path}/{LOAD}={x}" for x in mine]).select(*schema.names))


def read_table(spark: SparkSession, path: str, loads: list[str] | None = None) -> DataFrame | None:
    """The newest version of a table; None if there is none."""
    version = current_version(spark, path)
    return None if version is None else read_version(spark, path, version, loads)


def replace_table(df: DataFrame, path: str, *, partition_col: str | None = None,
                  taken: list[str] | None = None) -> DataFrame:
    """Replace the whole table (``taken``: the keys its rows stand for) and
    return the new version.  ``df`` may read the version it replaces."""
    spark = df.sparkSession
    old = current_version(spark, path) or Version()
    load = _write_load(df, path, partition_col)
    new = Version(old.number + 1, df.schema.jsonValue(), partition_col, [load], sorted(set(taken or [])))
    _commit(spark, path, new)
    return read_version(spark, path, new)


def append_load(df: DataFrame, path: str, partition_col: str | None = None, *,
                taken: list[str] | None = None) -> Version:
    """Add the rows of ``df`` as one load that takes in the keys ``taken``."""
    spark = df.sparkSession
    old = current_version(spark, path) or Version()
    load = _write_load(df, path, partition_col)
    schema = old.schema if old.schema is not None else df.schema.jsonValue()
    new = Version(old.number + 1, schema, partition_col, [*old.loads, load], sorted({*old.taken, *(taken or [])}))
    _commit(spark, path, new)
    return new


def not_taken(spark: SparkSession, path: str, keys: list[str]) -> list[str]:
    """The keys that the table has not taken in yet, in their order."""
    version = current_version(spark, path)
    seen = set(version.taken) if version else set()
    return [k for k in keys if k not in seen]


def append_once(df: DataFrame, path: str, partition_col: str | None, key: str) -> bool:
    """Append unless a load with this key was committed before."""
    if not not_taken(df.sparkSession, path, [key]):
        return False
    append_load(df, path, partition_col, taken=[key])
    return True


def compact_table(spark: SparkSession, path: str) -> DataFrame:
    """Rewrite all loads as one; what was taken in stays known."""
    version = current_version(spark, path)
    return replace_table(read_version(spark, path, version), path, partition_col=version.partition_col,
                         taken=version.taken)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove loads that none of the last ``keep`` versions names, and older
    manifests.  Not while a writer is at work: its load has no manifest yet."""
    fs, Path = _fs(spark, path)
    names = [n for n in _names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json")]
    held = {x for n in names[-keep:] for x in json.loads(_read(spark, f"{path}/{MANIFESTS}/{n}"))["loads"]}
    gone = [n for n in _names(spark, path) if n.startswith(f"{LOAD}=") and n[len(LOAD) + 1:] not in held]
    for n in gone:
        fs.delete(Path(f"{path}/{n}"), True)
    for n in names[:-keep]:
        fs.delete(Path(f"{path}/{MANIFESTS}/{n}"), False)
    return gone


def rebuild_table(df: DataFrame, path: str, *, partition_col: str | None = None,
                  view: str | None = None) -> DataFrame:
    """Replace the whole table at ``path`` and return a DataFrame over it
    (a written table also cuts the lineage of what follows)."""
    out = replace_table(df, path, partition_col=partition_col)
    if view:
        out.createOrReplaceTempView(view)
    return out


def append_partitions(df: DataFrame, path: str, partition_col: str) -> None:
    """Append rows into date folders.  ``rebalance`` lets AQE split a hot
    date into several files and merge tiny ones."""
    append_load(df, path, partition_col)
