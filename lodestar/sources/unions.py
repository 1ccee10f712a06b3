"""Unions, flattening and stamping of records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bag_union(dfs: list[DataFrame]) -> DataFrame:
    """UNION ALL by position; duplicates are kept."""
    return reduce(lambda a, b: a.union(b), dfs)


def schema_union(dfs: list[DataFrame], *, sort_columns: bool = True,
                 fill: str | None = None) -> DataFrame:
    """Union by column name; a column missing from an input is NULL there
    (or ``fill`` for string columns).  Columns sorted by name, as a header
    built from the sorted key union."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    if fill is not None:
        u = u.na.fill(fill, [f.name for f in u.schema.fields if isinstance(f.dataType, T.StringType)])
    return u.select(*sorted(u.columns)) if sort_columns else u


def record_keys(df: DataFrame, record: str) -> list[str]:
    """The names of all top-level keys that any record has, sorted.  One
    aggregate gathers the schema over all records; its text, which grows with
    the number of keys and not of records, is all that reaches the driver."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(record).cast("string"))).alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<"):
        return []
    # the schema's text is that of a struct under another name, outside quoted names
    parts = found.split("`")
    parts[::2] = [p.replace("OBJECT<", "STRUCT<") for p in parts[::2]]
    return sorted(f.name for f in T._parse_datatype_string("`".join(parts)).fields)


def record_union(df: DataFrame, record: str, *, keep: list[str] | None = None, fill: str | None = "") -> DataFrame:
    """Records as JSON text, each with keys of its own, to one flat table: a
    text column for every key of any record, sorted by name, and the columns
    ``keep`` among them.

    A key that a record lacks, or holds as null, becomes ``fill``; a nested
    value becomes JSON text; text that is no JSON object has ``fill`` in every
    key.  A key named as a kept column is an error."""
    keep = keep or []
    keys = record_keys(df.where(_is_object(record)), record)
    if set(keys) & set(keep):
        raise ValueError(f"record keys clash with kept columns: {sorted(set(keys) & set(keep))}")
    whole = F.try_parse_json(F.col(record).cast("string"))
    rows = df.select(*keep, F.when(_is_object(record), F.try_variant_get(whole, "$", "map<string,variant>")).alias("__m"))
    value = {k: F.try_element_at("__m", F.lit(k)).cast("string") for k in keys}
    cols = {k: (F.coalesce(v, F.lit(fill)) if fill is not None else v).alias(k) for k, v in value.items()}
    cols |= {k: F.col(k) for k in keep}
    return rows.select(*[cols[k] for k in sorted(cols)])


def _is_object(record: str):
    """Whether a text column holds a JSON object; never NULL."""
    v = F.try_parse_json(F.col(record).cast("string"))
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT<"), F.lit(False))


_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def flatten_nested(df: DataFrame) -> DataFrame:
    """Every struct/array/map/variant column to JSON text: one flat row per
    record, ready for a text sink."""
    return df.select(*[
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f.name)
        for f in df.schema.fields])


def load_stamp(df: DataFrame, load_date, *, name: str = "collected_date",
               fmt: str = "yyyyMMdd") -> DataFrame:
    """Stamp each row with the load date as text (a run-level constant)."""
    d = F.lit(str(load_date)).cast("date") if not hasattr(load_date, "_jc") else load_date
    return df.withColumn(name, F.date_format(d, fmt))
