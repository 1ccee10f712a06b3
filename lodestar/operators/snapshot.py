"""Latest state per key.

``row_number() over (partition by id order by date desc) = 1`` sorts every
id's rows in one task; a hot id (a third of the table) would sit in one sort.
Here only narrow rows are aggregated: per key the largest (order columns, hash
of the row), with a partial phase in every task.  The table then keeps the rows
that equal their key's winner, by a hash semi-join whose build side is one
narrow row a key; wide rows stream through it and are never sorted.  What is
left of a key are equal rows, of which a distinct (a hash aggregate) keeps one.

A row's place is decided by its values alone, so the result is deterministic:
rows that tie on all order columns are told apart by the hash of all columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINNER = "__winner"


def _hashable(field: T.StructField):
    """A column as something that can be hashed and compared (maps and
    variants as JSON text)."""
    c = F.col("`" + field.name.replace("`", "``") + "`")
    return F.to_json(c) if isinstance(field.dataType, (T.MapType, T.VariantType)) else c


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``: the row with the largest ``order`` tuple (NULL
    counts as smallest).  All NULL keys form one group, as in SQL
    partitioning."""
    tie = F.xxhash64(*[_hashable(f) for f in df.schema.fields])
    rank = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], tie.alias("tie"))
    narrow = df.select(F.col(key).alias("__key"), rank.alias(WINNER))
    best = narrow.groupBy("__key").agg(F.max(WINNER).alias(WINNER))
    rows = df.withColumn(WINNER, rank)
    kept = rows.join(best.hint("shuffle_hash"), rows[key].eqNullSafe(best["__key"]) & rows[WINNER].eqNullSafe(best[WINNER]),
                     "left_semi").drop(WINNER)
    plain = not any(isinstance(f.dataType, (T.MapType, T.VariantType)) for f in df.schema.fields)
    return kept.distinct() if plain else kept.dropDuplicates([key])
