"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.session import scratch_path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Ends the lineage: a lost executor rereads the files, it does not repeat
    the work.  The schema is passed on, so an empty frame stays readable.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(col: str, m: int) -> Column:
    """crc32 of the column's text modulo ``m``; a null counts as empty text."""
    text = F.coalesce(F.col(col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(m)


def utf8(col: str) -> Column:
    """The column's text as bytes; a null counts as empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def ints(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def small(batches, rows: int = 512):
    """The same rows in batches of few, so that what a task makes of a batch
    stays small beside it."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
    pa.default_memory_pool().release_unused()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"

