"""From raw documents to packed training sequences, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import decontam, langid, packing, simhash, toxicity
from lodestar.llm.common import cut, table_path
from lodestar.session import ship_package

ORACLE_SQL = None  # character models, decoding and edit distances have no SQL form


def _rows(docs: DataFrame) -> DataFrame:
    """Each row as one column beside its text, so that no other name clashes."""
    return docs.select(F.struct("*").alias("row"), F.col("text"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a known language; those without a letter, or far from
    every language's texts, go.  Learned from the documents' own lang."""
    ship_package(spark)
    judged = langid.identify(_rows(docs), langid.learn(docs), keep=("row",))
    return judged.filter(~F.col("rejected")).select("row.*")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose restored text scores below 0.7."""
    ship_package(spark)
    model = toxicity.learn(docs, spark.read.parquet(table_path(sf_dir, "labels")))
    return toxicity.score(_rows(docs), model, keep=("row",)).filter(F.col("predicted") == 0).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the smallest doc_id."""
    ship_package(spark)
    return simhash.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no copy of a benchmark item."""
    ship_package(spark)
    items = spark.read.parquet(table_path(sf_dir, "benchmark"))
    return decontam.contamination(_rows(docs), items, keep=("row",)).filter(F.size("matches") == 0).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of at most 1024 tokens."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
