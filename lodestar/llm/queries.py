"""Registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from lodestar.session import scratch_path

from . import (ann_tree, brown_lm, chat_format, decontam, langid, license_scan, packing, periodic_runs, repair_store,
               simhash, token_counts, toxicity, whitening)
from .common import cut, table_path

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def _register(fn):
    LLM_QUERIES[fn.__name__] = fn
    return fn


@_register
def op1_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.op1_query(spark.read.parquet(table_path(sf_dir, "documents")))


@_register
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    return packing.pack(docs).drop("tier", "step_id")


@_register
def op10_repair_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "op10-ids")
    repair_store.write_ids(spark.read.parquet(table_path(sf_dir, "documents")), path)
    return repair_store.read_ids(spark, path)


@_register
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark.read.parquet(table_path(sf_dir, "documents")))


@_register
def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op9_query(spark.read.parquet(table_path(sf_dir, "documents")))


@_register
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op6_query(spark.read.parquet(table_path(sf_dir, "documents")),
                              spark.read.parquet(table_path(sf_dir, "labels")))


@_register
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op2_query(spark.read.parquet(table_path(sf_dir, "documents")),
                              spark.read.parquet(table_path(sf_dir, "benchmark")))


@_register
def op3_ann_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.op3_query(spark.read.parquet(table_path(sf_dir, "embeddings")))


@_register
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(spark.read.parquet(table_path(sf_dir, "documents")))


@_register
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(table_path(sf_dir, "conversations"))
    stored = cut(chat_format.format_turns(chat_format.with_probe(turns)), "op8-turns")
    return chat_format.read_digest(stored)


@_register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.op11_query(spark.read.parquet(table_path(sf_dir, "documents")))


@_register
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.op12_query(spark.read.parquet(table_path(sf_dir, "documents")))


@_register
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.op13_query(spark.read.parquet(table_path(sf_dir, "embeddings")))


LLM_QUERIES["pipeline"] = corpus_pipeline.run
