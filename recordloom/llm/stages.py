"""Stages of the corpus pipeline, each one corpus operator.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents, the
last one the packed pieces. Rows: a null text is judged as an empty one; an empty table
gives an empty table; rows repeated whole are one document from near-dedup on; null ids are
kept as they are; columns of any name travel along untouched.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, near_dedup, packing, quality_rules, substring_dedup
from .common import CONTENT, drop, materialise, materialise_native, rows_of_keys, text_keys


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _keys() -> dict:
    """What verdicts are joined by: the id and the content of a text."""
    return dict(zip(CONTENT, text_keys(F.col("text")), strict=True)) | {"doc_id": F.col("doc_id").cast("bigint")}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    verdicts = quality_rules.quality_rules(docs, read_table(spark, sf_dir, "labels"))
    return rows_of_keys(docs, verdicts.where("not kept"), _keys(), "left_anti", materialise_native)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays; rows repeated whole are one document, of which one row stays."""
    verdicts = materialise(near_dedup.near_duplicates(docs).select("doc_id", *CONTENT, "kept"), "near-verdicts")
    repeated = materialise(verdicts.where("kept").groupBy("doc_id", *CONTENT).count().where("count > 1").select("doc_id", *CONTENT), "repeated-rows")
    keys = _keys()
    found = rows_of_keys(docs, verdicts.where("not kept"), keys, "left_anti")
    drop(verdicts)
    if repeated.isEmpty():
        return found
    # of repeated rows the least stays; each task sends one row of a group
    groups = rows_of_keys(found, repeated, keys, "left_semi").groupBy(*[value.alias(f"key_{name}") for name, value in keys.items()])
    least = groups.agg(F.min(F.struct(*docs.columns)).alias("least")).select("least.*")
    return rows_of_keys(found, repeated, keys, "left_anti").unionByName(least)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that start elsewhere too are cut out: those of 400 bytes and more, and those of over 50 words."""
    return substring_dedup.strip_repeats(docs, passage=substring_dedup.PASSAGE_WORDS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    verdicts = decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return rows_of_keys(docs, verdicts.where("contaminated"), _keys(), "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their places in sequences."""
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, capacity=2048, release=True)
