"""A training corpus from `documents`: five stages, each one corpus operator.

Between stages the rows are written as Parquet to the shared folder and read again,
so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm import stages
from recordloom.llm.common import drop, scratch

STAGES = [
    ("quality rules", stages.quality_stage),
    ("near-dedup", stages.near_dedup_stage),
    ("suffix-array dedup", stages.substring_stage),
    ("benchmark decontamination", stages.decontamination_stage),
    ("best-fit packing", stages.packing_stage),
]

#: Tokenisation and likelihood weights have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs, before = stages.read_table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return out
        path = scratch(spark, f"stage{number}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        drop(before)
        before = path
    return docs
