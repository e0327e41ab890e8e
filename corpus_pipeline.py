"""The corpus pipeline: stages applied one after another to `documents`, each written as Parquet and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import stages
from voxloom.llm.common import Scratch, table

STAGES = stages.STAGES

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
