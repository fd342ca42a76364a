"""Problem 7 over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casegrain.llm.pii import find_personal, replace_personal
from casegrain.plans.registry import Registry
from casegrain.session import table

R = Registry()


@R.query("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(table(spark, sf_dir, "documents")).distinct()


@R.query("p7_redacted")
def p7_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal information replaced by typed placeholders."""
    return replace_personal(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "redacted", "spots")
