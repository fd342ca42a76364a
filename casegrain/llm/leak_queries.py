"""Problem 6: eval_items in documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrain.llm.leaks import find_leaks
from casegrain.plans.registry import Registry
from casegrain.session import table

R = Registry()


@R.query("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


@R.query("p6_items")
def p6_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per test item: how many documents carry it, wholly or in part."""
    items = table(spark, sf_dir, "eval_items").select("item_id", "suite")
    found = find_leaks(table(spark, sf_dir, "documents"), items.join(table(spark, sf_dir, "eval_items").select("item_id", "text"), "item_id"))
    per = found.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("spanned_words").alias("longest"))
    return items.join(per, "item_id", "left").select("item_id", "suite", F.coalesce("documents", F.lit(0)).alias("documents"), "longest")
