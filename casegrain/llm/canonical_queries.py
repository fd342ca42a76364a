"""Problem 2: modality, anatomy and diagnosis of pair descriptions against canonical_terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrain.llm.canonical import map_values
from casegrain.llm.canonical_sql import FOUND_SQL, UNMATCHED_SQL
from casegrain.operators.joins import small_join
from casegrain.plans.registry import Registry
from casegrain.session import Tables, table

R = Registry()

FIELDS = ["modality", "anatomy", "diagnosis"]


def entered_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record_index, field, value: the non-blank values of every row."""
    t = table(spark, sf_dir, "pair_descriptions").select("record_index", *FIELDS)
    long = t.select("record_index", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in FIELDS])).alias("e")).select("record_index", "e.*")
    return long.where(F.trim(F.regexp_replace("value", r"(?U)[\s\p{Cf}]+", "")) != "")


def reference_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "canonical_terms")
    return t.select("field", F.explode(F.concat(F.array("term"), F.coalesce("aliases", F.array()))).alias("name"), F.col("term_id").alias("entry"))


def mapped_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """field, value, entry: each distinct value that is not a term of its field as written, mapped once and kept as a table."""
    distinct = entered_values(spark, sf_dir).select("field", "value").distinct()
    terms = table(spark, sf_dir, "canonical_terms").select("field", F.col("term").alias("value"))
    return Tables(spark, "mapped").keep(map_values(distinct.join(terms, ["field", "value"], "left_anti"), reference_names(spark, sf_dir)), "values")


@R.query("p2_found", FOUND_SQL)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = small_join(entered_values(spark, sf_dir), mapped_values(spark, sf_dir), ["field", "value"], ["record_index"])
    return found.select("record_index", "field", F.col("entry").alias("term_id")).distinct()


@R.query("p2_unmatched", UNMATCHED_SQL)
def p2_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that name nothing on the list, with the number of records that hold them."""
    none = mapped_values(spark, sf_dir).where(F.col("entry") == -1)
    found = small_join(entered_values(spark, sf_dir), none, ["field", "value"], ["record_index"]).select("record_index", "field", "value").distinct()
    return found.groupBy("field", "value").agg(F.count(F.lit(1)).alias("records"))
