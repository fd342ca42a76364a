"""Problem 5: documents in containers of each pack_capacities.capacity_tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrain.llm.packing import pack_documents
from casegrain.plans.registry import Registry
from casegrain.session import Tables, table

R = Registry()


@R.query("p5_packed")
def p5_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_capacities"))


@R.query("p5_report")
def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per capacity: containers, the fewest that any packing could need, tokens and the share of space used."""
    caps = table(spark, sf_dir, "pack_capacities").select("capacity_id", "purpose", "capacity_tokens")
    per = p5_packed(spark, sf_dir).groupBy("capacity_id").agg(F.countDistinct("container").alias("containers"), F.sum(F.col("token_end") - F.col("token_start")).alias("tokens"))
    return caps.join(per, "capacity_id").select(
        "capacity_id", "purpose", "capacity_tokens", "containers", "tokens", F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("fewest"),
        F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("used"),
    )


@R.query(
    "p5_sound",
    """SELECT capacity_id, (SELECT count(DISTINCT doc_id) FROM documents WHERE text IS NOT NULL) AS documents, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS torn, CAST(0 AS BIGINT) AS uneven
       FROM pack_capacities WHERE capacity_tokens >= 1""",
)
def p5_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per capacity: documents packed, containers beyond it, texts split though they fit, and texts that are not there once and whole."""
    caps = table(spark, sf_dir, "pack_capacities").select("capacity_id", "capacity_tokens").distinct()
    packed = Tables(spark, "packed").keep(p5_packed(spark, sf_dir), "pieces").join(caps, "capacity_id").withColumn("n", F.col("token_end") - F.col("token_start"))
    full = packed.groupBy("capacity_id", "container", "capacity_tokens").agg(F.sum("n").alias("used")).where("used > capacity_tokens").groupBy("capacity_id").agg(F.count(F.lit(1)).alias("overfull"))
    docs = packed.groupBy("capacity_id", "doc_id", "capacity_tokens").agg(
        F.count(F.lit(1)).alias("pieces"), F.countDistinct("piece").alias("different"), F.sum("n").alias("tokens"), F.max("token_end").alias("last"), F.sum(((F.col("n") < F.col("capacity_tokens")) & (F.col("n") > 0)).cast("int")).alias("parts")
    )
    torn = (F.col("tokens") <= F.col("capacity_tokens")) & (F.col("pieces") > 1) | (F.col("parts") > 1)
    uneven = (F.col("pieces") != F.col("different")) | (F.col("tokens") != F.col("last"))
    per = docs.groupBy("capacity_id").agg(F.count(F.lit(1)).alias("documents"), F.sum(torn.cast("bigint")).alias("torn"), F.sum(uneven.cast("bigint")).alias("uneven"))
    return per.join(full, "capacity_id", "left").select("capacity_id", "documents", F.coalesce("overfull", F.lit(0).cast("bigint")).alias("overfull"), "torn", "uneven")
