"""Problem 4 over the case pairs and the image pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrain.llm.components import connected_components
from casegrain.plans.registry import Registry
from casegrain.session import table

R = Registry()


def graph_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of both graphs; a one-letter prefix keeps their members apart and leaves the order within each as it is."""
    pairs = table(spark, sf_dir, "pairs").select(F.concat(F.lit("c"), "case_a_uid").alias("a"), F.concat(F.lit("c"), "case_b_uid").alias("b"))
    ids = F.col("pair_id")
    images = table(spark, sf_dir, "pair_descriptions").select(F.concat(F.lit("i"), F.get(ids, F.lit(0))).alias("a"), F.concat(F.lit("i"), F.get(ids, F.lit(1))).alias("b"))
    return pairs.unionByName(images)


LINKS_SQL = """
links AS (
  SELECT DISTINCT 'case' AS graph, case_a_uid AS a, case_b_uid AS b FROM pairs
  UNION SELECT DISTINCT 'image', pair_id[1], pair_id[2] FROM pair_descriptions),
ways AS (SELECT graph, a, b FROM links WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT graph, b, a FROM links WHERE a IS NOT NULL AND b IS NOT NULL),
members AS (SELECT graph, a AS member FROM links WHERE a IS NOT NULL UNION SELECT graph, b FROM links WHERE b IS NOT NULL)
"""

FOUND_SQL = (
    "WITH RECURSIVE"
    + LINKS_SQL
    + """,
label(graph, member, group_id) USING KEY (graph, member) AS (
  SELECT graph, member, member FROM members
  UNION
  (SELECT b.graph, b.b, min(l.group_id)
   FROM label l JOIN ways b ON b.graph = l.graph AND b.a = l.member JOIN recurring.label r ON r.graph = b.graph AND r.member = b.b
   WHERE l.group_id < r.group_id GROUP BY ALL))
SELECT graph, member, group_id FROM label
"""
)


@R.query("p4_found", FOUND_SQL)
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = connected_components(graph_links(spark, sf_dir))
    graph = F.when(F.substring("member", 1, 1) == "c", "case").otherwise("image")
    return out.select(graph.alias("graph"), F.expr("substring(member, 2)").alias("member"), F.expr("substring(group_id, 2)").alias("group_id"))
