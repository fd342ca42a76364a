"""Problem 3 over the domain tables: which references have no live, earlier record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrain.operators.references import orphan_references, orphan_report
from casegrain.plans.registry import Registry
from casegrain.session import table

R = Registry()

PERIOD = "yyyy-MM"


def _refs(df: DataFrame, table_name: str, column: str, source_key, **keys) -> DataFrame:
    return df.select(
        F.lit(table_name).alias("source_table"),
        F.lit(column).alias("source_column"),
        source_key.cast("string").alias("source_key"),
        F.col("recorded_at").alias("ref_recorded_at"),
        *[v.alias(k) for k, v in keys.items()],
    )


def domain_references(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, DataFrame, list[tuple[str, str]]]]:
    """References, their targets and the key columns of both, for each kind of reference."""
    pairs = table(spark, sf_dir, "pairs").select("pair_index", "case_a_uid", "case_b_uid", "recorded_at")
    ends = None
    for c in ("case_a_uid", "case_b_uid"):
        one = _refs(pairs.where(F.col(c).isNotNull()), "pairs", c, F.col("pair_index"), target=F.col(c))
        ends = one if ends is None else ends.unionByName(one)
    cases = table(spark, sf_dir, "cases").select("patient_uid", "recorded_at", "withdrawn_at")

    captions = table(spark, sf_dir, "captions").where(F.col("image_path").isNotNull())
    captions = _refs(captions, "captions", "image_path", F.col("caption_id"), target=F.col("image_path"))
    images = table(spark, sf_dir, "images").select("image_path", "recorded_at", "withdrawn_at")

    citations = table(spark, sf_dir, "citations").where(F.col("ref_id").isNotNull())
    article = F.regexp_extract("citing_uid", r"^([0-9]+)-", 1)
    citations = _refs(citations, "citations", "ref_id", F.col("pair_index"), article=article, target=F.col("ref_id"))
    listed = table(spark, sf_dir, "reference_metadata").select("pmc_id", "ref_id", "recorded_at", "withdrawn_at")

    return [(ends, cases, [("target", "patient_uid")]), (captions, images, [("target", "image_path")]), (citations, listed, [("article", "pmc_id"), ("target", "ref_id")])]


def domain_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per orphan reference and delivery: table, column, key, month, reason."""
    found = [orphan_references(refs, targets, keys, "ref_recorded_at") for refs, targets, keys in domain_references(spark, sf_dir)]
    cols = ["source_table", "source_column", "source_key", F.date_format("ref_recorded_at", PERIOD).alias("period"), "reason"]
    out = found[0].select(*cols)
    for f in found[1:]:
        out = out.unionByName(f.select(*cols))
    return out


ORPHANS_SQL = """
WITH refs AS (
  SELECT 'pairs' AS source_table, 'case_a_uid' AS source_column, CAST(pair_index AS VARCHAR) AS source_key, 'case' AS kind,
         CAST('' AS VARCHAR) AS scope, case_a_uid AS k, recorded_at FROM pairs WHERE case_a_uid IS NOT NULL
  UNION ALL
  SELECT 'pairs', 'case_b_uid', CAST(pair_index AS VARCHAR), 'case', '', case_b_uid, recorded_at FROM pairs WHERE case_b_uid IS NOT NULL
  UNION ALL
  SELECT 'captions', 'image_path', caption_id, 'image', '', image_path, recorded_at FROM captions WHERE image_path IS NOT NULL
  UNION ALL
  SELECT 'citations', 'ref_id', CAST(pair_index AS VARCHAR), 'ref', coalesce(split_part(citing_uid, '-', 1), '?'), ref_id, recorded_at
  FROM citations WHERE ref_id IS NOT NULL),
targets AS (
  SELECT 'case' AS kind, '' AS scope, patient_uid AS k, recorded_at, withdrawn_at FROM cases
  UNION ALL SELECT 'image', '', image_path, recorded_at, withdrawn_at FROM images
  UNION ALL SELECT 'ref', pmc_id, ref_id, recorded_at, withdrawn_at FROM reference_metadata),
state AS (
  SELECT kind, scope, k, min(recorded_at) AS first_seen, max((recorded_at, withdrawn_at IS NOT NULL))[2] AS gone FROM targets
  WHERE k IS NOT NULL GROUP BY ALL),
judged AS (
  SELECT source_table, source_column, source_key, strftime(r.recorded_at, '%Y-%m') AS period,
         CASE WHEN s.k IS NULL THEN 'absent' WHEN s.gone THEN 'withdrawn' WHEN s.first_seen > r.recorded_at THEN 'later' END AS reason
  FROM refs r LEFT JOIN state s USING (kind, scope, k))
"""


@R.query("p3_found", ORPHANS_SQL + "SELECT DISTINCT source_table, source_column, source_key, period FROM judged WHERE reason IS NOT NULL")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain_orphans(spark, sf_dir).select("source_table", "source_column", "source_key", "period").distinct()


@R.query(
    "p3_report",
    ORPHANS_SQL
    + """SELECT source_table, source_column, period, reason, count(DISTINCT source_key) AS orphans FROM judged
         WHERE reason IS NOT NULL GROUP BY ALL""",
)
def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, column, month and reason; references are added up per key and month before they meet their targets."""
    parts = [orphan_report(refs, targets, keys, ["source_table", "source_column"], ref_recorded="ref_recorded_at", period=PERIOD) for refs, targets, keys in domain_references(spark, sf_dir)]
    return reduce(DataFrame.unionByName, parts)
