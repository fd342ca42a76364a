"""Problem 1 over citations.cited_title, reference_metadata.title and pair_descriptions.modality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrain.llm.lookalikes import GREEK_SYMBOLS, INSIDE_LATIN, LOOKALIKE_LETTERS, changed_rows, count_members, equal_pairs, make_consistent, representatives
from casegrain.plans.registry import Registry
from casegrain.session import table

R = Registry()


def visible_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All non-null values of the three fields: source_table, source_column, source_key, value."""

    def part(name: str, column: str, key) -> DataFrame:
        t = table(spark, sf_dir, name).where(F.col(column).isNotNull())
        return t.select(F.lit(name).alias("source_table"), F.lit(column).alias("source_column"), key.cast("string").alias("source_key"), F.col(column).alias("value"))

    return (
        part("citations", "cited_title", F.col("pair_index"))
        .unionByName(part("reference_metadata", "title", F.concat("pmc_id", F.lit("/"), "ref_id")))
        .unionByName(part("pair_descriptions", "modality", F.col("record_index")))
    )


def _ranges(points: list[int]) -> str:
    """A character class of these code points for the regular expressions of SQL."""
    out: list[list[int]] = []
    for cp in sorted(points):
        if out and cp == out[-1][1] + 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return "[" + "".join(f"\\x{{{a:x}}}" + (f"-\\x{{{b:x}}}" if b > a else "") for a, b in out) + "]"


def found_sql() -> str:
    """The cases by the rule of the problem, said without classes, counts or rewriting."""
    odd = _ranges([ord(a) for a, _ in equal_pairs() if len(a) == 1 and a not in LOOKALIKE_LETTERS and a not in INSIDE_LATIN])
    alike, inside = _ranges([ord(a) for a in LOOKALIKE_LETTERS]), _ranges([ord(a) for a in INSIDE_LATIN])
    lone = _ranges([ord(a) for a in GREEK_SYMBOLS])
    return f"""WITH v AS (SELECT 'citations' AS source_table, 'cited_title' AS source_column, CAST(pair_index AS VARCHAR) AS source_key, cited_title AS v FROM citations UNION ALL SELECT 'reference_metadata', 'title', pmc_id || '/' || ref_id, title FROM reference_metadata
        UNION ALL SELECT 'pair_descriptions', 'modality', CAST(record_index AS VARCHAR), modality FROM pair_descriptions),
      d AS (SELECT DISTINCT v FROM v WHERE regexp_matches(v, '[^\\x00-\\x7f]')), w AS (SELECT v, list_filter(regexp_extract_all(v, '\\p{{L}}+'), lambda x: regexp_matches(x, '[^\\x00-\\x7f]')) AS ws FROM d),
      c AS (SELECT v, ws, len(list_filter(ws, lambda x: length(x) > 1 AND NOT regexp_matches(x, '\\p{{Latin}}') AND regexp_matches(regexp_replace(x, '{alike}', '', 'g'), '\\p{{L}}'))) > 0 AS foreign_title FROM w),
      bad AS (SELECT v FROM c WHERE regexp_matches(v, '{odd}') OR nfc_normalize(v) <> v OR len(list_filter(ws, lambda x: regexp_matches(x, '\\p{{Latin}}') AND (regexp_matches(x, '{alike}') OR regexp_matches(x, '{inside}')))) > 0
        OR (NOT foreign_title AND len(list_filter(ws, lambda x: NOT regexp_matches(x, '\\p{{Latin}}') AND regexp_full_match(x, '{alike}+') AND NOT regexp_full_match(x, '{lone}'))) > 0))
    SELECT DISTINCT source_table, source_column, source_key FROM v WHERE v IN (SELECT v FROM bad)"""


@R.query("p1_found", found_sql())
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = visible_fields(spark, sf_dir)
    reps = representatives(count_members(values, deciding=True))
    return changed_rows(values, "value", reps).select("source_table", "source_column", "source_key").distinct()


@R.query("p1_consistent")
def p1_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value in its consistent form, with the number of spellings that came together in it."""
    values = visible_fields(spark, sf_dir).groupBy("source_table", "source_column", "value").agg(F.count(F.lit(1)).alias("n"))
    out = make_consistent(values, "value", "consistent", representatives(count_members(visible_fields(spark, sf_dir), deciding=True)))
    return out.groupBy("source_table", "source_column", "consistent").agg(F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("rows"))
