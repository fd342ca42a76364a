"""From raw patients to indexed similarity pairs, over the table ``patients``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrain.functions.keys import article_id, case_uid, ordered_pair, pair_key, uid_article, uid_case
from casegrain.operators import cohort, graph
from casegrain.plans.registry import Registry
from casegrain.session import table

R = Registry()
METADATA = ["source_note", "code", "note"]

NORMAL = """
p AS (SELECT csv_row, similar_patients AS raw, trim(similar_patients) AS t, source_note, code, note, ingested_at,
      regexp_extract(patient_uid, '(?i)^\\s*(?:PMC)?0*(\\d+)[-_]0*(\\d+)\\s*$', 1) || '-' || regexp_extract(patient_uid, '(?i)^\\s*(?:PMC)?0*(\\d+)[-_]0*(\\d+)\\s*$', 2) AS uid
      FROM patients WHERE regexp_matches(patient_uid, '(?i)^\\s*(?:PMC)?0*\\d+[-_]0*\\d+\\s*$')),
s AS (SELECT *, CASE WHEN t IS NULL OR t = '' THEN 'missing'
      WHEN regexp_matches(t, '^\\{([''"](PMC)?\\d+[-_]\\d+[''"]: ?-?[0-9.]+(, ?)?)*\\}$') AND NOT t LIKE '%, }' THEN 'ok'
      WHEN regexp_matches(t, '^\\{\\d+: .*\\}$') THEN 'invalid_keys'
      WHEN regexp_matches(t, '^\\[.*\\]$') OR t = 'NaN' THEN 'non_mapping' ELSE 'malformed' END AS status FROM p),
e AS (SELECT csv_row, uid AS src, unnest(regexp_extract_all(t, '[''"](?:PMC)?\\d+[-_]\\d+[''"]: ?-?[0-9.]+')) AS kv FROM s WHERE status = 'ok'),
links AS (SELECT csv_row, src, regexp_extract(kv, '(\\d+)[-_](\\d+)', 1) || '-' || regexp_extract(kv, '(\\d+)[-_](\\d+)', 2) AS dst, regexp_extract(kv, ': ?(-?[0-9.]+)$', 1) AS score FROM e),
merged AS (SELECT src, dst, max_by(score, csv_row) AS score, count(*) AS "rows", sum(conflict) AS score_conflicts FROM (
      SELECT *, CAST(coalesce(lag(score) OVER (PARTITION BY src, dst ORDER BY csv_row) <> score, false) AS INT) AS conflict FROM links) GROUP BY src, dst),
single AS (SELECT min(uid) AS uid FROM (SELECT DISTINCT uid FROM p) GROUP BY split_part(uid, '-', 1) HAVING count(*) = 1),
cohort AS (SELECT * FROM merged WHERE src <> dst AND src IN (SELECT uid FROM single) AND dst IN (SELECT uid FROM single)),
pairs0 AS (SELECT DISTINCT CASE WHEN swap THEN dst ELSE src END AS case_a_uid, CASE WHEN swap THEN src ELSE dst END AS case_b_uid FROM (
      SELECT *, (CAST(split_part(dst, '-', 1) AS BIGINT), CAST(split_part(dst, '-', 2) AS BIGINT)) < (CAST(split_part(src, '-', 1) AS BIGINT), CAST(split_part(src, '-', 2) AS BIGINT)) AS swap FROM cohort))
"""


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "patients")


@R.query("q_normal_uids", r"""SELECT DISTINCT patient_uid, CASE WHEN regexp_matches(patient_uid, '(?i)^\s*(?:PMC)?0*\d+[-_]0*\d+\s*$') THEN
    CAST(CAST(regexp_extract(patient_uid, '(?i)(\d+)[-_](\d+)', 1) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(regexp_extract(patient_uid, '(?i)(\d+)[-_](\d+)', 2) AS BIGINT) AS VARCHAR) END AS uid FROM patients""")  # fmt: skip
def q_normal_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patients(spark, sf_dir).select("patient_uid", case_uid(F.col("patient_uid")).alias("uid")).distinct()


@R.query("q_unify", "WITH" + NORMAL + """, c AS (SELECT *, """ + ", ".join(
    f"CAST(row_number() OVER w > 1 AND lag({c}) OVER w IS DISTINCT FROM {c} AS INT) AS {c}_x" for c in METADATA) + """ FROM p WINDOW w AS (PARTITION BY uid ORDER BY csv_row))
    SELECT uid, """ + ", ".join(f"last({c} ORDER BY csv_row) AS {c}, sum({c}_x) AS {c}_conflicts" for c in METADATA) + ", list(csv_row ORDER BY csv_row) AS csv_rows FROM c GROUP BY uid")  # fmt: skip
def q_unify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates resolved: metadata of the last row, row numbers, conflicts with the row before."""
    return cohort.unify(patients(spark, sf_dir), METADATA)


@R.query("q_parse_status", "WITH" + NORMAL + """SELECT status, count(*) AS "rows", sum(CASE WHEN status = 'ok' THEN len(regexp_extract_all(t, '\\d+[-_]\\d+')) ELSE 0 END) AS links FROM s GROUP BY status""")
def q_parse_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = patients(spark, sf_dir)
    return cohort.parse_status_counts(p.where(case_uid(F.col("patient_uid")).isNotNull()))


@R.query("q_merged_links", "WITH" + NORMAL + 'SELECT src, dst, CAST(score AS DOUBLE) AS score, "rows", score_conflicts FROM merged')
def q_merged_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.merged_links(patients(spark, sf_dir)).withColumn("score", F.col("score").cast("double"))


@R.query("q_single_patients", "WITH" + NORMAL + "SELECT uid FROM single")
def q_single_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.single_patient_uids(patients(spark, sf_dir).select(case_uid(F.col("patient_uid")).alias("uid")).where(F.col("uid").isNotNull()))


@R.query("q_cohort_links", "WITH" + NORMAL + 'SELECT src, dst, CAST(score AS DOUBLE) AS score, "rows", score_conflicts FROM cohort')
def q_cohort_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.cohort_links(patients(spark, sf_dir)).withColumn("score", F.col("score").cast("double"))


@R.query("q_cohort_members", "WITH" + NORMAL + "SELECT uid, max(n) AS targets FROM (SELECT src AS uid, count(*) AS n FROM cohort GROUP BY src UNION ALL SELECT DISTINCT dst, 0 FROM cohort) GROUP BY uid")
def q_cohort_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.cohort_members(cohort.cohort_links(patients(spark, sf_dir)))


@R.query("q_indexed_pairs", "WITH" + NORMAL + """SELECT row_number() OVER (ORDER BY CAST(split_part(case_a_uid, '-', 1) AS BIGINT), CAST(split_part(case_a_uid, '-', 2) AS BIGINT),
    CAST(split_part(case_b_uid, '-', 1) AS BIGINT), CAST(split_part(case_b_uid, '-', 2) AS BIGINT)) - 1 AS pair_index, case_a_uid, case_b_uid, sha256(case_a_uid || chr(0) || case_b_uid) AS pair_key FROM pairs0""")  # fmt: skip
def q_indexed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: undirected pairs of the cohort with stable index and key."""
    return graph.indexed_pairs(graph.candidate_pairs(cohort.cohort_links(patients(spark, sf_dir))))


@R.query("q_missing_targets", "WITH" + NORMAL + "SELECT dst AS uid, count(DISTINCT src) AS sources FROM merged WHERE dst NOT IN (SELECT uid FROM p) GROUP BY dst")
def q_missing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link targets that no patient row has."""
    p = patients(spark, sf_dir)
    uids = p.select(case_uid(F.col("patient_uid")).alias("dst")).where(F.col("dst").isNotNull())
    return cohort.merged_links(p).join(uids, "dst", "left_anti").groupBy(F.col("dst").alias("uid")).agg(F.countDistinct("src").alias("sources"))


@R.query("q_pair_problems", r"""WITH x AS (SELECT pair_index, case_a_uid a, case_b_uid b, pair_key k, CAST(split_part(case_a_uid, '-', 1) AS BIGINT) aa, CAST(split_part(case_a_uid, '-', 2) AS BIGINT) ac,
    CAST(split_part(case_b_uid, '-', 1) AS BIGINT) ba, CAST(split_part(case_b_uid, '-', 2) AS BIGINT) bc FROM pairs)
    SELECT DISTINCT pair_index, 'missing_end' AS problem FROM x WHERE a IS NULL OR b IS NULL
    UNION ALL SELECT DISTINCT pair_index, 'wrong_orientation' FROM x WHERE a IS NOT NULL AND b IS NOT NULL AND (ba < aa OR (ba = aa AND bc <= ac))
    UNION ALL SELECT DISTINCT pair_index, 'wrong_key' FROM x WHERE k IS DISTINCT FROM sha256(a || chr(0) || b)
    UNION ALL SELECT DISTINCT pair_index, 'bad_index' FROM x WHERE pair_index IS NULL OR pair_index < 0""")  # fmt: skip
def q_pair_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.pair_problems(table(spark, sf_dir, "pairs")).distinct()


@R.query("q_pair_keys", r"""SELECT DISTINCT CASE WHEN (ba, bc) < (aa, ac) THEN b ELSE a END AS case_a_uid, CASE WHEN (ba, bc) < (aa, ac) THEN a ELSE b END AS case_b_uid,
    sha256(CASE WHEN (ba, bc) < (aa, ac) THEN b || chr(0) || a ELSE a || chr(0) || b END) AS pair_key FROM (SELECT case_a_uid a, case_b_uid b, CAST(split_part(case_a_uid, '-', 1) AS BIGINT) aa,
    CAST(split_part(case_a_uid, '-', 2) AS BIGINT) ac, CAST(split_part(case_b_uid, '-', 1) AS BIGINT) ba, CAST(split_part(case_b_uid, '-', 2) AS BIGINT) bc FROM pairs
    WHERE case_a_uid IS NOT NULL AND case_b_uid IS NOT NULL)""")  # fmt: skip
def q_pair_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's pairs in canonical orientation, once each, with their keys."""
    p = table(spark, sf_dir, "pairs").where("case_a_uid IS NOT NULL AND case_b_uid IS NOT NULL").select(ordered_pair(F.col("case_a_uid"), F.col("case_b_uid")).alias("p"))
    return p.select(F.col("p.a").alias("case_a_uid"), F.col("p.b").alias("case_b_uid")).distinct().withColumn("pair_key", pair_key(F.col("case_a_uid"), F.col("case_b_uid")))


@R.query("q_articles", "WITH" + NORMAL + "SELECT split_part(uid, '-', 1) AS article, count(DISTINCT uid) AS patients, max(CAST(split_part(uid, '-', 2) AS BIGINT)) AS last_case, count(*) AS \"rows\" FROM p GROUP BY ALL")
def q_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = patients(spark, sf_dir).select(case_uid(F.col("patient_uid")).alias("uid")).where(F.col("uid").isNotNull())
    return p.groupBy(uid_article(F.col("uid")).cast("string").alias("article")).agg(F.countDistinct("uid").alias("patients"), F.max(uid_case(F.col("uid"))).cast("bigint").alias("last_case"), F.count(F.lit(1)).alias("rows"))


@R.query("q_article_ids", r"SELECT DISTINCT pmc_id, CAST(CAST(regexp_extract(pmc_id, '(\d+)', 1) AS BIGINT) AS VARCHAR) AS article FROM images")
def q_article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "images").select("pmc_id", article_id(F.col("pmc_id")).alias("article")).distinct()
