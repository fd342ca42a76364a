"""Records handed to a stage, its requests and responses, and the checks of its results: queries over the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrain.functions.keys import case_uid, normal_doi, normal_pmcid, normal_pmid
from casegrain.functions.text import MODALITY_BUCKETS, expand_citation, modality_bucket, numeric_label
from casegrain.operators import batches, citations, cohort, constraints, finalize, handoff, merge
from casegrain.operators.joins import heavy_join
from casegrain.plans.dataset_queries import BUCKET_SQL, DIAGRAM_SQL, FIELDS, VALID_SQL, descriptions, latest, latest_sql
from casegrain.plans.registry import Registry
from casegrain.session import table
from casegrain.sources import files

R = Registry()

LIVE_CASES = latest_sql("cases", "patient_uid")
LIVE_REFS = latest_sql("reference_metadata", "pmc_id, ref_id")
CITATIONS_SQL = "(SELECT DISTINCT pair_index, status, direction, citing_uid, cited_uid, match_type, ref_id, citation_paragraphs FROM citations WHERE pair_index IS NOT NULL)"
PAIRS_SQL = "(SELECT DISTINCT pair_index, case_a_uid AS a, case_b_uid AS b FROM pairs)"


def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pairs").select("pair_index", "case_a_uid", "case_b_uid").distinct()


def distinct_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "citations").where("pair_index IS NOT NULL").select("pair_index", *handoff.CITATION, "citation_paragraphs").distinct()


@R.query("q_pair_reasons", f"""WITH k AS (SELECT patient_uid, max((recorded_at, withdrawn_at IS NOT NULL))[2] AS gone FROM cases GROUP BY 1), c AS (SELECT pair_index, min(status) AS status FROM {CITATIONS_SQL} GROUP BY 1)
    SELECT CASE WHEN a IS NULL OR b IS NULL THEN 'missing_end' WHEN x.gone IS NULL OR y.gone IS NULL THEN 'unknown_case' WHEN x.gone OR y.gone THEN 'withdrawn_case' WHEN c.status IS NULL THEN 'not_screened'
      WHEN c.status = 'error' THEN 'citation_error' WHEN c.status = 'no_match' THEN 'not_cited' ELSE 'eligible' END AS reason, count(*) AS pairs
    FROM {PAIRS_SQL} p LEFT JOIN k x ON x.patient_uid = a LEFT JOIN k y ON y.patient_uid = b LEFT JOIN c USING (pair_index) GROUP BY 1""")  # fmt: skip
def q_pair_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs by the first reason, in a fixed order, that keeps them from use."""
    last = F.max(F.struct("recorded_at", F.col("withdrawn_at").isNotNull().alias("state")))
    known = table(spark, sf_dir, "cases").groupBy("patient_uid").agg(last.alias("m")).select("patient_uid", "m.state")
    p = distinct_pairs(spark, sf_dir)
    for s in "ab":
        p = heavy_join(p, known.select(F.col("patient_uid").alias(f"case_{s}_uid"), F.col("state").alias(f"gone_{s}")), [f"case_{s}_uid"], "left")
    p = p.join(distinct_citations(spark, sf_dir).groupBy("pair_index").agg(F.min("status").alias("status")), "pair_index", "left")
    rules = {
        "missing_end": F.col("case_a_uid").isNull() | F.col("case_b_uid").isNull(), "unknown_case": F.col("gone_a").isNull() | F.col("gone_b").isNull(), "withdrawn_case": F.col("gone_a") | F.col("gone_b"),
        "not_screened": F.col("status").isNull(), "citation_error": F.col("status") == "error", "not_cited": F.col("status") == "no_match",
    }
    return handoff.ordered_reason(p, rules).groupBy("reason").agg(F.count(F.lit(1)).alias("pairs"))


@R.query("q_selection_problems", f"""WITH s AS (SELECT image_path FROM {latest_sql('images', 'image_path')} WHERE NOT ({DIAGRAM_SQL} <> 'retained')), c AS (SELECT DISTINCT caption_id, image_path FROM captions),
    n AS (SELECT s.image_path, count(c.caption_id) AS n FROM s LEFT JOIN c USING (image_path) GROUP BY 1) SELECT image_path, CASE WHEN n = 0 THEN 'missing' ELSE 'duplicate' END AS problem FROM n WHERE n <> 1""")
def q_selection_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retained live figures for which the captions hold no or several records."""
    kept = merge.diagram_decision(latest(spark, sf_dir, "images", "image_path")).where(~F.col("is_diagram"))
    return handoff.selected_subset(table(spark, sf_dir, "captions").select("caption_id", "image_path").distinct(), kept, "image_path")[1]


@R.query("q_selected_captions", f"""WITH s AS (SELECT image_path FROM {latest_sql('images', 'image_path')} WHERE NOT ({DIAGRAM_SQL} <> 'retained'))
    SELECT DISTINCT caption_id, image_path FROM captions WHERE image_path IN (SELECT image_path FROM s)""")
def q_selected_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = merge.diagram_decision(latest(spark, sf_dir, "images", "image_path")).where(~F.col("is_diagram"))
    return handoff.selected_subset(table(spark, sf_dir, "captions").select("caption_id", "image_path").distinct(), kept, "image_path")[0]


@R.query("q_handoff_pairs", f"""WITH k AS {LIVE_CASES}
    SELECT p.pair_index, a AS case_a_uid, b AS case_b_uid, c.status, c.direction, c.ref_id FROM {PAIRS_SQL} p JOIN {CITATIONS_SQL} c USING (pair_index)
    WHERE a IN (SELECT patient_uid FROM k) AND b IN (SELECT patient_uid FROM k)""")
def q_handoff_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with their citation record, both ends among the live cases."""
    p = handoff.assemble_pairs(distinct_pairs(spark, sf_dir), distinct_citations(spark, sf_dir), latest(spark, sf_dir, "cases", "patient_uid"))
    return p.select("pair_index", "case_a_uid", "case_b_uid", "citation.status", "citation.direction", "citation.ref_id")


@R.query("q_handoff_cases", f"SELECT patient_uid, title, case_description, population_scope.ruleset AS ruleset, population_scope.label AS label FROM {LIVE_CASES} WHERE case_description IS NOT NULL AND population_scope.label IS NOT NULL")
def q_handoff_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases, summaries and classifications, each a table of its own, put together per case."""
    live = latest(spark, sf_dir, "cases", "patient_uid")
    summaries = live.where("case_description IS NOT NULL").select("patient_uid", "case_description")
    classes = live.where("population_scope.label IS NOT NULL").select("patient_uid", "population_scope.*")
    return handoff.assemble_cases(live, summaries, classes).select("patient_uid", "title", "case_description", "population_scope.ruleset", "population_scope.label")


PROMPTS_SQL = f"""t AS (SELECT k.patient_uid, coalesce(case_description, '') || chr(10) || coalesce(string_agg(coalesce(caption_id, '') || ': ' || caption, chr(10) ORDER BY caption_id, caption), '') AS told FROM {LIVE_CASES} k
      LEFT JOIN (SELECT DISTINCT patient_uid, caption_id, coalesce(caption, '') AS caption FROM captions) c ON c.patient_uid = k.patient_uid GROUP BY k.patient_uid, case_description),
    prompts AS (SELECT p.pair_index, 'CASE A' || chr(10) || x.told || chr(10) || 'CASE B' || chr(10) || y.told || chr(10) || 'CITATION' || chr(10) ||
      CASE WHEN len(citation_paragraphs) > 0 THEN array_to_string(citation_paragraphs, chr(10)) ELSE '{handoff.NO_CITATION}' END AS content
    FROM {PAIRS_SQL} p JOIN t x ON x.patient_uid = a JOIN t y ON y.patient_uid = b LEFT JOIN {CITATIONS_SQL} c USING (pair_index) WHERE pair_index IS NOT NULL)"""


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = distinct_pairs(spark, sf_dir).where("pair_index IS NOT NULL")
    said = distinct_citations(spark, sf_dir).select("pair_index", F.col("citation_paragraphs").alias("paragraphs"))
    return handoff.assemble_prompts(pairs.join(said, "pair_index", "left"), latest(spark, sf_dir, "cases", "patient_uid"), table(spark, sf_dir, "captions"))


@R.query("q_prompts", f"WITH {PROMPTS_SQL} SELECT pair_index, length(content) AS letters, sha256(content) AS digest FROM prompts")
def q_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every request: both cases with captions in order, and what one says of the other."""
    return prompts(spark, sf_dir).select("pair_index", F.length("content").cast("bigint").alias("letters"), F.sha2("content", 256).alias("digest"))


def stage_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request lines of a stage over all pairs; the content is the two ends."""
    p = distinct_pairs(spark, sf_dir).where("pair_index IS NOT NULL").select("pair_index", F.concat_ws(" / ", "case_a_uid", "case_b_uid").alias("content"))
    return handoff.build_stage(p, "citation", "m", "Answer in three lines.", most_bytes=200_000, most_requests=500)[0]


STAGE_SQL = f"WITH p AS (SELECT DISTINCT pair_index FROM pairs WHERE pair_index IS NOT NULL), c AS (SELECT pair_index, count(*) AS n, min(status) AS status FROM citations GROUP BY 1), d AS (SELECT DISTINCT pair_index, status FROM {CITATIONS_SQL})"


@R.query("q_ingested", STAGE_SQL + """ SELECT coalesce(CASE WHEN c.n IS NULL THEN 'missing' WHEN c.n > 1 THEN 'duplicate' WHEN c.status = 'error' THEN 'error' WHEN c.status = 'no_match' THEN 'fields' END, 'usable') AS outcome, count(*) AS requests
    FROM p LEFT JOIN c USING (pair_index) GROUP BY 1 UNION ALL SELECT 'unexpected', count(*) FROM (SELECT pair_index FROM c WHERE pair_index NOT IN (SELECT pair_index FROM p)) HAVING count(*) > 0""")
def q_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses, one for each citation record, reconciled with the requests of all pairs and checked for the fields they need."""
    index = stage_lines(spark, sf_dir).select("ordinal", "custom_id", "pair_index")
    said = table(spark, sf_dir, "citations").where("pair_index IS NOT NULL").select("pair_index", "status").join(index.select("pair_index", "custom_id"), "pair_index", "left")
    text = F.when(F.col("status") == "matched", "Reason for Citation: x\nPossible Similarities: y\nExplanation: z").otherwise("Nothing was found.")
    choice = F.struct(F.lit(0).alias("index"), F.lit("stop").alias("finish_reason"), F.struct(F.lit("assistant").alias("role"), text.alias("content")).alias("message"))
    line = F.to_json(F.struct(F.coalesce("custom_id", F.concat(F.lit("other-"), "pair_index")).alias("custom_id"), F.when(F.col("status") == "error", "failed").alias("error"), F.struct(F.lit(200).alias("status_code"), F.struct(F.array(choice).alias("choices")).alias("body")).alias("response")))
    answers, problems = handoff.ingest_stage(index, batches.read_responses(said.select(line.alias("value"))), batches.citation_problem)
    return answers.select(F.lit("usable").alias("outcome")).unionByName(problems.select(F.col("problem").alias("outcome"))).groupBy("outcome").agg(F.count(F.lit(1)).alias("requests"))


@R.query("q_request_problems", STAGE_SQL + """, s AS (SELECT p.pair_index, d.status FROM p LEFT JOIN d USING (pair_index)), b AS (
      SELECT 'unindexed_line' AS problem FROM s WHERE status IS NULL UNION ALL SELECT 'changed_line' FROM s WHERE status = 'error' UNION ALL SELECT 'wrong_id' FROM s WHERE status = 'error' UNION ALL SELECT 'repeated_line' FROM s WHERE status = 'no_match')
    SELECT problem, count(*) AS requests FROM b GROUP BY 1""")
def q_request_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored lines against their index, after damage: errors are changed, unmatched ones repeated, unscreened ones not indexed."""
    status = distinct_citations(spark, sf_dir).select("pair_index", "status").distinct()
    lines = stage_lines(spark, sf_dir).join(status, "pair_index", "left")
    stored = lines.select(F.when(F.col("status") == "error", F.replace("line", F.lit(" / "), F.lit(" + "))).otherwise(F.col("line")).alias("line"))
    stored = stored.unionByName(lines.where("status = 'no_match'").select("line"))
    index = lines.where("status IS NOT NULL").select("ordinal", "custom_id", F.sha2(F.concat("line", F.lit("\n")), 256).alias("line_sha256"))
    return handoff.request_problems(stored, index, "citation").groupBy("problem").agg(F.count(F.lit(1)).alias("requests"))


@R.query("q_array_problems", f"""WITH {VALID_SQL}, va AS (SELECT *, {BUCKET_SQL} AS bucket FROM v), pa AS (SELECT *, {BUCKET_SQL} AS bucket FROM pp)
    SELECT bucket AS modality_bucket, 'unknown_entry' AS problem, count(*) AS n FROM va WHERE (pair_id, modality, anatomy, diagnosis, coalesce(source_pair_index, -1)) NOT IN (SELECT (pair_id, modality, anatomy, diagnosis, coalesce(source_pair_index, -1)) FROM pa) GROUP BY 1
    UNION ALL SELECT bucket, 'repeated_entry', count(*) FROM (SELECT bucket, pair_id FROM va GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1""")
def q_array_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket arrays made before the first-wins rule, against the final pairs."""
    valid = finalize.valid_pairs(descriptions(spark, sf_dir))
    early = valid.withColumn("modality_bucket", modality_bucket(F.col("modality"))).withColumn("caption", finalize.short_caption(F.col("diagnosis"), F.col("anatomy"), F.col("modality")))
    return handoff.array_problems(finalize.bucket_arrays(early), finalize.positive_pairs(descriptions(spark, sf_dir)))


@R.query("q_order_problems", """WITH a AS (SELECT pair_index, row_number() OVER (ORDER BY pair_index) AS i FROM (SELECT DISTINCT pair_index FROM pairs WHERE pair_index IS NOT NULL)),
      b AS (SELECT pair_index, row_number() OVER (ORDER BY first_at, pair_index) AS i FROM (SELECT pair_index, min(recorded_at) AS first_at FROM citations WHERE pair_index IS NOT NULL GROUP BY 1))
    SELECT pair_index, CASE WHEN b.i IS NULL THEN 'only_left' WHEN a.i IS NULL THEN 'only_right' ELSE 'moved' END AS problem FROM a FULL JOIN b USING (pair_index) WHERE a.i IS DISTINCT FROM b.i""")
def q_order_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs by index against citations by arrival: do both list the same pairs in the same order?"""
    a = distinct_pairs(spark, sf_dir).where("pair_index IS NOT NULL").select("pair_index").distinct()
    b = table(spark, sf_dir, "citations").where("pair_index IS NOT NULL").groupBy("pair_index").agg(F.min("recorded_at").alias("at0"))
    return handoff.order_problems(a, b, "pair_index", ["pair_index"], ["at0", "pair_index"])


@R.query("q_repair_audit", f"""WITH c AS (SELECT DISTINCT pair_index, citing_uid, ref_id, citation_paragraphs AS p FROM {CITATIONS_SQL}), r AS (SELECT pmc_id, ref_id FROM {LIVE_REFS} WHERE trim(title) <> '')
    SELECT CASE WHEN coalesce(len(p), 0) > 0 THEN 'kept' WHEN r.ref_id IS NOT NULL THEN 'filled' ELSE 'no_reliable_intext_marker_found' END AS outcome, count(*) AS records
    FROM c LEFT JOIN r ON r.pmc_id = split_part(citing_uid, '-', 1) AND r.ref_id = c.ref_id GROUP BY 1""")
def q_repair_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty citation texts filled with the title of the reference, and what that did to each record."""
    before = distinct_citations(spark, sf_dir).select("pair_index", "citing_uid", "ref_id", "citation_paragraphs").distinct()
    listed = latest(spark, sf_dir, "reference_metadata", "pmc_id", "ref_id").where("trim(title) <> ''").select("pmc_id", "ref_id", F.array("title").alias("contexts"))
    asked = before.where("citing_uid IS NOT NULL AND ref_id IS NOT NULL").select(F.col("citing_uid").alias("uid"), "ref_id", F.split_part("citing_uid", F.lit("-"), F.lit(1)).alias("pmc_id")).distinct()
    after = citations.fill_contexts(before, asked.join(listed, ["pmc_id", "ref_id"])).drop("repaired")
    return handoff.repair_audit(before, after, "pair_index", "citation_paragraphs")


@R.query("q_older_format", f"""SELECT pair_index, 'PMC' || split_part(citing_uid, '-', 1) || '.nxml' AS citing_file, 'PMC' || split_part(cited_uid, '-', 1) || '.nxml' AS cited_file, replace(citing_uid, '-', '_') AS citing_case, replace(cited_uid, '-', '_') AS cited_case,
    match_type, ref_id AS match_ref_id, coalesce(array_to_string(citation_paragraphs, chr(10) || chr(10)), '') AS extracted_citation FROM {CITATIONS_SQL}""")
def q_older_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return handoff.compatibility_view(distinct_citations(spark, sf_dir))


@R.query("q_uid_lists", """WITH p AS (SELECT DISTINCT case_a_uid AS a, case_b_uid AS b FROM pairs), s AS (SELECT a, b, CAST(split_part(a, '-', 1) AS BIGINT) AS aa, CAST(split_part(a, '-', 2) AS BIGINT) AS ac, CAST(split_part(b, '-', 1) AS BIGINT) AS ba, CAST(split_part(b, '-', 2) AS BIGINT) AS bc FROM p)
    SELECT a, b, CASE WHEN a IS NULL OR b IS NULL THEN 'missing' ELSE 'ok' END AS status, CASE WHEN a IS NULL OR b IS NULL THEN [] WHEN a = b THEN [a] WHEN (ba, bc) < (aa, ac) THEN [b, a] ELSE [a, b] END AS uids FROM s""")
def q_uid_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of uids in JSON and in Python spelling, parsed to distinct uids in numeric order."""
    p = table(spark, sf_dir, "pairs").select(F.col("case_a_uid").alias("a"), F.col("case_b_uid").alias("b")).distinct()
    python = F.concat(F.lit("('PMC"), F.replace("b", F.lit("-"), F.lit("_")), F.lit("', '"), "a", F.lit("', '"), "b", F.lit("')"))
    json = F.concat(F.lit('["'), "b", F.lit('", "'), "a", F.lit('"]'))
    return p.select("a", "b", cohort.uid_list(F.when(F.col("a") < F.col("b"), python).otherwise(json)).alias("u")).select("a", "b", "u.*")


@R.query("q_identifiers", f"""SELECT pmc_id, ref_id, '10.5555/' || lower(ref_id) AS doi, CASE WHEN number IS NULL THEN NULL ELSE CAST(number AS VARCHAR) END AS pmid, 'PMC' || CAST(CAST(pmc_id AS BIGINT) AS VARCHAR) AS pmcid FROM {LIVE_REFS}""")
def q_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers in the spellings people give them, made of each live reference, in normal form again."""
    refs = latest(spark, sf_dir, "reference_metadata", "pmc_id", "ref_id")
    spelt = F.when(F.coalesce(F.col("number") % 2 == 0, F.lit(True)), F.concat(F.lit(" https://DOI.org/10.5555/"), F.upper("ref_id"))).otherwise(F.concat(F.lit("DOI: 10.5555/"), "ref_id", F.lit(" ")))
    return refs.select(
        "pmc_id", "ref_id", normal_doi(spelt).alias("doi"), normal_pmid(F.concat(F.lit(" PMID: 000"), F.col("number").cast("string"))).alias("pmid"), normal_pmcid(F.concat(F.lit("pmcid: pmc00"), "pmc_id")).alias("pmcid")
    )


@R.query("q_citation_numbers", f"""SELECT pmc_id, ref_id, CASE WHEN number BETWEEN 0 AND 999999999 THEN CAST(number AS INT) END AS label,
    CASE WHEN number BETWEEN 0 AND 999999990 THEN list_transform([number, number + 3, number + 4, number + 5, number + 9], lambda x: CAST(x AS INT)) END AS numbers FROM {LIVE_REFS} WHERE number IS NOT NULL""")
def q_citation_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and expressions like [7, 10–12; 16], written for each live reference and read again."""
    refs = latest(spark, sf_dir, "reference_metadata", "pmc_id", "ref_id").where("number IS NOT NULL")
    n = lambda k: (F.col("number") + k).cast("string")
    text = F.concat(F.lit("["), n(9), F.lit("; "), n(0), F.lit(", "), n(3), F.lit(" – "), n(5), F.lit("]"))
    return refs.select("pmc_id", "ref_id", numeric_label(F.concat(F.lit(" ["), n(0), F.lit("]."))).alias("label"), expand_citation(text).alias("numbers"))


BUCKETED = f"WITH n AS (SELECT trim(modality) AS phrase, count(*) AS n FROM pair_descriptions WHERE trim(modality) <> '' GROUP BY 1), b AS (SELECT phrase, n, (SELECT {BUCKET_SQL} FROM (SELECT phrase AS modality)) AS bucket FROM n)"


def bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Counts of the modality phrases and their buckets as labels."""
    counts = finalize.phrase_counts(descriptions(spark, sf_dir)).where("field = 'modality'")
    return counts, counts.select("field", "phrase", F.array(modality_bucket(F.col("phrase"))).alias("labels"))


@R.query("q_unmatched_listing", BUCKETED + " SELECT 'modality' AS field, row_number() OVER (ORDER BY n DESC, phrase) AS position, phrase, n FROM b WHERE bucket = 'other'")
def q_unmatched_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modalities without a bucket, from the most frequent down."""
    counts, labels = bucketed(spark, sf_dir)
    return finalize.frequency_listing(finalize.unmatched_phrases(counts, labels))


@R.query("q_phrase_coverage", BUCKETED + """ SELECT 'modality' AS field, count(*) AS phrases, CAST(sum(n) AS BIGINT) AS descriptions, count(*) FILTER (bucket = 'other') AS unmatched_phrases, CAST(coalesce(sum(n) FILTER (bucket = 'other'), 0) AS BIGINT) AS unmatched_descriptions,
    round(100 * coalesce(sum(n) FILTER (bucket = 'other'), 0) / sum(n), 6) AS other_percent, round(100 * coalesce(sum(n) FILTER (bucket = 'other'), 0) / sum(n), 6) < 2 AS within_limit FROM b""")
def q_phrase_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, labels = bucketed(spark, sf_dir)
    return finalize.phrase_coverage(counts, finalize.unmatched_phrases(counts, labels))


IMAGES_SQL = f"""e AS (SELECT DISTINCT unnest(pair_id) AS image_id, record_index, {BUCKET_SQL} AS b FROM pair_descriptions WHERE modality IS NOT NULL),
    g AS (SELECT image_id, list_distinct(list(b)) AS l FROM e WHERE image_id IS NOT NULL GROUP BY image_id), i AS (SELECT image_id, CASE WHEN len(l) > 1 THEN list_filter(l, lambda x: x <> 'other') ELSE l END AS labels FROM g)"""


def bucket_images(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Labelled pairs and images with the bucket of the modality as the label of every field."""
    label = F.array(modality_bucket(F.col("modality")))
    pairs = descriptions(spark, sf_dir).where("modality IS NOT NULL").select(F.col("record_index").alias("pair_index"), "pair_id", *[label.alias(f) for f in FIELDS])
    return pairs, finalize.image_labels(pairs)


@R.query("q_bucket_coverage", f"WITH {IMAGES_SQL} SELECT field, count(*) AS images, count(*) FILTER (len(labels) > 1) AS multilabel, round(100 * count(*) FILTER (list_contains(labels, 'other')) / count(*), 6) AS other_percent, (SELECT count(DISTINCT x) FROM (SELECT unnest(labels) AS x FROM i)) AS categories FROM i, (VALUES ('modality'), ('anatomy'), ('diagnosis')) f(field) GROUP BY field")
def q_bucket_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of labels per field, over labels that SQL can give too."""
    return finalize.label_coverage(bucket_images(spark, sf_dir)[1])


@R.query("q_provenance_problems", f"""WITH {IMAGES_SQL}, ok AS (SELECT DISTINCT record_index FROM pair_descriptions WHERE len(pair_id) = 2 AND pair_id[1] IS NOT NULL AND pair_id[2] IS NOT NULL AND pair_id[1] <> pair_id[2] AND modality IS NOT NULL)
    SELECT image_id, f || '_undeclared' AS problem FROM i, (VALUES ('modality'), ('anatomy'), ('diagnosis')) x(f) WHERE list_contains(labels, 'other')
    UNION ALL SELECT DISTINCT image_id, 'provenance_wrong' FROM e WHERE image_id IS NOT NULL AND record_index NOT IN (SELECT record_index FROM ok)""")
def q_provenance_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of all records judged against sound records only and a vocabulary without "other"."""
    pairs, images = bucket_images(spark, sf_dir)
    a, b = F.get("pair_id", F.lit(0)), F.get("pair_id", F.lit(1))
    sound = pairs.where((F.size("pair_id") == 2) & a.isNotNull() & b.isNotNull() & (a != b))
    return finalize.label_problems(images, sound, {f: list(MODALITY_BUCKETS) for f in FIELDS})


@R.query("q_case_coverage", f"""WITH f AS (SELECT DISTINCT replace(patient_uid, '_', '-') AS uid FROM {latest_sql('images', 'image_path')} WHERE NOT ({DIAGRAM_SQL} <> 'retained')), p AS (SELECT patient_uid AS uid FROM {LIVE_CASES})
    SELECT uid, 'patient' AS missing FROM f WHERE uid NOT IN (SELECT uid FROM p) UNION ALL SELECT uid, 'figure' FROM p WHERE uid NOT IN (SELECT uid FROM f)""")
def q_case_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live cases without a retained live figure, and figures of cases that are not live."""
    figures = merge.diagram_decision(latest(spark, sf_dir, "images", "image_path")).where(~F.col("is_diagram"))
    return merge.coverage(figures, latest(spark, sf_dir, "cases", "patient_uid").select(F.col("patient_uid").alias("uid")))


@R.query("q_caption_paths", r"""WITH x AS (SELECT DISTINCT image_path AS p, replace(patient_uid, '-', '_') AS uid, pmc_id AS art, 'PMC' || pmc_id AS pmc FROM captions WHERE image_path IS NOT NULL), y AS (SELECT *, regexp_extract(p, '([^/]*?)(?:\.[^./]*)?$', 1) AS stem FROM x)
    SELECT DISTINCT p AS image_path, unnest(list_filter([CASE WHEN regexp_matches(p, '^/|^[A-Za-z]:|\\|(^|/)\.\.(/|$)') THEN 'unsafe_path' END, CASE WHEN NOT lower(p) LIKE '%.jpg' THEN 'wrong_suffix' END, CASE WHEN NOT starts_with(p, 'new_data/') THEN 'outside_tree' END,
      CASE WHEN NOT contains(p, '/' || pmc || '/' || uid || '/') THEN 'wrong_folder' END, CASE WHEN NOT starts_with(stem, uid || '_') THEN 'wrong_stem' END, CASE WHEN art <> split_part(uid, '_', 1) THEN 'article_mismatch' END], lambda z: z IS NOT NULL)) AS problem FROM y""")  # fmt: skip
def q_caption_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image paths of captions, some of which are broken, against their article and case."""
    return merge.asset_problems(table(spark, sf_dir, "captions").where("image_path IS NOT NULL")).distinct()


@R.query("q_live_difference", f"""WITH a AS (SELECT patient_uid AS uid FROM {LIVE_CASES}), b AS (SELECT DISTINCT replace(patient_uid, '_', '-') AS uid FROM captions WHERE trim(caption) <> '')
    SELECT uid, 'left' AS side FROM a WHERE uid NOT IN (SELECT uid FROM b) UNION ALL SELECT uid, 'right' FROM b WHERE uid NOT IN (SELECT uid FROM a)""")
def q_live_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live cases against cases with a caption: which only one side has."""
    a = latest(spark, sf_dir, "cases", "patient_uid").select(F.col("patient_uid").alias("uid"))
    b = table(spark, sf_dir, "captions").where("trim(caption) <> ''").select(case_uid(F.col("patient_uid")).alias("uid"))
    return constraints.difference(a, b, "uid")


@R.query("q_manifest_images", "SELECT image_path, row_number() OVER (ORDER BY image_path) - 1 AS ordinal, n AS rows FROM (SELECT image_path, count(*) AS n FROM images WHERE image_path IS NOT NULL GROUP BY 1)")
def q_manifest_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images of the manifest in order, with their position and how many rows list them."""
    return merge.manifest_images(table(spark, sf_dir, "images"))


@R.query("q_kept_figures", f"SELECT DISTINCT caption_id, image_path FROM captions WHERE image_path IS NOT NULL AND image_path NOT IN (SELECT image_path FROM {latest_sql('images', 'image_path')} WHERE {DIAGRAM_SQL} <> 'retained')")
def q_kept_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captioned figures that are no diagrams by the live image's measures."""
    decisions = merge.diagram_decision(latest(spark, sf_dir, "images", "image_path"))
    return merge.drop_diagrams(table(spark, sf_dir, "captions").where("image_path IS NOT NULL").select("caption_id", "image_path").distinct(), decisions).select("caption_id", "image_path")


@R.query("q_labelling_stats", f"""WITH {VALID_SQL} SELECT 'records' AS stat, count(*) AS n FROM pair_descriptions UNION ALL SELECT 'two_images', count(*) FILTER (len(pair_id) = 2 AND pair_id[1] <> pair_id[2]) FROM pair_descriptions
    UNION ALL SELECT 'all_labels', count(*) FILTER (trim(modality) <> '' AND trim(anatomy) <> '' AND trim(diagnosis) <> '') FROM pair_descriptions
    UNION ALL SELECT 'valid', count(*) FROM v UNION ALL SELECT 'final', count(*) FROM pp UNION ALL SELECT 'repeats_removed', (SELECT count(*) FROM v) - (SELECT count(*) FROM pp)""")
def q_labelling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finalize.labelling_stats(descriptions(spark, sf_dir))


@R.query("q_screen_stats", f"SELECT count(*) AS all_rows, count(*) FILTER (population_scope.label = 'human') AS human, count(*) FILTER (population_scope.label = 'animal') AS animal, count(*) = count(*) FILTER (population_scope.label IN ('human', 'animal')) AS whole FROM {LIVE_CASES}")
def q_screen_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live cases by population, and whether human and animal ones are all of them."""
    return finalize.partition_stats(latest(spark, sf_dir, "cases", "patient_uid").select(F.col("population_scope.label").alias("label")), "label", ["human", "animal"])


@R.query("q_article_files", f"SELECT patient_uid, CASE WHEN title IS NULL THEN 'missing' WHEN case_description IS NULL THEN 'changed' END AS problem FROM {LIVE_CASES}")
def q_article_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded article files against files made here: none where the title is null, another text where the description is."""
    live = latest(spark, sf_dir, "cases", "patient_uid")
    path = F.concat(F.lit("new_data/PMC"), "pmc_id", F.lit("/"), "patient_uid", F.lit(".nxml"))
    text = F.concat(F.coalesce("title", F.lit("?")), F.lit("|"), F.coalesce("case_description", F.lit("?")))
    records = live.select("patient_uid", path.alias("nxml_path"), F.sha2(text, 256).alias("nxml_sha256"))
    made = live.where("title IS NOT NULL").select(path.alias("path"), F.when(F.col("case_description").isNull(), F.concat(text, F.lit("!"))).otherwise(text).cast("binary").alias("content"))
    return files.checked_articles(records, made).select("patient_uid", "problem")
