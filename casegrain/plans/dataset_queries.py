"""Figures, cases, captions, labelled pairs and citations: queries over the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casegrain.functions.keys import article_id, case_uid, figure_number
from casegrain.functions.text import MODALITY_BUCKETS, bucket_words, collapse, modality_bucket
from casegrain.operators import batches, citations, cohort, constraints, finalize, merge, species, taxonomy
from casegrain.plans.registry import Registry
from casegrain.session import table
from casegrain.sources import jats

R = Registry()
FIELDS = finalize.FIELDS


def latest(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    return merge.latest_versions(table(spark, sf_dir, name), list(keys))


def latest_sql(name: str, keys: str, cols: str = "*") -> str:
    return f"(SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY recorded_at DESC, withdrawn_at IS NOT NULL DESC) AS rn FROM {name}) WHERE rn = 1 AND withdrawn_at IS NULL)"


@R.query("q_live_cases", f"SELECT patient_uid, pmc_id, title, recorded_at FROM {latest_sql('cases', 'patient_uid')}")
def q_live_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir, "cases", "patient_uid").select("patient_uid", "pmc_id", "title", "recorded_at")


@R.query("q_live_images", f"SELECT image_path, patient_uid, white_ratio, ocr_text_length FROM {latest_sql('images', 'image_path')}")
def q_live_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir, "images", "image_path").select("image_path", "patient_uid", "white_ratio", "ocr_text_length")


@R.query("q_live_references", f"SELECT pmc_id, ref_id, number, surname, year, title FROM {latest_sql('reference_metadata', 'pmc_id, ref_id')}")
def q_live_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir, "reference_metadata", "pmc_id", "ref_id").select("pmc_id", "ref_id", "number", "surname", "year", "title")


DIAGRAM_SQL = "CASE WHEN coalesce(white_ratio > 0.5, false) THEN 'white_ratio' WHEN coalesce(ocr_text_length > 200, false) THEN 'ocr_text_length' ELSE 'retained' END"


@R.query("q_diagram_reasons", f"SELECT {DIAGRAM_SQL} AS reason, count(*) AS images FROM {latest_sql('images', 'image_path')} GROUP BY ALL")
def q_diagram_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.diagram_decision(latest(spark, sf_dir, "images", "image_path")).groupBy("reason").agg(F.count(F.lit(1)).alias("images"))


PATIENT_SQL = r"(SELECT DISTINCT regexp_extract(patient_uid, '(\d+)[-_](\d+)', 1) || '-' || regexp_extract(patient_uid, '(\d+)[-_](\d+)', 2) AS uid FROM patients)"


@R.query("q_merged_figures", f"""SELECT i.image_path, replace(i.patient_uid, '_', '-') AS uid, CAST(coalesce(nullif(regexp_extract(i.image_path, '_(\\d+)\\.[a-z]+$', 1), ''), '0') AS BIGINT) AS figure, p.note
    FROM {latest_sql('images', 'image_path')} i JOIN (SELECT uid, last(note ORDER BY csv_row) AS note FROM (SELECT *, regexp_extract(patient_uid, '(\\d+)[-_](\\d+)', 1) || '-' || regexp_extract(patient_uid, '(\\d+)[-_](\\d+)', 2) AS uid FROM patients)
    GROUP BY uid) p ON p.uid = replace(i.patient_uid, '_', '-') WHERE NOT ({DIAGRAM_SQL} <> 'retained')""")  # fmt: skip
def q_merged_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retained figures with their patient's metadata, many to one."""
    images = merge.diagram_decision(latest(spark, sf_dir, "images", "image_path")).where(~F.col("is_diagram")).select("image_path", "patient_uid")
    people = cohort.unify(table(spark, sf_dir, "patients"), ["note"]).select("uid", "note")
    return merge.merge_figures(images, people).select("image_path", "uid", figure_number(F.col("image_path")).alias("figure"), "note")


@R.query("q_coverage", f"""WITH f AS (SELECT DISTINCT replace(patient_uid, '_', '-') AS uid FROM images), p AS {PATIENT_SQL}
    SELECT uid, 'patient' AS missing FROM f WHERE uid NOT IN (SELECT uid FROM p) UNION ALL SELECT uid, 'figure' FROM p WHERE uid NOT IN (SELECT uid FROM f)""")
def q_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "patients").select(case_uid(F.col("patient_uid")).alias("uid")).where(F.col("uid").isNotNull())
    return merge.coverage(table(spark, sf_dir, "images"), people)


@R.query("q_asset_problems", r"""WITH x AS (SELECT DISTINCT image_path AS p, replace(patient_uid, '-', '_') AS uid, 'PMC' || regexp_extract(pmc_id, '(\d+)', 1) AS pmc, regexp_extract(pmc_id, '(\d+)', 1) AS art,
      regexp_extract(image_path, '([^/]*)\.[^./]*$', 1) AS stem FROM images)
    SELECT p AS image_path, 'unsafe_path' AS problem FROM x WHERE regexp_matches(p, '^/|^[A-Za-z]:|\\|(^|/)\.\.(/|$)') UNION ALL SELECT p, 'wrong_suffix' FROM x WHERE NOT lower(p) LIKE '%.jpg'
    UNION ALL SELECT p, 'outside_tree' FROM x WHERE NOT starts_with(p, 'new_data/') UNION ALL SELECT p, 'wrong_folder' FROM x WHERE NOT contains(p, '/' || pmc || '/' || uid || '/')
    UNION ALL SELECT p, 'wrong_stem' FROM x WHERE NOT starts_with(stem, uid || '_') UNION ALL SELECT p, 'article_mismatch' FROM x WHERE art <> split_part(uid, '_', 1)""")  # fmt: skip
def q_asset_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.asset_problems(table(spark, sf_dir, "images")).distinct()


@R.query("q_case_records", f"""WITH c AS (SELECT patient_uid, list({{'caption_id': caption_id, 'image_path': image_path, 'caption': caption}} ORDER BY caption_id, image_path NULLS FIRST, caption NULLS FIRST) AS captions
    FROM (SELECT DISTINCT patient_uid, caption_id, image_path, caption FROM captions) GROUP BY patient_uid)
    SELECT k.patient_uid, k.title, coalesce(c.captions, []) AS captions FROM {latest_sql('cases', 'patient_uid')} k LEFT JOIN c USING (patient_uid)""")
def q_case_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = latest(spark, sf_dir, "cases", "patient_uid").select("patient_uid", "title")
    return merge.case_records(cases, table(spark, sf_dir, "captions"))


@R.query("q_duplicate_captions", "SELECT caption_id, count(*) AS n FROM captions GROUP BY caption_id HAVING count(*) > 1")
def q_duplicate_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.duplicates(table(spark, sf_dir, "captions"), "caption_id")


@R.query("q_population_difference", f"""WITH a AS (SELECT DISTINCT patient_uid AS uid FROM cases), b AS {PATIENT_SQL}
    SELECT uid, 'left' AS side FROM a WHERE uid NOT IN (SELECT uid FROM b) UNION ALL SELECT uid, 'right' FROM b WHERE uid NOT IN (SELECT uid FROM a)""")
def q_population_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "cases").select(F.col("patient_uid").alias("uid"))
    b = table(spark, sf_dir, "patients").select(case_uid(F.col("patient_uid")).alias("uid")).where(F.col("uid").isNotNull())
    return constraints.difference(a, b, "uid")


@R.query("q_unresolved_pairs", f"""WITH k AS {latest_sql('cases', 'patient_uid', 'patient_uid')}
    SELECT DISTINCT pair_index, e.side, e.uid FROM pairs, (VALUES ('a'), ('b')) s(side), LATERAL (SELECT s.side, CASE WHEN s.side = 'a' THEN case_a_uid ELSE case_b_uid END AS uid) e
    WHERE e.uid IS NOT NULL AND e.uid NOT IN (SELECT patient_uid FROM k)""")
def q_unresolved_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of pairs that no live case has."""
    ends = table(spark, sf_dir, "pairs").select("pair_index", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"case_{s}_uid").alias("uid")) for s in "ab"])).alias("e")).select("pair_index", "e.*")
    live = latest(spark, sf_dir, "cases", "patient_uid").select(F.col("patient_uid").alias("uid"))
    return ends.where("uid IS NOT NULL").join(live, "uid", "left_anti").select("pair_index", "side", "uid").distinct()


VALID_SQL = """v AS (SELECT DISTINCT list_sort(pair_id) AS pair_id, trim(modality) AS modality, trim(anatomy) AS anatomy, trim(diagnosis) AS diagnosis, source_pair_index FROM pair_descriptions
    WHERE len(pair_id) = 2 AND pair_id[1] IS NOT NULL AND pair_id[2] IS NOT NULL AND pair_id[1] <> pair_id[2] AND trim(modality) <> '' AND trim(anatomy) <> '' AND trim(diagnosis) <> ''),
    pp AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY source_pair_index NULLS LAST, modality, anatomy, diagnosis) AS rn FROM v) WHERE rn = 1)"""
NO_LETTER = r"[^\p{L}\p{N}_]"
BUCKET_SQL = "CASE " + " ".join(f"WHEN regexp_matches(modality, '(?i)(?:^|{NO_LETTER})(?:{bucket_words(n)})(?:$|{NO_LETTER})') THEN '{n}'" for n in MODALITY_BUCKETS) + " ELSE 'other' END"


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pair_descriptions")


@R.query("q_positive_pairs", f"WITH {VALID_SQL} SELECT *, {BUCKET_SQL} AS modality_bucket, diagnosis || ' in the ' || anatomy || ' on ' || modality || '.' AS caption FROM pp")
def q_positive_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled image pairs: canonical ids, first wins, bucket and caption."""
    return finalize.positive_pairs(descriptions(spark, sf_dir))


@R.query("q_bucket_sizes", f"WITH {VALID_SQL} SELECT {BUCKET_SQL} AS modality_bucket, count(*) AS pairs, count(DISTINCT source_pair_index) AS case_pairs FROM pp GROUP BY 1")
def q_bucket_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finalize.bucket_sizes(finalize.positive_pairs(descriptions(spark, sf_dir)))


@R.query("q_bucket_modalities", f"SELECT DISTINCT modality, {BUCKET_SQL} AS bucket FROM pair_descriptions WHERE modality IS NOT NULL")
def q_bucket_modalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = descriptions(spark, sf_dir).select("modality").where("modality IS NOT NULL").distinct()
    return d.withColumn("bucket", modality_bucket(F.col("modality")))


@R.query("q_phrase_counts", " UNION ALL ".join(f"SELECT '{f}' AS field, trim({f}) AS phrase, count(*) AS n FROM pair_descriptions WHERE trim({f}) <> '' GROUP BY ALL" for f in FIELDS))
def q_phrase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finalize.phrase_counts(descriptions(spark, sf_dir))


@R.query("q_image_buckets", f"""WITH e AS (SELECT DISTINCT unnest(pair_id) AS image_id, record_index, {BUCKET_SQL} AS b FROM pair_descriptions WHERE modality IS NOT NULL),
    g AS (SELECT image_id, list_sort(list_distinct(list(b))) AS labels, list_sort(list_distinct(list(record_index))) AS pair_indices FROM e WHERE image_id IS NOT NULL GROUP BY image_id)
    SELECT image_id, CASE WHEN len(labels) > 1 THEN list_filter(labels, lambda x: x <> 'other') ELSE labels END AS labels, pair_indices FROM g""")
def q_image_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of the buckets of all pairs an image is in; "other" only where it is alone."""
    label = F.array(modality_bucket(F.col("modality")))
    pairs = descriptions(spark, sf_dir).where("modality IS NOT NULL").select(F.col("record_index").alias("pair_index"), "pair_id", *[label.alias(f) for f in FIELDS])
    return finalize.image_labels(pairs).select("image_id", F.col("modality").alias("labels"), "pair_indices")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = descriptions(spark, sf_dir).select(F.col("record_index").alias("pair_index"), "pair_id", *FIELDS).distinct()
    return taxonomy.labelled_pairs(d)


@R.query("q_phrase_labels")
def q_phrase_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every distinct phrase by the rule taxonomy; tested on fixed phrases."""
    return taxonomy.phrase_labels(finalize.phrase_counts(descriptions(spark, sf_dir)))


@R.query("q_image_labels")
def q_image_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finalize.image_labels(labelled(spark, sf_dir))


@R.query("q_label_coverage")
def q_label_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finalize.label_coverage(finalize.image_labels(labelled(spark, sf_dir)))


@R.query("q_label_problems")
def q_label_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Must be empty: labels and provenance of all images against their pairs."""
    pairs = labelled(spark, sf_dir)
    return finalize.label_problems(finalize.image_labels(pairs), pairs, taxonomy.taxonomy().categories)


@R.query("q_citation_counts", "SELECT status, direction, match_type, count(DISTINCT pair_index) AS pairs FROM citations GROUP BY ALL")
def q_citation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "citations").groupBy("status", "direction", "match_type").agg(F.countDistinct("pair_index").alias("pairs"))


@R.query("q_references_by_article", "SELECT split_part(citing_uid, '-', 1) AS article, list_sort(list(DISTINCT ref_id)) AS ref_ids FROM citations WHERE ref_id IS NOT NULL AND citing_uid IS NOT NULL GROUP BY 1")
def q_references_by_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "citations").where("ref_id IS NOT NULL AND citing_uid IS NOT NULL")
    return c.groupBy(F.split_part("citing_uid", F.lit("-"), F.lit(1)).alias("article")).agg(F.array_sort(F.collect_set("ref_id")).alias("ref_ids"))


@R.query("q_unique_labels", f"""SELECT pmc_id, number, min(ref_id) AS ref_id FROM {latest_sql('reference_metadata', 'pmc_id, ref_id')} WHERE number IS NOT NULL GROUP BY pmc_id, number HAVING count(*) = 1""")
def q_unique_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference numbers that one reference of an article has alone."""
    refs = latest(spark, sf_dir, "reference_metadata", "pmc_id", "ref_id").select("pmc_id", "ref_id", F.col("number").cast("string").alias("label"))
    return citations.unique_labels(refs, "pmc_id").withColumn("number", F.col("number").cast("bigint"))


@R.query("q_author_years", f"""SELECT pmc_id, lower(trim(surname)) AS surname, trim(year) AS year, min(ref_id) AS ref_id FROM {latest_sql('reference_metadata', 'pmc_id, ref_id')}
    WHERE trim(surname) <> '' AND regexp_matches(trim(year), '^(18|19|20|21)\\d\\d$') GROUP BY ALL HAVING count(*) = 1""")
def q_author_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = latest(spark, sf_dir, "reference_metadata", "pmc_id", "ref_id")
    g = refs.groupBy("pmc_id", F.lower(collapse(F.col("surname"))).alias("surname"), collapse(F.col("year")).alias("year")).agg(F.count(F.lit(1)).alias("n"), F.min("ref_id").alias("ref_id"))
    return g.where((F.col("n") == 1) & (F.col("surname") != "") & F.col("year").rlike(r"^(?:18|19|20|21)\d{2}$")).drop("n")


def species_sql(source: str) -> str:
    """CTEs that end in hits (t, rule): every rule that hits the lower-case texts ``source`` (t), rules without their field.

    Whether a species word names the subject depends on positions: they are summed from the pieces between the matches.
    """
    rules = [*((f"species:{n}", rf"\b(?:{p})\b") for n, p in species.SPECIES.items()), *species.CONTEXT.items(), *((f"ambiguous:{n}", p) for n, p in species.AMBIGUOUS.items())]
    plain = ", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{n}' END" for n, p in rules)
    phrases = "|".join(f"(?:{p})" for n, p in species.AMBIGUOUS.items() if n != "animal_adjective")
    found = " UNION ALL ".join(f"SELECT t, regexp_extract_all(t, '\\b(?:{p})\\b') AS m, string_split_regex(t, '\\b(?:{p})\\b') AS q FROM holding" for p in species.SPECIES.values())
    lens = "coalesce(list_sum(list_transform({}, lambda z: length(z))), 0)"
    covered = f"len(list_filter(range(0, CAST(least(pos, 60) AS BIGINT) + 1), lambda j: length(regexp_extract(substr(' ' || t, CAST(pos - j + 1 AS BIGINT), 160), '^(?s:.)({phrases})', 1)) > j)) > 0"
    left, right = f"substr(t, CAST(greatest(0, pos - {species.BEFORE}) + 1 AS BIGINT), CAST(least(pos, {species.BEFORE}) AS BIGINT))", f"substr(t, CAST(pos + n + 1 AS BIGINT), {species.AFTER})"
    return f"""x AS ({source}), holding AS (SELECT t FROM x WHERE regexp_matches(t, '{species.ANY_SPECIES}')), w AS ({found}), i AS (SELECT t, m, q, unnest(generate_series(1, len(m))) AS i FROM w),
      placed AS (SELECT t, {lens.format('q[1:i]')} + {lens.format('m[1:i-1]')} AS pos, length(m[i]) AS n FROM i),
      named AS (SELECT DISTINCT t FROM placed WHERE (regexp_matches({left}, '{species.SUBJECT}') OR regexp_matches({left}, '{species.IN_SPECIES}') OR regexp_matches({right}, '{species.SUBJECT}')) AND NOT ({covered})),
      hits AS (SELECT t, unnest(list_filter([{plain}], lambda r: r IS NOT NULL)) AS rule FROM x UNION ALL SELECT t, 'explicit_nonhuman_subject' FROM named)"""


TEXTS_SQL = "SELECT DISTINCT lower(coalesce(title, '')) AS t FROM cases UNION SELECT DISTINCT lower(coalesce(case_description, '')) FROM cases"


@R.query("q_species_all_rules", f"""WITH {species_sql(TEXTS_SQL)}, f AS (SELECT DISTINCT 'title' AS field, lower(coalesce(title, '')) AS t FROM cases UNION SELECT DISTINCT 'case_description', lower(coalesce(case_description, '')) FROM cases)
    SELECT field || ':' || rule AS rule, count(*) AS texts FROM f JOIN hits USING (t) GROUP BY 1""")
def q_species_all_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many distinct titles and descriptions each rule of the whole rule set hits."""
    cases = table(spark, sf_dir, "cases")
    hits = []
    for c in ("title", "case_description"):
        t = cases.select(F.lower(F.coalesce(c, F.lit(""))).alias("t")).distinct()
        hits.append(t.select(F.explode(species.field_rules(F.col("t"), c)).alias("rule")))
    return hits[0].unionByName(hits[1]).groupBy("rule").agg(F.count(F.lit(1)).alias("texts"))


def _has(pattern: str) -> str:
    return f"len(list_filter(r, lambda z: regexp_matches(z, '{pattern}'))) > 0"


@R.query("q_species", f"""WITH live AS {latest_sql('cases', 'patient_uid', 'patient_uid, title, case_description')}, {species_sql(TEXTS_SQL)}, f AS (SELECT patient_uid, 'title' AS field, lower(coalesce(title, '')) AS t FROM live UNION ALL SELECT patient_uid, 'abstract', lower(coalesce(case_description, '')) FROM live),
    g AS (SELECT patient_uid, list_sort(list(field || ':' || rule)) AS r FROM f JOIN hits USING (t) GROUP BY 1), a AS (SELECT patient_uid, coalesce(r, []) AS r FROM live LEFT JOIN g USING (patient_uid))
    SELECT patient_uid, r AS matched_rules, CASE WHEN {_has('^title:model:')} THEN 'animal' WHEN {_has(':direct_nonhuman_subject$')} THEN 'animal' WHEN {_has(':exposure:|:zoonosis|:human_patient_context')} THEN 'human'
      WHEN {_has(':model:')} OR {_has(':explicit_nonhuman_subject$')} OR ({_has(':veterinary_context$')} AND {_has(':species:')}) THEN 'animal' ELSE 'human' END AS automatic_label FROM a""")  # fmt: skip
def q_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human or animal, per live case, with the rules that decided."""
    cases = latest(spark, sf_dir, "cases", "patient_uid").select("patient_uid", "title", "case_description")
    return species.classify_species(cases, "title", "case_description").select("patient_uid", "automatic_label", "matched_rules")


# Beginnings that make a title hit the rules the tables alone do not.
BEGINNINGS = [
    "A dog presented with", "Two cats were treated: ", "Impacted canine tooth and", "A mouse model of", "Exposure to dogs before", "Surgery in a horse with", "Cat scan of a woman with", "Veterinary patient, feline, ", "Dog bite, then",
    "Fluorescence in situ hybridization with mouse serum in", "Zoonotic spread of", "Feline-associated", "Experimental rats and", "Rabbits were injected before", "Dog ears in", "Acquired from birds: ", "The patient, a parrot, had", "Fish-probe study of", "Labrador with", "Non-human primates and",
]


@R.query("q_species_titles", f"""WITH {species_sql(f"SELECT DISTINCT lower({BEGINNINGS!r}[length(title) % {len(BEGINNINGS)} + 1] || ' ' || title) AS t FROM cases WHERE title IS NOT NULL")}
    SELECT t AS title, coalesce(list_sort(list('title:' || rule) FILTER (rule IS NOT NULL)), []) AS matched_rules FROM x LEFT JOIN hits USING (t) GROUP BY t""")  # fmt: skip
def q_species_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules that hit each title behind a beginning that depends on its length: every rule but few hits many titles."""
    begin = F.element_at(F.array(*[F.lit(b) for b in BEGINNINGS]), F.length("title") % len(BEGINNINGS) + 1)
    t = table(spark, sf_dir, "cases").where("title IS NOT NULL").select(F.lower(F.concat(begin, F.lit(" "), "title")).alias("title")).distinct()
    return t.select("title", species.field_rules(F.col("title"), "title").alias("matched_rules"))


@R.query("q_pair_species", f"""WITH k AS {latest_sql('cases', 'patient_uid', 'patient_uid, population_scope.label AS l')}
    SELECT DISTINCT p.pair_index, CASE WHEN a.l = 'human' AND b.l = 'human' THEN 'human' ELSE 'animal' END AS label FROM pairs p JOIN k a ON a.patient_uid = case_a_uid JOIN k b ON b.patient_uid = case_b_uid""")
def q_pair_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = latest(spark, sf_dir, "cases", "patient_uid").select("patient_uid", F.col("population_scope.label").alias("final_label"))
    return species.pair_species(table(spark, sf_dir, "pairs").select("pair_index", "case_a_uid", "case_b_uid").distinct(), k).select("pair_index", "label").distinct()


XML = r"(SELECT patient_uid, title, case_description AS d FROM {live})"


@R.query("q_jats_cases", f"""SELECT patient_uid, 'ok' AS status, trim(regexp_replace(coalesce(title, ''), '\\s+', ' ', 'g')) AS title, trim(regexp_replace(coalesce(d, ''), '\\s+', ' ', 'g')) AS case_text, 'PMC' || pmc_id AS pmcid
    FROM {latest_sql('cases', 'patient_uid', 'patient_uid, pmc_id, title, case_description AS d')}""")
def q_jats_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every live case written as a JATS article and parsed again: title, id and case section come back as they were."""
    esc = lambda c: F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    xml = F.concat(
        F.lit('<!DOCTYPE article><article><front><article-meta><article-id pub-id-type="pmc">PMC'), F.col("pmc_id"), F.lit("</article-id><title-group><article-title>"), esc("title"),
        F.lit("</article-title></title-group></article-meta></front><body><sec><title>Case presentation</title><p>"), esc("case_description"), F.lit("</p></sec></body></article>"),
    )
    files = latest(spark, sf_dir, "cases", "patient_uid").select("patient_uid", xml.alias("content"))
    return jats.read_articles(files, "patient_uid", "content").select("patient_uid", "status", "title", "case_text", "pmcid")


LEVEL_SQL = r"(?im)^[ \t]*level[ \t]+([123])(?:\b[^\r\n]*)?$"


@R.query("q_level_problems", rf"""WITH d AS (SELECT doc_id, doc_kind, array_to_string(regexp_extract_all(text, '{LEVEL_SQL}', 1), ',') AS levels, string_split_regex(text, '{LEVEL_SQL}') AS p, text FROM documents WHERE doc_kind IN ('question', 'answer') AND text IS NOT NULL),
    x AS (SELECT doc_id, CASE WHEN levels <> '1,2,3' THEN 'levels' WHEN regexp_replace(p[1], '\s', '', 'g') <> '' THEN 'text_before' WHEN len(list_filter(p[2:], lambda z: regexp_replace(z, '\s', '', 'g') = '')) > 0 THEN 'empty_level'
      WHEN doc_kind = 'question' AND len(list_filter(p[2:], lambda z: NOT contains(z, '?'))) > 0 THEN 'no_question' END AS problem FROM d) SELECT doc_id, problem FROM x WHERE problem IS NOT NULL""")  # fmt: skip
def q_level_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in levels that break their schema; questions must ask at each level."""
    d = table(spark, sf_dir, "documents").where("doc_kind IN ('question', 'answer') AND text IS NOT NULL")
    problem = F.when(F.col("doc_kind") == "question", batches.level_problem(F.col("text"), questions=True)).otherwise(batches.level_problem(F.col("text"), questions=False))
    return d.select("doc_id", problem.alias("problem")).where("problem IS NOT NULL")


@R.query("q_request_shards", r"""WITH RECURSIVE p AS (SELECT pair_index, min((case_a_uid, case_b_uid)) AS e FROM (SELECT * FROM pairs WHERE pair_index IS NOT NULL) GROUP BY 1),
      b AS (SELECT pair_index, row_number() OVER (ORDER BY pair_index) - 1 AS ordinal, '{"messages":[{"content":"' || concat_ws(' / ', e[1], e[2]) || '","role":"user"}],"model":"m"}' AS body FROM p),
      c AS (SELECT *, ',"method":"POST","url":"/v1/chat/completions"}' AS tail FROM b), i AS (SELECT *, 'citation-' || lpad(CAST(ordinal AS VARCHAR), 8, '0') || '-' || substr(sha256('{"body":' || body || tail), 1, 16) AS custom_id FROM c),
      l AS (SELECT ordinal, pair_index, custom_id, CAST(strlen('{"body":' || body || ',"custom_id":"' || custom_id || '"' || tail) + 1 AS BIGINT) AS line_bytes FROM i),
      s AS (SELECT *, sum(line_bytes) OVER (ORDER BY ordinal) AS upto, sum(line_bytes) OVER (ORDER BY ordinal) - line_bytes + 200000 AS most FROM l),
      n AS (SELECT a.ordinal, least(coalesce(z.ordinal, (SELECT count(*) FROM l)), a.ordinal + 500) AS next FROM s a ASOF LEFT JOIN s z ON a.most < z.upto),
      f(shard, start, next) AS (SELECT 0, ordinal, next FROM n WHERE ordinal = 0 UNION ALL SELECT f.shard + 1, n.ordinal, n.next FROM f JOIN n ON n.ordinal = f.next)
    SELECT l.ordinal, pair_index, custom_id, line_bytes, CAST(shard AS INT) AS shard, CAST(l.ordinal - start + 1 AS INT) AS line_number FROM l JOIN f ON l.ordinal >= f.start AND l.ordinal < f.next""")
def q_request_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for all live pairs in shards of bounded bytes."""
    pairs = table(spark, sf_dir, "pairs").where("pair_index IS NOT NULL").groupBy("pair_index").agg(F.min(F.struct("case_a_uid", "case_b_uid")).alias("p"))
    body = F.to_json(F.struct(F.array(F.struct(F.concat_ws(" / ", "p.case_a_uid", "p.case_b_uid").alias("content"), F.lit("user").alias("role"))).alias("messages"), F.lit("m").alias("model")))
    lines = batches.request_lines(pairs.select("pair_index", body.alias("body")), "citation", ["pair_index"])
    shards = batches.assign_shards(lines, most_bytes=200_000, most_requests=500)
    return lines.select("ordinal", "pair_index", "custom_id", "line_bytes").join(shards, "ordinal")


@R.query("q_monthly_captions", "SELECT strftime(recorded_at, '%Y-%m') AS period, count(DISTINCT caption_id) AS captions, count(*) FILTER (trim(caption) = '' OR caption IS NULL) AS empty FROM captions GROUP BY 1")
def q_monthly_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = F.col("caption").isNull() | (F.trim("caption") == "")
    return table(spark, sf_dir, "captions").groupBy(F.date_format("recorded_at", "yyyy-MM").alias("period")).agg(F.countDistinct("caption_id").alias("captions"), F.sum(empty.cast("int")).alias("empty"))


@R.query("q_figure_numbers", r"""SELECT patient_uid, image_path, row_number() OVER (PARTITION BY patient_uid ORDER BY CAST(coalesce(nullif(regexp_extract(image_path, '_(\d+)\.[a-z]+$', 1), ''), '0') AS BIGINT), image_path) AS position
    FROM (SELECT DISTINCT patient_uid, image_path FROM images)""")  # fmt: skip
def q_figure_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of each figure within its case, in numeric order of the figure."""
    w = Window.partitionBy("patient_uid").orderBy(figure_number(F.col("image_path")), "image_path")
    return table(spark, sf_dir, "images").select("patient_uid", "image_path").distinct().withColumn("position", F.row_number().over(w))


@R.query("q_article_sizes", f"""SELECT regexp_extract(i.pmc_id, '(\\d+)', 1) AS article, count(*) AS images, count(DISTINCT i.patient_uid) AS cases FROM {latest_sql('images', 'image_path')} i GROUP BY 1""")
def q_article_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = latest(spark, sf_dir, "images", "image_path")
    return i.groupBy(article_id(F.col("pmc_id")).alias("article")).agg(F.count(F.lit(1)).alias("images"), F.countDistinct("patient_uid").alias("cases"))


STREAM_SQL = r"SELECT uid, max_by(csv_row, csv_row) AS csv_row, max_by(code, csv_row) AS code FROM (SELECT *, regexp_extract(patient_uid, '(\d+)[-_](\d+)', 1) || '-' || regexp_extract(patient_uid, '(\d+)[-_](\d+)', 2) AS uid FROM patients) GROUP BY uid"


@R.query("q_stream_latest", STREAM_SQL)
def q_stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row per patient, through Structured Streaming: file source, foreachBatch merge, checkpoint."""
    from casegrain.session import temporary_root
    from casegrain.streaming import ingest

    path, place = f"{sf_dir}/patients.parquet", temporary_root(spark, "stream")
    stream = ingest.patient_stream(spark, f"{path}*", spark.read.parquet(path).schema).select("uid", "csv_row", "code")
    ingest.merge_latest(stream, f"{place}/target", "uid", "csv_row", f"{place}/checkpoint").awaitTermination()
    return ingest.latest(spark, f"{place}/target").select("uid", "csv_row", "code")
