"""Records put together for the next stage, and the checks that bind a stage to what it was made from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrain.operators import batches
from casegrain.operators.constraints import IntegrityError, ResponseError, StageOrderError, gaps
from casegrain.operators.joins import heavy_join
from casegrain.sources.artifacts import verify_manifest


def ordered_reason(df: DataFrame, rules: dict[str, Column], otherwise: str = "eligible", column: str = "reason") -> DataFrame:
    """``df`` with the name of the first rule that holds, in the order given; a rule that is null does not hold."""
    why = F.when(F.lit(False), "")
    for name, holds in rules.items():
        why = why.when(F.coalesce(holds, F.lit(False)), name)
    return df.withColumn(column, why.otherwise(otherwise))


def selected_subset(df: DataFrame, selection: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the selection, problems): ``problems`` (key, problem) names keys that are missing or on several rows.

    A null key is in no selection; a key selected twice counts once.
    """
    wanted = selection.select(key).where(F.col(key).isNotNull()).distinct()
    kept = df.join(wanted, key, "left_semi")
    n = kept.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    j = wanted.join(n, key, "left").withColumn("problem", F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate"))
    return kept, j.where(F.col("problem").isNotNull()).select(key, "problem")


CITATION = ["status", "direction", "citing_uid", "cited_uid", "match_type", "ref_id"]


def assemble_cases(cases: DataFrame, summaries: DataFrame, classifications: DataFrame, key: str = "patient_uid") -> DataFrame:
    """Cases with ``case_description`` and ``population_scope`` nested, inner on ``key``; each side has at most one row per key."""
    s = summaries.select(key, "case_description")
    c = classifications.select(key, F.struct("ruleset", "label").alias("population_scope"))
    others = [x for x in cases.columns if x not in ("case_description", "population_scope")]
    return cases.select(*others).join(s, key).join(c, key)


def assemble_pairs(pairs: DataFrame, citations: DataFrame, cases: DataFrame, key: str = "patient_uid") -> DataFrame:
    """(pair_index, case_a_uid, case_b_uid, citation): pairs with their citation record, both ends among ``cases``.

    All sides hold a pair or case once. A pair without a citation record or with an end that was not handed on is left out.
    """
    p = pairs.select("pair_index", "case_a_uid", "case_b_uid").join(citations.select("pair_index", F.struct(*CITATION).alias("citation")), "pair_index")
    for end in ("case_a_uid", "case_b_uid"):
        p = heavy_join(p, cases.select(F.col(key).alias(end)).distinct(), [end])
    return p.select("pair_index", "case_a_uid", "case_b_uid", "citation")


NO_CITATION = "(no citation between the two)"


def assemble_prompts(pairs: DataFrame, cases: DataFrame, captions: DataFrame, prior: DataFrame | None = None, none: str = NO_CITATION) -> DataFrame:
    """(pair_index, content): for each pair both cases with description and captions, the cited paragraphs and the prior answer.

    ``pairs``: pair_index, case_a_uid, case_b_uid, paragraphs (array); ``cases``: patient_uid, case_description; ``captions``:
    patient_uid, caption_id, caption; ``prior``: pair_index, text. Captions come in order of their id; absent texts are empty,
    absent paragraphs the placeholder; a pair with an end that has no case or, if given, no prior answer is left out.
    """
    c = captions.where(F.col("patient_uid").isNotNull()).select("patient_uid", F.struct("caption_id", F.coalesce("caption", F.lit("")).alias("caption")).alias("c")).distinct()
    c = c.groupBy("patient_uid").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    shown = F.array_join(F.transform(F.coalesce("cs", F.array().cast("array<struct<caption_id:string,caption:string>>")), lambda x: F.concat(F.coalesce(x["caption_id"], F.lit("")), F.lit(": "), x["caption"])), "\n")
    known = cases.select("patient_uid", F.coalesce("case_description", F.lit("")).alias("d")).join(c, "patient_uid", "left").select("patient_uid", F.concat("d", F.lit("\n"), shown).alias("told"))
    p = pairs
    for side in "ab":
        p = heavy_join(p, known.select(F.col("patient_uid").alias(f"case_{side}_uid"), F.col("told").alias(f"told_{side}")), [f"case_{side}_uid"])
    cited = F.when(F.coalesce(F.size("paragraphs"), F.lit(0)) > 0, F.array_join("paragraphs", "\n")).otherwise(none)
    parts = [F.lit("CASE A\n"), F.col("told_a"), F.lit("\nCASE B\n"), F.col("told_b"), F.lit("\nCITATION\n"), cited]
    if prior is not None:
        p = p.join(prior.select("pair_index", F.col("text").alias("said")), "pair_index")
        parts += [F.lit("\nANSWER\n"), F.col("said")]
    return p.select("pair_index", F.concat(*parts).alias("content"))


def build_stage(prompts: DataFrame, stage: str, model: str, developer: str, prior_index: DataFrame | None = None, **limits: int) -> tuple[DataFrame, DataFrame]:
    """(lines, shards) of the requests of a stage; with ``prior_index`` (ordinal) the stage before must be whole."""
    if prior_index is not None and (bad := gaps(prior_index, "ordinal").take(1)):
        raise StageOrderError(f"the stage before {stage} is not contiguous: {bad[0].asDict()}")
    body = batches.request_body(model, F.lit(developer), F.col("content"))
    lines = batches.request_lines(prompts.select("pair_index", body.alias("body")), stage, ["pair_index"])
    return lines, batches.assign_shards(lines, **limits)


def ingest_stage(index: DataFrame, responses: DataFrame, check: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(answers, problems): responses reconciled with the index and, by ``check``, with the schema of their answer."""
    answers, problems = batches.reconcile(index, responses)
    if check is None:
        return answers, problems
    judged = answers.withColumn("problem", check(F.col("text")))
    return judged.where("problem IS NULL").drop("problem"), problems.unionByName(judged.where("problem IS NOT NULL").select("custom_id", "problem"))


def accept(problems: DataFrame, stage: str) -> None:
    """Raise if a stage's responses are not all usable."""
    rows = problems.orderBy("custom_id", "problem").limit(20).collect()
    if rows:
        raise ResponseError(f"{stage}: " + "; ".join(f"{r['custom_id']} {r['problem']}" for r in rows))


def request_problems(stored: DataFrame, index: DataFrame, stage: str) -> DataFrame:
    """(custom_id, problem) where stored request lines and their index disagree.

    ``stored``: line (as read from the shards); ``index``: ordinal, custom_id, line_sha256. missing_line, unindexed_line,
    repeated_line, changed_line (hash), wrong_id (not made from stage, ordinal and body).
    """
    cid = F.get_json_object("line", "$.custom_id")
    s = stored.select(cid.alias("custom_id"), F.sha2(F.concat("line", F.lit("\n")), 256).alias("said"), F.regexp_replace("line", r'"custom_id":"[^"]*",', "").alias("core"))
    s = s.groupBy("custom_id").agg(F.count(F.lit(1)).alias("lines"), F.min("said").alias("said"), F.min("core").alias("core"))
    j = s.join(index.select("custom_id", "ordinal", "line_sha256", F.lit(True).alias("there")), "custom_id", "full_outer")
    right = F.format_string("%s-%08d-%s", F.lit(stage), F.col("ordinal"), F.substring(F.sha2("core", 256), 1, 16))
    rules = {
        "missing_line": F.col("lines").isNull(), "unindexed_line": F.col("there").isNull(), "repeated_line": F.col("lines") > 1,
        "changed_line": F.col("there") & (F.col("said") != F.col("line_sha256")), "wrong_id": F.col("there") & F.col("lines").isNotNull() & (F.col("custom_id") != right),
    }
    named = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return j.select("custom_id", F.explode(named).alias("problem"))


def array_problems(arrays: DataFrame, pairs: DataFrame) -> DataFrame:
    """(modality_bucket, problem, n) where stored bucket arrays and the final pairs disagree.

    ``arrays``: modality_bucket and the aligned pair_ids, captions, source_pair_indices. unaligned: arrays of different length;
    unknown_entry, missing_entry: entries that only one side has; repeated_entry: a pair of ids listed twice.
    """
    size = [F.coalesce(F.size(c), F.lit(-1)) for c in ("pair_ids", "captions", "source_pair_indices")]
    unaligned = arrays.where((size[0] != size[1]) | (size[0] != size[2])).groupBy("modality_bucket").agg(F.lit("unaligned").alias("problem"), F.count(F.lit(1)).alias("n"))
    e = arrays.select("modality_bucket", F.explode(F.arrays_zip("pair_ids", "captions", "source_pair_indices")).alias("e"))
    e = e.select("modality_bucket", F.col("e.pair_ids").alias("pair_id"), F.col("e.captions").alias("caption"), F.col("e.source_pair_indices").alias("source_pair_index"))
    own = ["modality_bucket", "pair_id", "caption", "source_pair_index"]
    side = e.select(*own, F.lit(1).alias("s"), F.lit(0).alias("p")).unionByName(pairs.select(*own, F.lit(0).alias("s"), F.lit(1).alias("p")))
    both = side.groupBy(*own).agg(F.sum("s").alias("s"), F.sum("p").alias("p"))
    odd = both.withColumn("problem", F.when((F.col("s") > 0) & (F.col("p") == 0), "unknown_entry").when((F.col("s") == 0) & (F.col("p") > 0), "missing_entry")).where("problem IS NOT NULL")
    again = e.groupBy("modality_bucket", "pair_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").withColumn("problem", F.lit("repeated_entry"))
    found = odd.select("modality_bucket", "problem").unionByName(again.select("modality_bucket", "problem")).groupBy("modality_bucket", "problem").agg(F.count(F.lit(1)).alias("n"))
    return unaligned.unionByName(found)


def order_problems(a: DataFrame, b: DataFrame, key: str, order_a: list[str], order_b: list[str]) -> DataFrame:
    """(key, problem) unless both sides hold the same keys, once each, in the same order: only_left, only_right, repeated, moved."""
    x, y = (batches.total_index(df.select(*dict.fromkeys([key, *order])), order, "at").select(key, "at") for df, order in ((a, order_a), (b, order_b)))
    x, y = (df.groupBy(key).agg(F.min("at").alias(f"at_{n}"), F.count(F.lit(1)).alias(f"n_{n}")) for df, n in ((x, "a"), (y, "b")))
    why = F.when(F.col("n_b").isNull(), "only_left").when(F.col("n_a").isNull(), "only_right").when((F.col("n_a") > 1) | (F.col("n_b") > 1), "repeated").when(F.col("at_a") != F.col("at_b"), "moved")
    return x.join(y, key, "full_outer").select(key, why.alias("problem")).where("problem IS NOT NULL")


def repair_audit(before: DataFrame, after: DataFrame, key: str, field: str, unrecovered: str = "no_reliable_intext_marker_found") -> DataFrame:
    """(outcome, records): what a repair of ``field`` did; both sides hold a key once.

    kept: it was filled and is the same; filled; the reason ``unrecovered``: still empty. Broken invariants: overwritten (a
    filled field changed), emptied, other_field (another column changed), lost, added.
    """
    others = [c for c in before.columns if c not in (key, field)]
    x = before.select(key, F.col(field).alias("__old"), F.struct(*others).alias("__rest"), F.lit(True).alias("__was"))
    y = after.select(key, F.col(field).alias("__new"), F.struct(*others).alias("__now"), F.lit(True).alias("__is"))
    empty = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    why = (
        F.when(F.col("__is").isNull(), "lost").when(F.col("__was").isNull(), "added").when(~F.col("__rest").eqNullSafe(F.col("__now")), "other_field")
        .when(empty("__old") & empty("__new"), unrecovered).when(empty("__old"), "filled").when(empty("__new"), "emptied").when(F.col("__old").eqNullSafe(F.col("__new")), "kept").otherwise("overwritten")
    )
    return x.join(y, key, "full_outer").groupBy(why.alias("outcome")).agg(F.count(F.lit(1)).alias("records"))


BROKEN = ("overwritten", "emptied", "other_field", "lost", "added")


def compatibility_view(citations: DataFrame) -> DataFrame:
    """Citation records under the field names of the older format: files are article names, paragraphs one text."""
    article = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit("PMC"), F.split_part(c, F.lit("-"), F.lit(1)), F.lit(".nxml")))
    return citations.select(
        "pair_index", article("citing_uid").alias("citing_file"), article("cited_uid").alias("cited_file"), F.replace("citing_uid", F.lit("-"), F.lit("_")).alias("citing_case"), F.replace("cited_uid", F.lit("-"), F.lit("_")).alias("cited_case"),
        "match_type", F.col("ref_id").alias("match_ref_id"), F.coalesce(F.array_join("citation_paragraphs", "\n\n"), F.lit("")).alias("extracted_citation"),
    )


def verify_run(spark: SparkSession, root: str, manifest: dict, checks: dict[str, DataFrame]) -> None:
    """A finished run as a whole: every file as the manifest has it, and every violation table empty."""
    verify_manifest(spark, root, manifest)
    bad = {name: [r.asDict() for r in rows] for name, df in checks.items() if (rows := df.limit(5).collect())}
    if bad:
        raise IntegrityError("; ".join(f"{n}: {rows}" for n, rows in bad.items()))
