"""Labelled image pairs: canonical orientation, first-wins deduplication, buckets and label statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casegrain.functions.text import modality_bucket, short_caption
from casegrain.operators.batches import total_index
from casegrain.operators.constraints import union_all

FIELDS = ["modality", "anatomy", "diagnosis"]


def valid_pairs(records: DataFrame) -> DataFrame:
    """Distinct rows with two different, non-null ids and three non-blank labels; ids sorted, labels trimmed."""
    ids = F.col("pair_id")
    ok = (F.size(ids) == 2) & F.get(ids, F.lit(0)).isNotNull() & F.get(ids, F.lit(1)).isNotNull() & (F.get(ids, F.lit(0)) != F.get(ids, F.lit(1)))
    for f in FIELDS:
        ok = ok & (F.trim(f) != "")
    out = records.where(F.coalesce(ok, F.lit(False))).select(F.sort_array("pair_id").alias("pair_id"), *[F.trim(f).alias(f) for f in FIELDS], "source_pair_index")
    return out.distinct()


def first_per_pair(pairs: DataFrame) -> DataFrame:
    """One row per image pair: the least by (source pair, modality, anatomy, diagnosis); nulls of the source pair come last."""
    w = Window.partitionBy("pair_id").orderBy(F.col("source_pair_index").asc_nulls_last(), *FIELDS)
    return pairs.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def positive_pairs(records: DataFrame) -> DataFrame:
    """The final pairs with bucket and caption."""
    p = first_per_pair(valid_pairs(records))
    return p.withColumn("modality_bucket", modality_bucket(F.col("modality"))).withColumn("caption", short_caption(F.col("diagnosis"), F.col("anatomy"), F.col("modality")))


def bucket_sizes(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("modality_bucket").agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("source_pair_index").alias("case_pairs"))


def bucket_arrays(pairs: DataFrame) -> DataFrame:
    """Three aligned arrays per bucket, in pair order. One row holds a whole bucket: for export of bounded sets only."""
    g = pairs.groupBy("modality_bucket").agg(F.array_sort(F.collect_list(F.struct("pair_id", "caption", "source_pair_index"))).alias("r"))
    return g.select("modality_bucket", F.col("r.pair_id").alias("pair_ids"), F.col("r.caption").alias("captions"), F.col("r.source_pair_index").alias("source_pair_indices"))


def orient_pairs(records: DataFrame, members: DataFrame) -> DataFrame:
    """Adds ``problem``: null if one image belongs to each case of the source pair.

    ``members``: source_pair_index, case_a_images, case_b_images (arrays). overlap: an image belongs to both cases.
    """
    a, b = F.get("pair_id", F.lit(0)), F.get("pair_id", F.lit(1))
    has = F.array_contains
    j = records.join(members, "source_pair_index", "left")
    both = F.size(F.array_intersect("case_a_images", "case_b_images")) > 0
    good = (has("case_a_images", a) & has("case_b_images", b)) | (has("case_a_images", b) & has("case_b_images", a))
    problem = F.when(F.col("case_a_images").isNull(), "unknown_pair").when(both, "overlap").when(~F.coalesce(good, F.lit(False)), "not_inter_case")
    return j.withColumn("problem", problem).drop("case_a_images", "case_b_images")


def image_labels(pairs: DataFrame, mapped: DataFrame | None = None) -> DataFrame:
    """Per image and field: the union of its pairs' labels, "other" only where it is alone, and the pairs it is in.

    ``pairs``: pair_index, pair_id and per field an array of labels. An image paired with itself counts once.
    """
    e = pairs.select(F.explode(F.array_distinct(F.array_compact("pair_id"))).alias("image_id"), "pair_index", *FIELDS)
    aggs = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(f)))).alias(f) for f in FIELDS]
    out = e.groupBy("image_id").agg(*aggs, F.array_sort(F.collect_set("pair_index")).alias("pair_indices"))
    for f in FIELDS:
        out = out.withColumn(f, F.when(F.size(f) > 1, F.array_remove(f, "other")).otherwise(F.col(f)))
    return out


def label_coverage(images: DataFrame) -> DataFrame:
    """Per field: images, categories seen, images with several labels, share of "other" in percent."""
    e = images.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("labels")) for f in FIELDS])).alias("e")).select("e.*")
    g = e.groupBy("field").agg(
        F.count(F.lit(1)).alias("images"), F.sum((F.size("labels") > 1).cast("int")).alias("multilabel"), F.round(100 * F.sum(F.array_contains("labels", "other").cast("int")) / F.count(F.lit(1)), 6).alias("other_percent")
    )
    c = e.select("field", F.explode("labels").alias("label")).groupBy("field").agg(F.countDistinct("label").alias("categories"))
    return g.join(c, "field")


def label_problems(images: DataFrame, pairs: DataFrame, allowed: dict[str, list[str]]) -> DataFrame:
    """(image_id, problem) of images whose labels or provenance break the contract."""
    rules = {}
    for f in FIELDS:
        rules[f"{f}_empty"] = F.size(f) == 0
        rules[f"{f}_unsorted"] = F.col(f) != F.array_sort(F.array_distinct(f))
        rules[f"{f}_undeclared"] = F.size(F.array_except(f, F.array(*[F.lit(x) for x in allowed[f]]))) > 0
        rules[f"{f}_other_not_alone"] = F.array_contains(f, "other") & (F.size(f) > 1)
    named = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    bad = images.select("image_id", F.explode(named).alias("problem"))
    real = pairs.select(F.explode(F.array_distinct(F.array_compact("pair_id"))).alias("image_id"), "pair_index").distinct()
    said = images.select("image_id", F.explode("pair_indices").alias("pair_index"))
    lost = real.join(said, ["image_id", "pair_index"], "left_anti").withColumn("problem", F.lit("provenance_missing"))
    made = said.join(real, ["image_id", "pair_index"], "left_anti").withColumn("problem", F.lit("provenance_wrong"))
    return bad.unionByName(lost.unionByName(made).select("image_id", "problem").distinct())


def phrase_counts(records: DataFrame) -> DataFrame:
    """(field, phrase, n), trimmed; blanks left out."""
    e = records.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.trim(f).alias("phrase")) for f in FIELDS])).alias("e")).select("e.*")
    return e.where(F.col("phrase") != "").groupBy("field", "phrase").agg(F.count(F.lit(1)).alias("n"))


def frequency_listing(counts: DataFrame) -> DataFrame:
    """(field, position, phrase, n): the phrases of each field from the most frequent down, ties in order of the phrase, from 1."""
    o = total_index(counts.select("field", "phrase", "n"), ["field", F.col("n").desc(), "phrase"], "at")
    first = o.groupBy("field").agg(F.min("at").alias("first"))
    return o.join(F.broadcast(first), "field").select("field", (F.col("at") - F.col("first") + 1).alias("position"), "phrase", "n")


def unmatched_phrases(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """The phrases (field, phrase, n) whose labels are "other" alone or none at all."""
    j = counts.join(labels.select("field", "phrase", "labels"), ["field", "phrase"], "left")
    return j.where(F.coalesce(F.size("labels"), F.lit(0)).isin(-1, 0) | (F.col("labels") == F.array(F.lit("other")))).select("field", "phrase", "n")


def phrase_coverage(counts: DataFrame, unmatched: DataFrame, most_percent: float = 2.0) -> DataFrame:
    """Per field: phrases and descriptions in all and unmatched, the unmatched share in percent, and whether it is below the limit."""
    u = unmatched.select("field", "phrase", F.lit(1).alias("u"))
    g = counts.join(u, ["field", "phrase"], "left").groupBy("field").agg(
        F.count(F.lit(1)).alias("phrases"), F.sum("n").alias("descriptions"), F.coalesce(F.sum("u"), F.lit(0)).alias("unmatched_phrases"), F.coalesce(F.sum(F.when(F.col("u") == 1, F.col("n"))), F.lit(0)).alias("unmatched_descriptions")
    )
    g = g.withColumn("other_percent", F.round(100 * F.col("unmatched_descriptions") / F.col("descriptions"), 6))
    return g.withColumn("within_limit", F.col("other_percent") < most_percent)


def labelling_stats(records: DataFrame) -> DataFrame:
    """(stat, n): records, those of two different images, with all labels, distinct valid ones, final pairs, removed repeats."""
    a, b = F.get("pair_id", F.lit(0)), F.get("pair_id", F.lit(1))
    two = F.coalesce((F.size("pair_id") == 2) & (a != b), F.lit(False))
    named = F.coalesce((F.trim("modality") != "") & (F.trim("anatomy") != "") & (F.trim("diagnosis") != ""), F.lit(False))
    count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0).cast("bigint"))
    first = records.agg(F.count(F.lit(1)).alias("records"), count(two).alias("two_images"), count(named).alias("all_labels"))
    then = valid_pairs(records).agg(F.count(F.lit(1)).alias("valid"), F.countDistinct("pair_id").alias("final"), (F.count(F.lit(1)) - F.countDistinct("pair_id")).alias("repeats_removed"))
    return union_all([d.unpivot([], d.columns, "stat", "n") for d in (first, then)])


def partition_stats(df: DataFrame, column: str, parts: list[str]) -> DataFrame:
    """One row: all rows, the rows of each part, and whether the parts make up the whole."""
    per = [F.count(F.when(F.col(column) == p, F.lit(1))).alias(p) for p in parts]
    total = sum((F.col(p) for p in parts), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("all_rows"), *per).withColumn("whole", total == F.col("all_rows"))
