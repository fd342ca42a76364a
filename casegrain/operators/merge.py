"""Figures with their patients, coverage of both sides, and problem lists per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casegrain.functions.keys import article_id, case_uid, figure_number, safe_path_problem
from casegrain.operators.batches import total_index


def latest_versions(df: DataFrame, keys: list[str], recorded: str = "recorded_at", withdrawn: str | None = "withdrawn_at") -> DataFrame:
    """The row that arrived last per key; keys whose last row is withdrawn drop out. Rows equal in time: the withdrawn one wins."""
    state = F.struct(F.col(recorded), F.col(withdrawn).isNotNull().alias("gone")) if withdrawn else F.struct(F.col(recorded))
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), state).alias("__row")).select(*keys, "__row.*").select(*df.columns)
    return out.where(F.col(withdrawn).isNull()) if withdrawn else out


def merge_figures(figures: DataFrame, patients: DataFrame) -> DataFrame:
    """Inner join on the normalised uid, many figures to one patient; ``patients`` must be unique by ``uid``."""
    f = figures.withColumn("uid", case_uid(F.col("patient_uid")))
    return f.join(patients, "uid", "inner")


def coverage(figures: DataFrame, patients: DataFrame) -> DataFrame:
    """(uid, missing): patients without a figure and figures' uids without a patient."""
    f = figures.select(case_uid(F.col("patient_uid")).alias("uid")).where(F.col("uid").isNotNull()).distinct()
    p = patients.select("uid").distinct()
    return f.join(p, "uid", "left_anti").withColumn("missing", F.lit("patient")).unionByName(p.join(f, "uid", "left_anti").withColumn("missing", F.lit("figure")))


def figure_order() -> list:
    """Sort key of the figure manifest: article, figure number, path."""
    return [article_id(F.col("pmc_id")).try_cast("decimal(38,0)"), figure_number(F.col("image_path")), F.col("image_path")]


def asset_problems(figures: DataFrame, root: str = "new_data") -> DataFrame:
    """(image_path, problem): paths that do not fit their own article and case."""
    uid = F.translate(F.col("patient_uid"), "-", "_")
    pmc = F.concat(F.lit("PMC"), article_id(F.col("pmc_id")))
    p = F.col("image_path")
    stem = F.regexp_extract(p, r"([^/]*?)(?:\.[^./]*)?$", 1)
    rules = {
        "unsafe_path": safe_path_problem(p),
        "wrong_suffix": ~F.lower(p).endswith(".jpg"),
        "outside_tree": ~p.startswith(f"{root}/"),
        "wrong_folder": ~p.contains(F.concat(F.lit("/"), pmc, F.lit("/"), uid, F.lit("/"))),
        "wrong_stem": ~stem.startswith(F.concat(uid, F.lit("_"))),
        "article_mismatch": article_id(F.col("pmc_id")) != F.split_part(uid, F.lit("_"), F.lit(1)),
    }
    named = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return figures.select("image_path", F.explode(named).alias("problem"))


# File suffixes that count as images.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "gif", "tif", "tiff", "bmp", "webp")


def resolve_members(hrefs: DataFrame, members: DataFrame) -> DataFrame:
    """Each figure reference with the archive member it means.

    ``hrefs``: archive, figure, ordinal, href (clean), folder (of the article file, "" or ending in a slash); ``members``:
    archive, member. Ranks, best first: the path relative to the article; same folder and stem; the path as given; the same
    file name anywhere; the same stem anywhere. Case does not matter. Several members at the best rank make the reference
    ambiguous. Output: archive, figure, ordinal, member (null if none or ambiguous), rank, ties. The join runs on the stem,
    which every rank implies, so no archive's members are multiplied with all its references.
    """
    images = "|".join(IMAGE_SUFFIXES)
    low, given = F.lower("member"), F.lower("href")
    name = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    folder = lambda c: F.regexp_extract(c, r"^(.*/)?", 0)
    m = members.select("archive", "member", low.alias("m_path"), name(low).alias("m_name"), folder(low).alias("m_dir"), F.regexp_replace(name(low), r"(?<=.)\.[^.]*$", "").alias("stem"))
    h = hrefs.select("archive", "figure", "ordinal", given.alias("h_path"), name(given).alias("h_name"), F.lower("folder").alias("h_dir"), F.regexp_replace(name(given), rf"(?<=.)\.(?:{images})$", "").alias("stem"))
    j = h.join(m, ["archive", "stem"])
    rank = (
        F.when(F.col("m_path") == F.concat("h_dir", "h_path"), 0).when(F.col("m_dir") == F.col("h_dir"), 1).when(F.col("m_path") == F.col("h_path"), 2).when(F.col("m_name") == F.col("h_name"), 4).otherwise(5)
    )
    keys = ["archive", "figure", "ordinal"]
    per = j.groupBy(*keys, rank.alias("rank")).agg(F.countDistinct("member").alias("ties"), F.min("member").alias("member"))
    top = per.groupBy(*keys).agg(F.min(F.struct("rank", "ties", "member")).alias("t")).select(*keys, "t.*")
    out = hrefs.select(*keys).distinct().join(top, keys, "left")
    return out.withColumn("member", F.when(F.col("ties") == 1, F.col("member")))


def first_resolved(resolved: DataFrame) -> DataFrame:
    """One row per figure: the first reference, in order, that means one member; figures without one keep a null."""
    w = Window.partitionBy("archive", "figure").orderBy(F.col("member").isNull(), "ordinal")
    return resolved.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def diagram_decision(images: DataFrame, most_white: float = 0.5, most_text: int = 200) -> DataFrame:
    """reason: white_ratio (share of white above the limit), ocr_text_length (else, text longer than the limit), retained; null measures never exceed a limit."""
    white = F.coalesce(F.col("white_ratio") > most_white, F.lit(False))
    wordy = F.coalesce(F.col("ocr_text_length") > most_text, F.lit(False))
    reason = F.when(white, "white_ratio").when(wordy, "ocr_text_length").otherwise("retained")
    return images.withColumn("reason", reason).withColumn("is_diagram", F.col("reason") != "retained")


def case_records(cases: DataFrame, captions: DataFrame) -> DataFrame:
    """Cases with their captions nested, ordered by (caption_id, image_path) as text."""
    c = captions.select("patient_uid", F.struct("caption_id", "image_path", "caption").alias("c")).distinct()
    c = c.groupBy("patient_uid").agg(F.array_sort(F.collect_list("c")).alias("captions"))
    return cases.join(c, "patient_uid", "left").withColumn("captions", F.coalesce("captions", F.array().cast("array<struct<caption_id: string, image_path: string, caption: string>>")))


def manifest_images(figures: DataFrame) -> DataFrame:
    """(image_path, ordinal, rows): the distinct image paths of a manifest in their order, from 0, and how often each is listed."""
    g = figures.where(F.col("image_path").isNotNull()).groupBy("image_path").agg(F.count(F.lit(1)).alias("rows"))
    return total_index(g, ["image_path"], "ordinal").select("image_path", "ordinal", "rows")


def drop_diagrams(figures: DataFrame, decisions: DataFrame) -> DataFrame:
    """The figures that no decision (image_path, is_diagram) calls a diagram; a figure without a decision stays."""
    return figures.join(decisions.where(F.col("is_diagram")).select("image_path"), "image_path", "left_anti")
