"""From raw patient rows to the cohort of single-patient articles and their similarity links."""

from __future__ import annotations

import ast
import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrain.functions.keys import case_uid

LINK = T.ArrayType(T.StructType([T.StructField("dst", T.StringType()), T.StructField("score", T.StringType())]))
LINKS = T.StructType([T.StructField("status", T.StringType()), T.StructField("links", LINK)])
FLAT = r'^\{(?:"(?:PMC)?[0-9]{1,18}[-_][0-9]{1,18}": ?-?(?:0|[1-9][0-9]{0,15})(?:\.[0-9]{0,15}[1-9])?(?:, ?(?="))?)*\}$'
ENTRY = r'"(?:PMC)?0*([0-9]{1,18})[-_]0*([0-9]{1,18})": ?(-?[0-9.]+)'


def python_mapping(text: str | None) -> tuple[str, list[tuple[str, str]]]:
    """Status and (uid, canonical JSON score) of one cell: JSON first, then a Python literal."""
    if text is None or not text.strip():
        return "missing", []
    parsed = None
    for parse in (json.loads, ast.literal_eval):
        try:
            parsed = parse(text.strip())
            break
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            continue
    if parsed is None:
        return "malformed", []
    if not isinstance(parsed, dict):
        return "non_mapping", []
    found, bad = {}, False
    for key, score in parsed.items():
        uid = python_uid(key) if isinstance(key, str) else None
        if uid is None:
            bad = True
        else:
            found[uid] = json.dumps(json_safe(score), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    order = sorted(found, key=lambda u: tuple(map(int, u.split("-"))))
    return ("invalid_keys" if bad else "ok"), [(u, found[u]) for u in order]


def python_uid(text: str) -> str | None:
    body = text.strip()
    body = body[3:] if body[:3].lower() == "pmc" else body
    a, _, b = body.replace("_", "-", 1).partition("-")
    return f"{int(a)}-{int(b)}" if a.isascii() and a.isdigit() and b.isascii() and b.isdigit() else None


def python_uid_list(text: str | None) -> tuple[str, list[str]]:
    """Status and the distinct uids, in numeric order, of a cell that lists uids: JSON first, then a Python list, tuple or set."""
    if text is None or not text.strip() or text.strip().lower() == "nan":
        return "missing", []
    for parse in (json.loads, ast.literal_eval):
        try:
            parsed = parse(text.strip())
            break
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            continue
    else:
        return "malformed", []
    if not isinstance(parsed, list | tuple | set):
        return "not_a_list", []
    uids = {python_uid(x) if isinstance(x, str) else None for x in parsed}
    if None in uids:
        return "invalid_uids", []
    return "ok", sorted(uids, key=lambda u: tuple(map(int, u.split("-"))))


@F.pandas_udf(T.StructType([T.StructField("status", T.StringType()), T.StructField("uids", T.ArrayType(T.StringType()))]))
def uid_list(s: pd.Series) -> pd.DataFrame:
    """struct(status, uids) of a cell that lists uids; anything but a list gives no uids and says why."""
    rows = [python_uid_list(x if isinstance(x, str) else None) for x in s]
    return pd.DataFrame({"status": [r[0] for r in rows], "uids": [r[1] for r in rows]})


def json_safe(v):
    """A JSON value: numbers that are not finite become null, tuples lists, other objects text."""
    if isinstance(v, float):
        return v if math.isfinite(v) else None
    if v is None or isinstance(v, (str, int, bool)):
        return v
    if isinstance(v, dict):
        return {str(k): json_safe(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [json_safe(x) for x in v]
    return str(v)


@F.pandas_udf(LINKS)
def _any_mapping(s: pd.Series) -> pd.DataFrame:
    rows = [python_mapping(x if isinstance(x, str) else None) for x in s]
    return pd.DataFrame({"status": [r[0] for r in rows], "links": [[{"dst": d, "score": x} for d, x in r[1]] for r in rows]})


def parse_links(c: Column) -> Column:
    """struct(status, links) of a similarity cell. Flat JSON objects, nearly all cells, are parsed in the JVM."""
    t = F.trim(c)
    flat = F.coalesce(t.rlike(FLAT), F.lit(False))
    parts = F.arrays_zip(F.regexp_extract_all(t, F.lit(ENTRY), 1).alias("a"), F.regexp_extract_all(t, F.lit(ENTRY), 2).alias("b"), F.regexp_extract_all(t, F.lit(ENTRY), 3).alias("s"))
    links = F.transform(parts, lambda x: F.struct(F.concat(x["a"], F.lit("-"), x["b"]).alias("dst"), F.regexp_replace(x["s"], r"^-0$", "0").alias("score")))
    quick = F.struct(F.lit("ok").alias("status"), links.alias("links"))
    none = F.struct(F.lit("missing").alias("status"), F.array().cast(LINK).alias("links"))
    blank = c.isNull() | (t == "")
    return F.when(blank, none).when(flat, quick).otherwise(_any_mapping(F.when(~flat & ~blank, c)))


def normal_patients(raw: DataFrame) -> DataFrame:
    """``raw`` with uid (null if invalid) and parsed links; row multiplicity is kept."""
    return raw.withColumn("uid", case_uid(F.col("patient_uid"))).withColumn("parsed", parse_links(F.col("similar_patients")))


def unify(raw: DataFrame, metadata: list[str]) -> DataFrame:
    """One row per uid: metadata of the last row, all row numbers, and how often metadata changed between rows.

    Rows are ordered by ``csv_row``, which must be unique; rows with an invalid uid are left out (see ``invalid_uids``).
    """
    p = raw.select(case_uid(F.col("patient_uid")).alias("uid"), "csv_row", *metadata).where(F.col("uid").isNotNull())
    w = Window.partitionBy("uid").orderBy("csv_row")
    first = F.row_number().over(w) == 1
    changed = [(~first & ~F.lag(c).over(w).eqNullSafe(F.col(c))).cast("int").alias(f"{c}_changed") for c in metadata]
    p = p.select("*", *changed)
    return p.groupBy("uid").agg(
        *[F.max_by(c, "csv_row").alias(c) for c in metadata],
        F.sort_array(F.collect_list("csv_row")).alias("csv_rows"),
        *[F.sum(f"{c}_changed").alias(f"{c}_conflicts") for c in metadata],
    )


def invalid_uids(raw: DataFrame) -> DataFrame:
    return raw.where(case_uid(F.col("patient_uid")).isNull())


def link_rows(raw: DataFrame) -> DataFrame:
    """(src, dst, score, csv_row): every parsed link of every row."""
    p = normal_patients(raw.select("patient_uid", "similar_patients", "csv_row")).where(F.col("uid").isNotNull())
    return p.select(F.col("uid").alias("src"), "csv_row", F.explode("parsed.links").alias("l")).select("src", "l.dst", "l.score", "csv_row")


def merged_links(raw: DataFrame) -> DataFrame:
    """Union of all rows' links per (src, dst): the latest row's score, how many rows name it, how often the score changed."""
    rows = link_rows(raw).groupBy("src", "dst", "csv_row").agg(F.max("score").alias("score"))
    w = Window.partitionBy("src", "dst").orderBy("csv_row")
    before = F.lag("score").over(w)
    rows = rows.withColumn("conflict", (before.isNotNull() & (before != F.col("score"))).cast("int"))
    return rows.groupBy("src", "dst").agg(F.max_by("score", "csv_row").alias("score"), F.count(F.lit(1)).alias("rows"), F.sum("conflict").alias("score_conflicts"))


def parse_status_counts(raw: DataFrame) -> DataFrame:
    """How many rows of each parse status, with the links they give."""
    p = normal_patients(raw.select("patient_uid", "similar_patients"))
    return p.groupBy(F.col("parsed.status").alias("status")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("parsed.links")).alias("links"))


def single_patient_uids(uids: DataFrame) -> DataFrame:
    """The uids of articles that have one patient in the whole table."""
    one = uids.select("uid").distinct().groupBy(F.split_part("uid", F.lit("-"), F.lit(1)).alias("article")).agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("uid"))
    return one.where("n = 1").select("uid")


def cohort_links(raw: DataFrame) -> DataFrame:
    """Links between different single-patient articles: the rows of ``merged_links`` with both ends in the cohort."""
    uids = raw.select(case_uid(F.col("patient_uid")).alias("uid")).where(F.col("uid").isNotNull())
    single = single_patient_uids(uids)
    links = merged_links(raw).where(F.col("src") != F.col("dst"))
    links = links.join(single.select(F.col("uid").alias("src")), "src", "left_semi")
    return links.join(single.select(F.col("uid").alias("dst")), "dst", "left_semi").select("src", "dst", "score", "rows", "score_conflicts")


def cohort_members(links: DataFrame) -> DataFrame:
    """Sources and referenced targets, with the size of each one's mapping."""
    src = links.groupBy(F.col("src").alias("uid")).agg(F.count(F.lit(1)).alias("targets"))
    dst = links.select(F.col("dst").alias("uid"), F.lit(0).cast("bigint").alias("targets"))
    return src.unionByName(dst).groupBy("uid").agg(F.max("targets").alias("targets"))
