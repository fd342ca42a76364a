"""Identifier expressions: article ids, case uids, pair keys, DOIs and the like, as Column expressions.

Every function gives null for what it cannot normalise; ``operators.constraints.require_none`` turns such rows into errors where
a step must fail closed. Identifiers stay text of any length; numeric order holds up to 38 digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UID = r"(?i)^\s*(?:PMC)?0*(\d+)[-_]0*(\d+)\s*$"
ARTICLE = r"(?i)^\s*(?:PMC)?0*(\d+)\s*$"


def _digits(c: Column, pattern: str, group: int) -> Column:
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def article_id(c: Column) -> Column:
    """``PMC0123`` or ``123`` -> ``"123"``."""
    return _digits(c, ARTICLE, 1)


def case_uid(c: Column, default_case: int | None = None) -> Column:
    """``PMC12_3``, ``12-3`` -> ``"12-3"``; with ``default_case`` a bare article id gets that case."""
    uid = F.concat(_digits(c, UID, 1), F.lit("-"), _digits(c, UID, 2))
    return uid if default_case is None else F.coalesce(uid, F.concat(article_id(c), F.lit(f"-{default_case}")))


def uid_article(uid: Column) -> Column:
    return F.split_part(uid, F.lit("-"), F.lit(1)).try_cast("decimal(38,0)")


def uid_case(uid: Column) -> Column:
    return F.split_part(uid, F.lit("-"), F.lit(2)).try_cast("decimal(38,0)")


def uid_order(uid: Column) -> Column:
    """Numeric order of uids as one sortable struct."""
    return F.struct(uid_article(uid).alias("article"), uid_case(uid).alias("case"))


def figure_number(path: Column) -> Column:
    """Integer after the last underscore of the file stem, else 0."""
    stem = F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)
    return F.coalesce(F.when(stem.rlike(r"_\d{1,18}$"), F.regexp_extract(stem, r"_(\d{1,18})$", 1).cast("bigint")), F.lit(0).cast("bigint"))


def pair_key(a: Column, b: Column) -> Column:
    """SHA-256 of the two uids with a NUL between; null if either is."""
    return F.sha2(F.concat(a, F.lit("\0"), b), 256)


def ordered_pair(a: Column, b: Column) -> Column:
    """struct(a, b) of two uids in numeric order."""
    swap = uid_order(b) < uid_order(a)
    return F.struct(F.when(swap, b).otherwise(a).alias("a"), F.when(swap, a).otherwise(b).alias("b"))


def normal_doi(c: Column) -> Column:
    d = F.regexp_replace(F.lower(F.trim(c)), r"^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")
    return F.when(F.trim(d) != "", F.trim(d))


def normal_pmid(c: Column) -> Column:
    """Digits lose their leading zeros; anything else is compared in lower case."""
    p = F.trim(F.regexp_replace(F.lower(F.trim(c)), r"^pmid:\s*", ""))
    return F.when(p.rlike(r"^\d+$"), F.regexp_extract(p, r"^0*(\d+)$", 1)).when(p != "", p)


def normal_pmcid(c: Column) -> Column:
    p = F.trim(F.regexp_replace(F.upper(F.trim(c)), r"^PMCID:\s*", ""))
    n = F.regexp_extract(p, r"^(?:PMC)?0*(\d+)$", 1)
    return F.when(n != "", F.concat(F.lit("PMC"), n)).when(p != "", p)


def article_of_path(path: Column) -> Column:
    """The last ``PMC<n>`` component of a path."""
    found = F.regexp_extract_all(path, F.lit(r"(?:^|/)(PMC\d+)(?=/)"), 1)
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def clean_href(c: Column) -> Column:
    """URL-decoded, forward slashes, no query or fragment, no leading ``./``; null if absolute or climbing out."""
    p = F.translate(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "\\", "/")
    p = F.regexp_replace(F.regexp_replace(F.trim(p), r"[?#].*$", ""), r"^(?:\./)+", "")
    return F.when((p != "") & ~safe_path_problem(p), p)


def safe_path_problem(p: Column) -> Column:
    """True for an absolute path, a drive letter, a backslash or a ``..`` component."""
    return p.rlike(r"^/|^[A-Za-z]:|\\|(?:^|/)\.\.(?:/|$)")


def custom_id(stage: str, ordinal: Column, body_json: Column) -> Column:
    return F.format_string("%s-%08d-%s", F.lit(stage), ordinal, F.substring(F.sha2(body_json, 256), 1, 16))
