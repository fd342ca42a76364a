"""Text functions: white space, titles, numeric labels, citation expressions, phrases, buckets."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The modality buckets in order with the words that select them; the first bucket with a hit wins.
MODALITY_BUCKETS = {
    "pathology_microscopy": [
        r"histolog(?:y|ic|ical)?", r"patholog(?:y|ic|ical)?", r"microscop(?:y|ic|ical)?", r"immunohistochem(?:istry|ical|ically)?", "ihc",
        "hematoxylin", "eosin", r"h\s*&\s*e", r"stain(?:ed|ing|s)?", r"biops(?:y|ies)", r"slides?",
    ],
    "ophthalmology": [
        "fundus", "oct", r"optical\s+coherence(?:\s+tomography)?", r"slit[ -]lamp", "fluorescein", "indocyanine", r"retin(?:a|al)",
        r"ophthalm(?:ic|ology|ological)?",
    ],
    "endoscopy": [r"endoscop(?:e|y|ic)", "colonoscopy", "gastroscopy", "bronchoscopy", "laparoscopy", "hysteroscopy", "arthroscopy"],
    "cardiology": ["ecg", "ekg", r"electrocardiograph(?:y|ic)?", r"echocardiograph(?:y|ic)?", "echocardiogram", r"cardiac\s+echo"],
    "radiology": [
        "ct", r"computed\s+tomograph(?:y|ic)", "mri", r"magnetic\s+resonance(?:\s+imaging)?", r"x[ -]?rays?", r"radiograph(?:s|y|ic|ical)?",
        "ultrasound", r"ultrasonograph(?:y|ic)?", r"sonograph(?:y|ic)?", "pet", "spect", r"angiograph(?:y|ic)?", r"fluoroscop(?:y|ic)?",
        r"mammograph(?:y|ic)?", r"tomograph(?:y|ic)?",
    ],
}
LETTER = r"[\p{L}\p{N}_]"


def bucket_words(name: str) -> str:
    """The words of a bucket as one alternation; white space is that of Unicode."""
    return "|".join(MODALITY_BUCKETS[name]).replace(r"\s", r"[\s\p{Z}]")


# word boundaries are spelt out: what "\b" takes for a letter depends on the regex engine and its version
BUCKETS = [(n, rf"(?i)(?<!{LETTER})(?:{bucket_words(n)})(?!{LETTER})") for n in MODALITY_BUCKETS]


def collapse(c: Column) -> Column:
    """Unicode white space to single blanks, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def python_title(s: str | None) -> str | None:
    if s is None:
        return None
    t = re.sub(r"[^\w\s]|_", " ", unicodedata.normalize("NFKC", s).casefold())
    return " ".join(t.split())


@F.pandas_udf(T.StringType())
def _any_title(s: pd.Series) -> pd.Series:
    return pd.Series([python_title(x) if isinstance(x, str) else None for x in s], dtype=object)


def normal_title(c: Column) -> Column:
    """NFKC, case-folded words. Plain ASCII stays in the JVM; only other titles need Python."""
    odd = c.rlike(r"[^\x00-\x7F]")
    plain = F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "))
    return F.when(odd, _any_title(F.when(odd, c))).otherwise(plain)


def title_within(cited: Column, listed: Column, least_chars: int = 20, least_words: int = 4) -> Column:
    """Does the normalised ``listed`` title equal or hold the normalised ``cited`` one, word by word? Short titles never do."""
    padded = F.concat(F.lit(" "), listed, F.lit(" ")).contains(F.concat(F.lit(" "), cited, F.lit(" ")))
    return (F.length(cited) >= least_chars) & (F.size(F.split(cited, " ")) >= least_words) & padded


def numeric_label(c: Column) -> Column:
    """``[12].`` or ``12`` -> 12."""
    p = r"^\s*[\[(]?\s*(\d{1,9})\s*(?:[\])]\s*\.?|\.)?\s*$"
    return F.when(c.rlike(p), F.regexp_extract(c, p, 1).cast("int"))


def expand_citation(c: Column, widest: int = 1000) -> Column:
    """Sorted distinct numbers of an expression like ``[3, 5–7]``; null unless it holds only digits and separators, or if a number
    has ten digits or more."""
    dash = r"\s*[-‐‑‒–—−]\s*"
    only = c.rlike(r"^[\s\[\](){},;\d‐‑‒–—−-]+$") & c.rlike(r"\d") & ~c.rlike(r"\d{10}")
    parts = F.regexp_extract_all(F.regexp_replace(c, dash, "-"), F.lit(r"(\d{1,9}(?:-\d{1,9})?)"), 1)

    def numbers(p: Column) -> Column:
        a = F.split_part(p, F.lit("-"), F.lit(1)).cast("int")
        b = F.nullif(F.split_part(p, F.lit("-"), F.lit(2)), F.lit("")).cast("int")
        ranged = b.isNotNull() & (a < b) & (b - a <= widest)
        return F.when(ranged, F.sequence(a, F.when(ranged, b).otherwise(a))).otherwise(F.array_compact(F.array(a, b)))

    return F.when(only, F.array_sort(F.array_distinct(F.flatten(F.transform(parts, numbers)))))


def modality_bucket(c: Column) -> Column:
    out = F.when(c.rlike(BUCKETS[0][1]), BUCKETS[0][0])
    for name, pattern in BUCKETS[1:]:
        out = out.when(c.rlike(pattern), name)
    return out.otherwise("other")


def short_caption(diagnosis: Column, anatomy: Column, modality: Column) -> Column:
    return F.concat(diagnosis, F.lit(" in the "), anatomy, F.lit(" on "), modality, F.lit("."))


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
