"""Free phrases to category labels by a rule taxonomy (``taxonomy.json``).

A phrase is normalised, all rules of its field are matched, and matches are accepted greedily, by priority, then length, so that
no two overlap. Diagnoses are judged clause by clause: a negated finding is a normal report, a resolved one a postoperative
state. The work is done once per distinct phrase and joined back.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrain.operators.finalize import FIELDS
from casegrain.operators.joins import small_join
from casegrain.session import Tables

TAXONOMY = Path(__file__).parent.parent / "taxonomy.json"
DASHES = str.maketrans(dict.fromkeys("‐‑‒–—−-", " "))


def normal_phrase(text: str, replacements: tuple[tuple[str, str], ...] = ()) -> str:
    """Compatibility-decomposed, case-folded, without accents; separators / , ; and decimal points stay."""
    t = unicodedata.normalize("NFKD", text).casefold()
    t = "".join(c for c in t if not unicodedata.combining(c)).translate(DASHES)
    t = re.sub(r"[^\w\s/,;.]|_", " ", t)
    t = re.sub(r"(?<!\d)\.|\.(?!\d)", " ", t)
    for p, r in replacements:
        t = re.sub(p, r, t)
    return " ".join(t.split())


def alias_pattern(alias: str) -> str:
    """A regular plural is allowed: consonant + y also as ies, any other letter but s with an s."""
    if alias[-1:] == "y" and alias[-2:-1] not in "aeiou":
        return re.escape(alias[:-1]) + "(?:y|ies)"
    return re.escape(alias) + ("s?" if alias[-1:].isalpha() and alias[-1] != "s" else "")


class Taxonomy:
    def __init__(self, spec: dict):
        self.replacements = tuple(map(tuple, spec["replacements"]))
        self.rules = {f: [(r["id"], r["label"], r.get("priority", 0), r.get("kind", "specific"), self._compiled(r)) for r in rules] for f, rules in spec["rules"].items()}
        self.context = {k: re.compile(v) for k, v in spec["context"].items()}
        self.categories = spec["categories"]

    def _compiled(self, rule: dict) -> re.Pattern:
        # an alternation takes its first way, so longer aliases come first
        aliases = sorted({normal_phrase(a, self.replacements) for a in rule.get("aliases", [])}, key=lambda a: (-len(a), a))
        ways = [alias_pattern(a) for a in aliases] + rule.get("patterns", [])
        return re.compile(rf"(?<!\w)(?:{'|'.join(ways)})(?!\w)")

    def hits(self, field: str, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, label, kind) of the accepted matches, in text order."""
        found = [(-p, m.start() - m.end(), rid, m.start(), m.end(), label, kind) for rid, label, p, kind, rx in self.rules[field] for m in rx.finditer(text)]
        taken: list[tuple[int, int, str, str]] = []
        for *_, start, end, label, kind in sorted(found):
            if all(end <= a or b <= start for a, b, _, _ in taken):
                taken.append((start, end, label, kind))
        return sorted(taken)

    def labels(self, field: str, phrase: str) -> list[str]:
        text = normal_phrase(phrase, self.replacements)
        if field == "diagnosis":
            out = {x for c in self.context["clause"].split(text) if c.strip() for x in self._clause(c.strip())}
        elif field == "anatomy":
            vessels = self.context["vessel"]
            out = {"vasculature"} if vessels.search(text) else set()
            out |= {h[2] for h in self.hits(field, vessels.sub(lambda m: " " * len(m.group()), text))}
        else:
            out = {h[2] for h in self.hits(field, text)}
        return sorted(out or {"other"})

    def _clause(self, clause: str) -> set[str]:
        c, out = self.context, set()
        hits = self.hits("diagnosis", clause)
        specific = [h for h in hits if h[3] == "specific"] or hits
        for start, end, label, _ in specific:
            before, after = clause[:start], clause[end:]
            if c["negated_before"].search(before) or c["negated_after"].search(after):
                label = "normal_or_negative_report"
            elif not c["unresolved"].search(clause) and (c["resolved_before"].search(before) or c["resolved_after"].search(after)):
                label = "postoperative_or_resolved_state"
            out.add(label)
        if not hits:
            out |= {"postoperative_or_resolved_state"} if c["postoperative"].search(clause) else {"normal_or_negative_report"} if c["normal"].search(clause) else set()
        return out


@lru_cache(4)
def taxonomy(text: str | None = None) -> Taxonomy:
    return Taxonomy(json.loads(TAXONOMY.read_text() if text is None else text))


def phrase_labels(phrases: DataFrame, spec: str | None = None) -> DataFrame:
    """Distinct (field, phrase) with labels; ``spec`` is another taxonomy as JSON text."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = taxonomy(spec)
        for b in batches:
            yield b.assign(labels=[t.labels(f, p) for f, p in zip(b["field"], b["phrase"], strict=True)])

    spark = phrases.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    distinct = phrases.select("field", "phrase").where(F.col("phrase").isNotNull()).distinct()
    # few bytes but much work per row: a fixed number of partitions is not put together
    return distinct.repartition(tasks, "field", "phrase").mapInPandas(scan, "field string, phrase string, labels array<string>")


def labelled_pairs(pairs: DataFrame, spec: str | None = None) -> DataFrame:
    """``pairs`` (pair_index, pair_id and three phrases) with every phrase replaced by its labels; null phrases are "other"."""
    out = pairs.select("pair_index", "pair_id", *FIELDS)
    phrases = pairs.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("phrase")) for f in FIELDS])).alias("e")).select("e.*")
    mapped = Tables(pairs.sparkSession, "labels").keep(phrase_labels(phrases, spec), "phrases")
    for f in FIELDS:
        m = mapped.where(F.col("field") == f).select(F.col("phrase").alias(f), F.col("labels").alias(f"__{f}"))
        out = small_join(out, m, [f], ["pair_index"], "left").withColumn(f, F.coalesce(f"__{f}", F.array(F.lit("other")))).drop(f"__{f}")
    return out
