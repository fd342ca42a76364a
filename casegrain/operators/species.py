"""Is the subject of a report a human or an animal? A versioned rule set over title and abstract.

The rules are word lists and an ordered decision, evaluated as regular expressions on columns. Only one needs match positions,
which Spark's expressions do not give: whether a species word names the subject, by the words near each of its occurrences. It
runs in a pandas UDF, for rows that hold a species word at all.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrain.operators.joins import heavy_join

RULESET = "human_animal_v1"

# The words of each rule.
SPECIES = {
    "dog": r"dogs?|pupp(?:y|ies)|canines?",
    "cat": r"cats?|kittens?|felines?|domestic\s+(?:short|long)hair",
    "horse": r"horses?|equines?|pon(?:y|ies)|foals?",
    "cattle": r"cattle|cows?|calves?|bovines?",
    "sheep": r"sheep|lambs?|ovines?",
    "goat": r"goats?|caprines?",
    "pig": r"pigs?|swine|porcines?|piglets?",
    "rabbit": r"rabbits?|lagomorphs?",
    "ferret": r"ferrets?",
    "bird": r"birds?|avians?|parrots?|parakeets?|chickens?|ducks?|geese",
    "reptile": r"reptiles?|snakes?|lizards?|turtles?|tortoises?",
    "rodent": r"mice|mouse|rats?|murine|rodents?|hamsters?|guinea\s+pigs?",
    "nonhuman_primate": r"non[- ]human\s+primates?|monkeys?|macaques?|baboons?|chimpanzees?",
    "fish": r"fish|fishes|zebrafish",
}
CONTEXT = {
    "veterinary_context": r"\b(?:veterinar(?:y|ian)|veterinary\s+patient|animal\s+patient)\b",
    "direct_nonhuman_subject": r"\b(?:non[- ]human|nonhuman|animal\s+case\s+report|veterinary\s+case)\b",
    "zoonosis": r"\b(?:zoono(?:sis|ses|tic)|animal[- ]to[- ]human|pet\s+owner)\b",
    "human_patient_context": r"\b(?:human\s+(?:patient|case|subject)|man|woman|boy|girl)\b",
    "ambiguous:breed": r"\b(?:labrador|retriever|bulldog|beagle|poodle|terrier|dachshund|rottweiler|doberman|boxer|german\s+shepherd|shih\s+tzu|persian|siamese|maine\s+coon)\b",
    "exposure:animal_bite": r"\b(?:dog|cat|animal|monkey|rat|snake)\s+bites?\b",
    "exposure:animal_attack": r"\b(?:dog|cat|animal)\s+attack(?:s|ed)?\b",
    "exposure:cat_scratch": r"\bcat[- ]scratch(?:es|ed|ing)?\b",
    "exposure:animal_contact": r"\b(?:expos(?:ed|ure)|contact)\s+(?:to|with)\s+(?:(?:a|an|the)\s+)?(?:animals?|dogs?|cats?|birds?|livestock|horses?|rodents?|mice|rats?|monkeys?)\b",
    "exposure:animal_transmission": r"\b(?:transmi(?:tted|ssion)|acquired)\s+(?:from|by)\s+(?:animals?|dogs?|cats?|birds?|livestock|horses?|rodents?|mice|rats?)\b",
    "model:animal_model": r"\b(?:animal|murine|mouse|rat|canine|feline)\s+models?\b",
    "model:experimental_animal": r"\b(?:experimental(?:ly)?|laboratory)\s+(?:animals?|mice|mouse|rats?|dogs?|cats?)\b",
    "model:experimental_subjects": r"\b(?:mice|mouse|rats?|rabbits?|dogs?|cats?|pigs?|swine|monkeys?)\s+(?:were|was)\s+(?:randomi[sz]ed|treated|injected|implanted|sacrificed|euthani[sz]ed)\b",
}
AMBIGUOUS = {
    "cat_scan": r"\bcat\s+scan\b|\bcomputed\s+axial\s+tomography\b",
    "canine_dental": r"\bcanine\s+(?:fossa|space|eminence|tooth|teeth|root|roots|retraction|guidance)\b|\b(?:maxillary|mandibular|impacted)\s+canine\b",
    "animal_adjective": r"\b(?:canine|feline|equine|bovine|ovine|caprine|porcine|murine|avian)\b",
    "animal_association": r"\b(?:canine|feline|equine|bovine|ovine|caprine|porcine|murine|avian)[- ]associated\b",
    "dog_ear": r"\bdog[- ]ears?\b",
    "laboratory_reagent": r"\b(?:mouse|rabbit|goat)\s+(?:anti[- ]|antibody|serum)\b",
    "fish_assay": r"\bfluorescence\s+in\s+situ\s+hybridization\b|\bfish[- ](?:analysis|assay|test(?:ing)?|probe|probes|study|studies|positive|negative)\b",
}
SUBJECT = r"\b(?:patient|case|present(?:ed|ing)?|underwent|had|was|were|showed|diagnosed|treated|admitted|referred|suffering|with|year[- ]old|month[- ]old)\b"
IN_SPECIES = r"\b(?:in|of|from)\s+(?:a|an|the|one|two|\d+)\b"
BEFORE, AFTER = 35, 45

ANY_SPECIES = rf"\b(?:{'|'.join(SPECIES.values())})\b"
_SPECIES = [re.compile(rf"\b(?:{p})\b") for p in SPECIES.values()]
_PHRASES = re.compile("|".join(f"(?:{p})" for n, p in AMBIGUOUS.items() if n != "animal_adjective"))
_SUBJECT, _IN = re.compile(SUBJECT), re.compile(IN_SPECIES)


def names_subject(text: str) -> bool:
    """Does a species word that starts outside the ambiguous medical phrases have a word of its subject close by?"""
    covered = set()
    at = 0
    while m := _PHRASES.search(text, at):  # phrases may overlap
        covered.update(range(m.start(), m.end()))
        at = m.start() + 1
    for p in _SPECIES:
        for m in p.finditer(text):
            left, right = text[max(0, m.start() - BEFORE) : m.start()], text[m.end() : m.end() + AFTER]
            if m.start() not in covered and (_SUBJECT.search(left) or _IN.search(left) or _SUBJECT.search(right)):
                return True
    return False


@F.pandas_udf(T.BooleanType())
def _named(s: pd.Series) -> pd.Series:
    return s.map(lambda t: names_subject(t) if isinstance(t, str) else False).astype(bool)


def subject_named(text: Column) -> Column:
    hit = text.rlike(ANY_SPECIES)
    return F.coalesce(hit & _named(F.when(hit, text)), F.lit(False))


def field_rules(c: Column, field: str) -> Column:
    """Sorted array of the labels of all rules that hit one field."""
    t = F.lower(F.coalesce(c, F.lit("")))
    labels = [F.when(t.rlike(rf"\b(?:{p})\b"), f"{field}:species:{n}") for n, p in SPECIES.items()]
    labels += [F.when(t.rlike(p), f"{field}:{n}") for n, p in CONTEXT.items()]
    labels += [F.when(t.rlike(p), f"{field}:ambiguous:{n}") for n, p in AMBIGUOUS.items()]
    labels.append(F.when(subject_named(t), f"{field}:explicit_nonhuman_subject"))
    return F.array_sort(F.array_compact(F.array(*labels)))


def rule_labels(fields: tuple[str, ...] = ("title", "abstract")) -> list[str]:
    """Every label the rule set can give."""
    names = [f"species:{n}" for n in SPECIES] + list(CONTEXT) + [f"ambiguous:{n}" for n in AMBIGUOUS] + ["explicit_nonhuman_subject"]
    return sorted(f"{f}:{n}" for f in fields for n in names)


def decide(rules: Column) -> Column:
    """The label of a record from its rules."""
    has = lambda p: F.exists(rules, lambda r: r.rlike(p))
    human = has(r":exposure:|:zoonosis|:human_patient_context")
    animal = has(":model:") | has(":explicit_nonhuman_subject$") | (has(":veterinary_context$") & has(":species:"))
    return F.when(has(r"^title:model:"), "animal").when(has(":direct_nonhuman_subject$"), "animal").when(human, "human").when(animal, "animal").otherwise("human")


def classify_species(records: DataFrame, title: str = "title", abstract: str = "abstract") -> DataFrame:
    """``records`` with matched_rules and automatic_label; null texts match nothing."""
    rules = F.array_sort(F.concat(field_rules(F.col(title), "title"), field_rules(F.col(abstract), "abstract")))
    return records.withColumn("matched_rules", rules).withColumn("automatic_label", decide(F.col("matched_rules")))


def adjudicate(classified: DataFrame, decisions: DataFrame, key: str = "patient_uid") -> DataFrame:
    """Decisions (key, label, reason) override the automatic label, which stays beside the final one."""
    d = decisions.select(key, F.col("label").alias("__l"), F.struct("label", "reason").alias("adjudication"))
    return classified.join(d, key, "left").withColumn("final_label", F.coalesce("__l", "automatic_label")).drop("__l")


def pair_species(pairs: DataFrame, labels: DataFrame, key: str = "patient_uid") -> DataFrame:
    """Pairs with both ends' labels: human only if both are; a pair with an end that has no label is dropped (see missing_keys)."""
    a = labels.select(F.col(key).alias("case_a_uid"), F.col("final_label").alias("label_a"))
    b = labels.select(F.col(key).alias("case_b_uid"), F.col("final_label").alias("label_b"))
    j = heavy_join(heavy_join(pairs, a, ["case_a_uid"]), b, ["case_b_uid"])
    return j.withColumn("label", F.when((F.col("label_a") == "human") & (F.col("label_b") == "human"), "human").otherwise("animal"))
