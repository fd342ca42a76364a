import itertools
import math
import random

import pytest

from casegrain.llm import pii
from casegrain.llm.pii_training import Maker, accuracy, evaluate, gradient, train

from . import pii_other_style

M = pii.model()


def test_held_out_accuracy():
    for kind, (precision, recall) in evaluate(M.w, 400, seed=4711).items():
        assert precision > 0.95 and recall > 0.95, kind


def test_a_style_of_other_sentences_and_names():
    for kind, (precision, recall) in accuracy(M.w, list(pii_other_style.texts(500))).items():
        assert precision >= 0.9 and recall >= 0.88, kind


@pytest.mark.parametrize(
    ("text", "spot"),
    [
        ("PATIENT NAME IS JOHN SMITH.", "JOHN SMITH"), ("Ravi was discharged home.", "Ravi"), ("The patient 王小明 was seen again.", "王小明"), ("Signed by Иван Петров today.", "Иван Петров"), ("Write to jane.doe at example dot org for more.", "jane.doe at example dot org"),
        ("Regional Teaching Hospital Patient Record Summary Helena Novak was admitted.", "Helena Novak"), ("Call 1 2 3 / 0161 496 0000 now", "0161 496 0000"),
    ],
)
def test_spots_of_many_forms_are_proposed(text, spot):
    at = text.index(spot)
    assert {(at, at + len(spot))} <= {(s, e) for s, e, _ in pii.candidates(text)}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Please contact Dr. Maria Holbek on +1 212 555 0100 for images.", {("Maria Holbek", "name"), ("+1 212 555 0100", "phone")}),
        ("Queries go to maria.holbek(at)clinic(dot)example please.", {("maria.holbek(at)clinic(dot)example", "email")}),
        ("The patient, Bo Stavsen, lives at 12 Elm Hollow Street, Fernwick ZZ1 2QX with two cats.", {("Bo Stavsen", "name"), ("12 Elm Hollow Street, Fernwick ZZ1 2QX", "address")}),
        ("Record of R. Lundmann (hospital number H-493061) was reviewed.", {("R. Lundmann", "name"), ("H-493061", "id_number")}),
        ("Similar findings were described by Vasko et al. (2013) [5].", set()), ("Lot 999 046 331 of tesprol was used, catalogue no. 555-043.", set()), ("The Brandell–Voss sign was positive.", set()),
        ("Reagent batch 052856210 came from the Port Ellery depot.", set()), ("Dose 5 mg @ 18 h was tolerated; ratio 22/24, DOI 10.5555/2340.47.", set()), ("", set()), ("REPEAT CT OF THE LIVER WAS DONE IN OSLO.", set()),
    ],
)
def test_sentences(text, want):
    assert {(text[s:e], k) for s, e, k in M.decode(text)} == want


def test_redaction_leaves_the_rest():
    text = "Signed: Bo Stavsen, passport no. X01234567. Nothing else."
    assert pii.redact(text, M.decode(text)) == "Signed: [NAME], passport no. [ID_NUMBER]. Nothing else."


def segmentations(text, cs):
    """Every set of candidates that do not overlap, in order."""
    for n in range(len(cs) + 1):
        for s in itertools.combinations(sorted(cs), n):
            if all(a[1] <= b[0] for a, b in itertools.pairwise(s)):
                yield s


def total(crf, text, s):
    t = sum(crf.score(pii.features(text, *c)) for c in s)
    return t + sum(crf.score(crf.link(text, a, b)) for a, b in itertools.pairwise(s) if b[0] - a[1] <= pii.NEAR)


@pytest.mark.parametrize("text", ["Mr Bo Stavsen, 555 0100.", "SSN 912-34-5678 / x", "Bo A. Lund, Al Brek", "Ana Lund, a@b.org, 555 0100"])
def test_decoding_and_gradient_against_brute_force(text):
    r = random.Random(1)
    cs = sorted(set(pii.candidates(text)))
    assert 2 < len(cs) < 15
    crf = pii.SegmentCRF()
    for c in cs:
        for f in pii.features(text, *c):
            crf.w.setdefault(f, r.uniform(-0.6, 0.6))
    for a, b in itertools.permutations(cs, 2):
        for f in crf.link(text, a, b):
            crf.w.setdefault(f, r.uniform(-0.6, 0.6))
    every = list(segmentations(text, cs))
    best = max(every, key=lambda s: total(crf, text, s))
    assert total(crf, text, crf.decode(text)) == pytest.approx(total(crf, text, best))
    z = math.log(sum(math.exp(total(crf, text, s)) for s in every))
    expected = {}
    for s in every:
        p = math.exp(total(crf, text, s) - z)
        for c in s:
            for f in pii.features(text, *c):
                expected[f] = expected.get(f, 0) + p
    got = gradient(crf, text, [])
    for f, v in expected.items():
        assert -got.get(f, 0) == pytest.approx(v, abs=1e-3)


def test_training_learns():
    w = train(150, seed=3, rounds=2)
    assert all(p > 0.7 for p, _ in evaluate(w, 60, seed=8).values())


def test_nearly_all_corpus_spots_are_candidates():
    m, missed, n = Maker(11), 0, 0
    for _ in range(500):
        text, gold = m.text()
        missed += len(set(gold) - set(pii.candidates(text)))
        n += len(gold)
    assert missed < 0.01 * n


def test_names_behind_many_capitalised_words():
    names = "Anna Berg, Bo Lind, Carl Holm, Dora Voss, Egon Falk, Fay Nord, Gus Hale, Ida Moor".split(", ")
    text = f"Thanks to {', '.join(names * 5)}"
    proposed = {(s, e) for s, e, k in pii.candidates(text) if k == "name"}
    at = 0
    for n in names * 5:
        at = text.index(n, at)
        assert (at, at + len(n)) in proposed
        at += len(n)
    text = f"Thanks to {', '.join(names)}"
    assert "Ida Moor" in {text[s:e] for s, e, k in M.decode(text) if k == "name"}


@pytest.mark.parametrize(
    ("text", "phones"),
    [
        ("Call 020 7946 0958 / 020 7946 0959 please.", ["020 7946 0958", "020 7946 0959"]), ("Tel. 01 23 45 67 89 / 01 98 76 54 32", ["01 23 45 67 89", "01 98 76 54 32"]),
        ("Seen 12.03.2019 (555) 123-4567 today", ["(555) 123-4567"]),
    ],
)
def test_neighbouring_numbers(text, phones):
    assert [text[s:e] for s, e, k in M.decode(text) if k == "phone"] == phones


def test_numbers_are_proposed_wherever_they_start():
    for text, number in [("born 12.03.1975 030 1234567", "030 1234567"), ("1 2 3 4 5 / " * 30 + "030 1234567", "030 1234567"), ("x 0 2 0 7 9 4 6 0 9 5 8", "0 2 0 7 9 4 6 0 9 5 8")]:
        at = text.index(number)
        assert {(at, at + len(number), k) for k in ("phone", "id_number")} <= set(pii.candidates(text))


def test_in_spark(spark):
    text = "Signed: Bo Stavsen, passport no. X01234567."
    rows = [(1, text, "c"), (2, None, "c"), (3, "", "c"), (4, "x " * 50_000 + text, "c"), (1, text, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, redacted string")
    got = {tuple(r) for r in pii.find_personal(df).collect()}
    assert got == {(1, 8, 18, "name"), (1, 33, 42, "id_number"), (4, 100_008, 100_018, "name"), (4, 100_033, 100_042, "id_number")}
    out = {r["doc_id"]: (r["redacted"], r["spots"]) for r in pii.replace_personal(df).collect()}
    assert out[1] == ("Signed: [NAME], passport no. [ID_NUMBER].", 2) and out[2] == (None, 0) and out[3] == ("", 0)
    assert pii.find_personal(df.limit(0)).count() == 0
