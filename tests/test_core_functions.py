import hashlib

import pytest
from pyspark.sql import functions as F

from casegrain.functions import keys, text
from casegrain.operators.graph import candidate_pairs, indexed_pairs, pair_problems


def apply(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (keys.article_id, {"PMC0012": "12", " pmc7 ": "7", "x1": None, "": None, None: None}),
        (keys.case_uid, {"100-1": "100-1", "PMC100_1": "100-1", " pmc007-02": "7-2", "100": None, "1-2-3": None, None: None}),
        (keys.figure_number, {"a/b/1_1_12.jpg": 12, "x_3": 3, "plain.jpg": 0, "a_b/c.jpg": 0}),
        (keys.normal_doi, {"https://doi.org/10.1/AB": "10.1/ab", "DOI: 10.2/x": "10.2/x", " ": None, None: None}),
        (keys.normal_pmid, {"pmid: 0012": "12", "Abc": "abc", "": None}),
        (keys.normal_pmcid, {"PMC012": "PMC12", "pmcid: 7": "PMC7", "x": "X"}),
        (keys.article_of_path, {"a/PMC1/b/PMC22/c.xml": "PMC22", "PMC9/x": "PMC9", "none": None}),
        (keys.clean_href, {"./a%20b.jpg?x#y": "a b.jpg", "..\\x": None, "/abs": None, "a+b.png": "a+b.png", "": None}),
        (text.collapse, {"  a  b\n": "a b", "": "", None: None}),
        (text.normal_title, {"Ａ β-Study: _x_": "a β study x", "Straße": "strasse", "plain, ASCII": "plain ascii", None: None}),
        (text.numeric_label, {"[12].": 12, "3.": 3, "(4)": 4, "4a": None, "": None}),
        (text.expand_citation, {"[3, 5–7]": [3, 5, 6, 7], "7-5": [5, 7], "see 3": None, "1": [1], "": None, "1-5000": [1, 5000]}),
        (text.modality_bucket, {"CT scan": "radiology", "H&E stain": "pathology_microscopy", "OCT": "ophthalmology", "echocardiography": "cardiology", "xoctx": "other", "": "other"}),
    ],
)
def test_function(spark, f, cases):
    assert apply(spark, f, list(cases)) == list(cases.values())


def test_title_within(spark):
    long = "a rare tumour of the left orbit"
    rows = [(long, f"see {long} again", True), (long, long + "al disease", False), ("short one", "short one", False), (None, long, False)]
    df = spark.createDataFrame([(c, li) for c, li, _ in rows], "c string, l string")
    got = [r["o"] or False for r in df.select(text.title_within(F.col("c"), F.col("l")).alias("o")).collect()]
    assert got == [w for *_, w in rows]


def test_finite(spark):
    assert apply(spark, text.finite, [1.5, float("nan"), float("inf"), None], "double") == [1.5, None, None, None]


def test_pairs(spark):
    links = spark.createDataFrame([("2-1", "10-1"), ("10-1", "2-1"), ("3-1", "3-1"), ("2-1", "3-1"), ("100-2", "20-1"), ("10-1", "9000-1")], "src string, dst string")
    got = [tuple(r) for r in indexed_pairs(candidate_pairs(links)).orderBy("pair_index").collect()]
    key = lambda a, b: hashlib.sha256(f"{a}\0{b}".encode()).hexdigest()
    want = [("2-1", "3-1"), ("2-1", "10-1"), ("10-1", "9000-1"), ("20-1", "100-2")]
    assert got == [(i, a, b, key(a, b)) for i, (a, b) in enumerate(want)]
    assert pair_problems(indexed_pairs(candidate_pairs(links))).count() == 0
    assert indexed_pairs(candidate_pairs(links.limit(0))).count() == 0


def test_pair_problems(spark):
    rows = [(-1, "1-1", "2-1", "k"), (5, None, "2-1", None), (6, "3-1", "2-1", None)]
    got = {tuple(r) for r in pair_problems(spark.createDataFrame(rows, "pair_index long, case_a_uid string, case_b_uid string, pair_key string")).collect()}
    assert got == {(-1, "bad_index"), (-1, "wrong_key"), (5, "missing_end"), (6, "wrong_orientation"), (6, "wrong_key")}
