import pytest

from casegrain.operators import cohort

P = "csv_row long, patient_uid string, similar_patients string, note string"


@pytest.mark.parametrize(
    ("cell", "status", "links"),
    [
        (None, "missing", {}), ("  ", "missing", {}), ("{}", "ok", {}), ('{"PMC2_1": 0.9, "10-1": 2}', "ok", {"2-1": "0.9", "10-1": "2"}), ("{'2-1': None}", "ok", {"2-1": "null"}),
        ('{"2-1": NaN}', "ok", {"2-1": "null"}), ('{"2-1": 1.50}', "ok", {"2-1": "1.5"}), ("[1]", "non_mapping", {}), ("NaN", "non_mapping", {}), ("null", "malformed", {}), ('{"2-1": 1', "malformed", {}),
        ("{1: 2, '3-1': 4}", "invalid_keys", {"3-1": "4"}), ('{"x": 1}', "invalid_keys", {}), ('{"2-1": 1, "2_1": 2}', "ok", {"2-1": "2"}), ('{"2-1": 1, }', "ok", {"2-1": "1"}),
    ],
)
def test_cells(spark, cell, status, links):
    got = spark.createDataFrame([(1, "1-1", cell, None)], P)
    r = cohort.normal_patients(got).select("parsed.*").first()
    found = {}
    for x in r["links"]:
        found[x["dst"]] = x["score"]
    assert (r["status"], found) == (status, links)


def test_quick_and_python_parsers_agree(spark):
    cells = ['{"1-1": 0.25, "2-1":3}', '{"PMC3_2": -1}', '{"1-1": 0.5}', '{"9-9": 12345678901234}', '{"1-1": 0}']
    df = cohort.normal_patients(spark.createDataFrame([(i, "1-1", c, None) for i, c in enumerate(cells)], P)).orderBy("csv_row")
    for c, r in zip(cells, df.select("parsed.*").collect(), strict=True):
        status, links = cohort.python_mapping(c)
        assert (r["status"], sorted((x["dst"], x["score"]) for x in r["links"])) == (status, sorted(links))


ROWS = [
    (2, "100-1", '{"200-1": 1, "100-1": 9}', "old"), (3, "PMC100_1", "{'200-1': 2, '300-1': 3}", "new"), (4, "200-1", "{}", None), (5, "300-1", "", "a"), (6, "300-2", '{"100-1": 1}', "b"), (7, "bad", "{}", "c"),
]


def test_cohort(spark):
    raw = spark.createDataFrame(ROWS, P)
    u = {r["uid"]: r for r in cohort.unify(raw, ["note"]).collect()}
    assert set(u) == {"100-1", "200-1", "300-1", "300-2"}
    assert (u["100-1"]["note"], u["100-1"]["csv_rows"], u["100-1"]["note_conflicts"]) == ("new", [2, 3], 1)
    m = {(r["src"], r["dst"]): (r["score"], r["rows"], r["score_conflicts"]) for r in cohort.merged_links(raw).collect()}
    assert m[("100-1", "200-1")] == ("2", 2, 1) and m[("100-1", "300-1")] == ("3", 1, 0)
    links = cohort.cohort_links(raw)
    assert [(r["src"], r["dst"]) for r in links.collect()] == [("100-1", "200-1")]  # article 300 has two patients
    assert {(r["uid"], r["targets"]) for r in cohort.cohort_members(links).collect()} == {("100-1", 1), ("200-1", 0)}
    assert cohort.invalid_uids(raw).count() == 1
    assert cohort.cohort_links(raw.limit(0)).count() == 0
