import json

from pyspark.sql import functions as F

from casegrain.operators import batches, finalize, merge
from casegrain.operators.constraints import IntegrityError, changed_rows, difference, duplicates, gaps, require_none

D = "pair_id array<string>, modality string, anatomy string, diagnosis string, source_pair_index long"


def test_finalize(spark):
    rows = [
        (["b", "a"], "MRI", "liver", "x", 7), (["a", "b"], " CT scan ", "liver", "x", 7), (["a", "b"], "CT scan", "liver", "x", None), (["a", "a"], "CT", "l", "x", 1), (["a", None], "CT", "l", "x", 1), (["a"], "CT", "l", "x", 1),
        (["c", "d"], " ", "l", "x", 1), (None, "CT", "l", "x", 1), (["c", "d"], "OCT", None, "x", 1),
    ]
    got = finalize.positive_pairs(spark.createDataFrame(rows, D)).collect()
    assert [(r["pair_id"], r["modality"], r["modality_bucket"], r["caption"]) for r in got] == [(["a", "b"], "CT scan", "radiology", "x in the liver on CT scan.")]
    assert finalize.positive_pairs(spark.createDataFrame([], D)).count() == 0


def test_image_labels(spark):
    s = "pair_index long, pair_id array<string>, modality array<string>, anatomy array<string>, diagnosis array<string>"
    rows = [(0, ["a", "b"], ["ct"], ["liver"], ["mass"]), (1, ["a", "c"], ["mri"], ["spine"], ["abscess"]), (2, ["a", "d"], ["other"], ["other"], ["other"]), (3, ["d", "d"], ["other"], ["other"], ["other"])]
    pairs = spark.createDataFrame(rows, s)
    images = finalize.image_labels(pairs)
    got = {r["image_id"]: r for r in images.collect()}
    assert got["a"]["modality"] == ["ct", "mri"] and got["a"]["pair_indices"] == [0, 1, 2]
    assert got["d"]["modality"] == ["other"] and got["d"]["pair_indices"] == [2, 3]
    allowed = {"modality": ["ct", "mri", "other"], "anatomy": ["liver", "spine", "other"], "diagnosis": ["mass", "abscess", "other"]}
    assert finalize.label_problems(images, pairs, allowed).count() == 0
    bad = images.withColumn("modality", F.array(F.lit("other"), F.lit("x"))).where("image_id <> 'b'")
    assert {r["problem"] for r in finalize.label_problems(bad, pairs, allowed).collect()} == {"modality_undeclared", "modality_other_not_alone", "provenance_missing"}


def test_orientation(spark):
    m = spark.createDataFrame([(7, ["a1", "a2"], ["b1"]), (8, ["x"], ["x"])], "source_pair_index long, case_a_images array<string>, case_b_images array<string>")
    r = spark.createDataFrame([(["b1", "a1"], 7), (["a1", "a2"], 7), (["x", "y"], 8), (["q", "r"], 9)], "pair_id array<string>, source_pair_index long")
    got = {tuple(x["pair_id"]): x["problem"] for x in finalize.orient_pairs(r, m).collect()}
    assert got == {("b1", "a1"): None, ("a1", "a2"): "not_inter_case", ("x", "y"): "overlap", ("q", "r"): "unknown_pair"}


def test_shards_fill_in_order(spark):
    sizes = [(i * 37) % 90 + 10 for i in range(400)]
    lines = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "ordinal long, line_bytes long")
    got = [(r["shard"], r["line_number"]) for r in batches.assign_shards(lines, 300, 6).orderBy("ordinal").collect()]
    want, shard, used, held = [], 0, 0, 0
    for n in sizes:
        if held and (used + n > 300 or held >= 6):
            shard, used, held = shard + 1, 0, 0
        used, held = used + n, held + 1
        want.append((shard, held))
    assert got == want
    for per_task in (6, 7, 50, 399):
        assert [(r["shard"], r["line_number"]) for r in batches.assign_shards(lines, 300, 6, per_task).orderBy("ordinal").collect()] == want
    assert batches.assign_shards(lines.limit(0)).count() == 0


def test_requests_have_contiguous_ordinals(spark):
    df = spark.createDataFrame([(i, json.dumps({"n": i})) for i in range(500, 0, -1)], "k long, body string").repartition(7)
    rows = batches.request_lines(df, "question", ["k"]).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in rows] == list(range(500)) and [r["k"] for r in rows] == list(range(1, 501))
    assert rows[3]["custom_id"].startswith("question-00000003-") and json.loads(rows[3]["line"])["custom_id"] == rows[3]["custom_id"]
    assert gaps(batches.request_lines(df, "question", ["k"]), "ordinal").count() == 0


def line(cid, text="ok", status=200, **choice):
    c = {"index": 0, "finish_reason": "stop", "message": {"role": "assistant", "content": text}} | choice
    return json.dumps({"custom_id": cid, "error": None, "response": {"status_code": status, "body": {"choices": [c]}}})


def test_reconcile(spark):
    raw = [line("a"), line("b", status=500), line("c", " "), line("d", finish_reason="length"), line("e"), line("e"), line("x"), "", "{nonsense"]
    r = batches.read_responses(spark.createDataFrame([(v,) for v in raw], "value string"))
    index = spark.createDataFrame([(c, i, i) for i, c in enumerate("abcdef")], "custom_id string, ordinal long, pair_index long")
    good, bad = batches.reconcile(index, r.where("custom_id IS NOT NULL"))
    assert [x["custom_id"] for x in good.collect()] == ["a"]
    assert {tuple(x) for x in bad.collect()} == {("b", "http_status"), ("c", "blank"), ("d", "finish_reason"), ("e", "duplicate"), ("f", "missing"), ("x", "unexpected")}
    assert r.where("problem = 'malformed'").count() == 1


def test_strict_items(spark):
    ok = {"pair_id": ["b1", "a1"], "modality": "CT", "anatomy": "x", "diagnosis": "y"}
    dump = json.dumps
    cases = [("[]", None, 0), (dump([ok]), None, 1), (f"```json\n{dump([ok])}\n```", None, 1), ('[{"a": 1, "a": 2}]', "json", 0), ("[NaN]", "json", 0), ("[] trailing", "json", 0), (dump([ok | {"z": 1}]), "fields", 0),
             (dump([ok | {"pair_id": ["a"]}]), "pair_id", 0), (dump([ok | {"modality": " "}]), "label", 0), ("{}", "not_an_array", 0), (None, "json", 0)]
    got = batches.parse_items(spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, text string")).orderBy("i").collect()
    assert [((r["problem"] or "").split(":")[0] or None, len(r["items"])) for r in got] == [c[1:] for c in cases]


def test_answers(spark):
    q = "Level 1\nWhy?\nLevel 2: more\nHow?\nlevel 3\nWhen?"
    cases = {q: None, q.replace("How?", "How."): "no_question", q.replace("Level 2: more\n", ""): "levels", "x\n" + q: "text_before", q.replace("When?", " "): "empty_level", "I cannot assist": "refusal"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert [r["p"] for r in df.select(batches.level_problem(F.col("t"), True).alias("p")).collect()] == list(cases.values())
    c = {"Reason for Citation: a\nPossible Similarities: b\nExplanation: c\nd": None, "Reason for Citation: a\nExplanation: c": "fields"}
    df = spark.createDataFrame([(k,) for k in c], "t string")
    assert [r["p"] for r in df.select(batches.citation_problem(F.col("t")).alias("p")).collect()] == list(c.values())


def test_members(spark):
    m = spark.createDataFrame([("z", n) for n in ["A/fig.jpg", "A/fig2.PNG", "b/fig.jpg", "b/other.tif", "c/dup.jpg", "d/dup.jpg"]], "archive string, member string")
    h = spark.createDataFrame([("z", 1, 0, "fig.jpg", "A/"), ("z", 2, 0, "fig2", "A/"), ("z", 3, 0, "x/other.gif", "A/"), ("z", 4, 0, "dup.jpg", "A/"), ("z", 4, 1, "fig", "A/"), ("z", 5, 0, "none.jpg", "A/")], "archive string, figure int, ordinal int, href string, folder string")
    r = merge.resolve_members(h, m)
    got = {(x["figure"], x["ordinal"]): (x["member"], x["rank"]) for x in r.collect()}
    assert got == {(1, 0): ("A/fig.jpg", 0), (2, 0): ("A/fig2.PNG", 1), (3, 0): ("b/other.tif", 5), (4, 0): (None, 4), (4, 1): ("A/fig.jpg", 1), (5, 0): (None, None)}
    first = {x["figure"]: x["member"] for x in merge.first_resolved(r).collect()}
    assert first == {1: "A/fig.jpg", 2: "A/fig2.PNG", 3: "b/other.tif", 4: "A/fig.jpg", 5: None}


def test_diagrams(spark):
    df = spark.createDataFrame([(0.5, 200), (0.51, 0), (0.5, 201), (None, None)], "white_ratio double, ocr_text_length long")
    assert [r["reason"] for r in merge.diagram_decision(df).collect()] == ["retained", "white_ratio", "ocr_text_length", "retained"]


def test_constraints(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert {tuple(r) for r in difference(a, b, "k").collect()} == {(1, "left"), (3, "right")}
    assert [tuple(r) for r in duplicates(a, "k").collect()] == [(1, 2)]
    assert changed_rows(a, a).count() == 0 and changed_rows(a, b).count() == 3
    require_none(a.limit(0), "nothing")
    try:
        require_none(a, "rows")
    except IntegrityError as e:
        assert "rows" in str(e)
    else:
        raise AssertionError
