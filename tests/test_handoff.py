import pytest
from pyspark.sql import functions as F

from casegrain.operators import batches, cohort, finalize, handoff
from casegrain.operators.constraints import IntegrityError, ResponseError, StageOrderError
from casegrain.sources import artifacts


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_first_reason_wins_and_null_does_not_hold(spark):
    df = spark.createDataFrame([(1, None, "old"), (2, 5, "old"), (3, 50, "old"), (4, 0, None)], "id int, n int, reason string")
    out = handoff.ordered_reason(df, {"big": F.col("n") > 9, "some": F.col("n") > 1, "never": F.lit(None).cast("boolean")})
    assert {r["id"]: r["reason"] for r in out.collect()} == {1: "eligible", 2: "some", 3: "big", 4: "eligible"}


def test_selected_subset(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    kept, bad = handoff.selected_subset(df, spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "k string"), "k")
    assert rows(kept) == [("a", 1), ("a", 2)] and rows(bad) == [("a", "duplicate"), ("c", "missing")]
    kept, bad = handoff.selected_subset(df, df.limit(0), "k")
    assert kept.count() == 0 and bad.count() == 0


CASES = [("1-1", "first"), ("2-1", None), ("3-1", "third")]
CAPTIONS = [("1-1", "b", "two"), ("1-1", "a", "one"), ("1-1", "a", "one"), ("2-1", "x", None), (None, "y", "?")]


def test_prompts(spark):
    cases, captions = spark.createDataFrame(CASES, "patient_uid string, case_description string"), spark.createDataFrame(CAPTIONS, "patient_uid string, caption_id string, caption string")
    pairs = spark.createDataFrame([(1, "1-1", "2-1", ["p", "q"]), (2, "3-1", "1-1", None), (3, "1-1", "9-9", []), (4, None, "1-1", [])], "pair_index int, case_a_uid string, case_b_uid string, paragraphs array<string>")
    got = {r["pair_index"]: r["content"] for r in handoff.assemble_prompts(pairs, cases, captions).collect()}
    assert got == {1: "CASE A\nfirst\na: one\nb: two\nCASE B\n\nx: \nCITATION\np\nq", 2: f"CASE A\nthird\n\nCASE B\nfirst\na: one\nb: two\nCITATION\n{handoff.NO_CITATION}"}
    prior = spark.createDataFrame([(2, "said")], "pair_index int, text string")
    assert {r["pair_index"]: r["content"].endswith("\nANSWER\nsaid") for r in handoff.assemble_prompts(pairs, cases, captions, prior).collect()} == {2: True}


def test_assembly(spark):
    cases = spark.createDataFrame([("1-1", "t", "stale"), ("2-1", "u", None)], "patient_uid string, title string, case_description string")
    summaries = spark.createDataFrame([("1-1", "d")], "patient_uid string, case_description string")
    classes = spark.createDataFrame([("1-1", "r", "human"), ("2-1", "r", "human")], "patient_uid string, ruleset string, label string")
    out = handoff.assemble_cases(cases, summaries, classes)
    assert [(r["patient_uid"], r["case_description"], r["population_scope"]["label"]) for r in out.collect()] == [("1-1", "d", "human")]
    pairs = spark.createDataFrame([(1, "1-1", "2-1"), (2, "1-1", "3-1"), (3, "2-1", "1-1")], "pair_index int, case_a_uid string, case_b_uid string")
    said = spark.createDataFrame([(1, "matched", "d", "1-1", "2-1", "doi", "r1"), (2, "matched", "d", "1-1", "3-1", "doi", "r1")], "pair_index int, status string, direction string, citing_uid string, cited_uid string, match_type string, ref_id string")
    assert [(r["pair_index"], r["citation"]["ref_id"]) for r in handoff.assemble_pairs(pairs, said, cases).collect()] == [(1, "r1")]


def stage(spark):
    prompts = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "pair_index int, content string")
    return handoff.build_stage(prompts, "label", "m", "be exact", most_bytes=10_000, most_requests=4)


def test_stages(spark):
    lines, shards = stage(spark)
    assert [(r["ordinal"], r["shard"], r["line_number"]) for r in shards.orderBy("ordinal").collect()] == [(0, 0, 1), (1, 0, 2), (2, 0, 3), (3, 0, 4), (4, 1, 1), (5, 1, 2)]
    prompts = spark.createDataFrame([(1, "x")], "pair_index int, content string")
    with pytest.raises(StageOrderError):
        handoff.build_stage(prompts, "next", "m", "d", prior_index=lines.where("ordinal <> 2"))
    handoff.build_stage(prompts, "next", "m", "d", prior_index=lines)
    responses = lines.where("pair_index < 4").select("custom_id", F.when(F.col("pair_index") > 0, "fine").alias("text"), F.when(F.col("pair_index") == 0, "error").alias("problem"))
    answers, bad = handoff.ingest_stage(lines, responses, lambda t: F.when(t == "bad", "fields"))
    assert answers.count() == 3 and sorted(r["problem"] for r in bad.collect()) == ["error", "missing", "missing"]
    with pytest.raises(ResponseError):
        handoff.accept(bad, "label")
    handoff.accept(bad.limit(0), "label")


def test_requests_against_their_index(spark):
    lines, _ = stage(spark)
    index = lines.select("ordinal", "custom_id", "pair_index", F.sha2(F.concat("line", F.lit("\n")), 256).alias("line_sha256"))
    good = lines.select("line")
    assert handoff.request_problems(good, index, "label").count() == 0
    damaged = lines.where("pair_index <> 0").select(F.when(F.col("pair_index") == 1, F.replace("line", F.lit("text"), F.lit("test"))).otherwise(F.col("line")).alias("line"))
    damaged = damaged.unionByName(lines.where("pair_index = 2").select("line"))
    bad = handoff.request_problems(damaged, index.where("pair_index <> 3"), "label").join(index.select("custom_id", "pair_index"), "custom_id")
    assert rows(bad.select("pair_index", "problem")) == [(0, "missing_line"), (1, "changed_line"), (1, "wrong_id"), (2, "repeated_line"), (3, "unindexed_line")]
    assert rows(handoff.request_problems(good, index, "other").select("problem").distinct()) == [("wrong_id",)]


def test_arrays_against_pairs(spark):
    pairs = finalize.positive_pairs(spark.createDataFrame([(["b", "a"], "CT", "liver", "cyst", 1), (["c", "d"], "CT", "liver", "cyst", 2)], "pair_id array<string>, modality string, anatomy string, diagnosis string, source_pair_index long"))
    arrays = finalize.bucket_arrays(pairs)
    assert handoff.array_problems(arrays, pairs).count() == 0
    short = arrays.withColumn("captions", F.slice("captions", 1, 1))
    assert ("unaligned", 1) in {(r["problem"], r["n"]) for r in handoff.array_problems(short, pairs).collect()}
    assert {(r["problem"], r["n"]) for r in handoff.array_problems(arrays, pairs.where("source_pair_index = 1")).collect()} == {("unknown_entry", 1)}
    assert {(r["problem"], r["n"]) for r in handoff.array_problems(arrays.limit(0), pairs).collect()} == {("missing_entry", 2)}


def test_order(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3), ("w", 4)], "k string, o int")
    b = spark.createDataFrame([("x", 1), ("z", 2), ("y", 3), ("v", 4), ("v", 5)], "k string, o int")
    assert rows(handoff.order_problems(a, b, "k", ["o"], ["o"])) == [("v", "only_right"), ("w", "only_left"), ("y", "moved"), ("z", "moved")]
    assert handoff.order_problems(a, a, "k", ["o"], ["o"]).count() == 0


def test_repair_audit(spark):
    kind = "id int, other string, t array<string>"
    before = spark.createDataFrame([(1, "a", ["x"]), (2, "a", []), (3, "a", None), (4, "a", ["x"]), (5, "a", ["x"]), (6, "a", []), (7, "a", [])], kind)
    after = spark.createDataFrame([(1, "a", ["x"]), (2, "a", ["n"]), (3, "a", None), (4, "a", ["y"]), (5, "a", []), (6, "b", ["n"]), (8, "a", [])], kind)
    got = {r["outcome"]: r["records"] for r in handoff.repair_audit(before, after, "id", "t").collect()}
    assert got == {"kept": 1, "filled": 1, "no_reliable_intext_marker_found": 1, "overwritten": 1, "emptied": 1, "other_field": 1, "lost": 1, "added": 1}
    assert set(handoff.BROKEN) < set(got)


def test_older_format(spark):
    c = spark.createDataFrame([(1, "1-2", "3-4", "doi", "r", ["p", "q"]), (2, None, None, None, None, None)], "pair_index int, citing_uid string, cited_uid string, match_type string, ref_id string, citation_paragraphs array<string>")
    assert rows(handoff.compatibility_view(c)) == [(1, "PMC1.nxml", "PMC3.nxml", "1_2", "3_4", "doi", "r", "p\n\nq"), (2, None, None, None, None, None, None, "")]


def test_whole_run(spark, tmp_path):
    root = tmp_path / "run"
    artifacts.write_json_lines(spark.range(3).toDF("i"), str(root / "t"), ["i"])
    m = artifacts.manifest(spark, str(root), {}, [])
    handoff.verify_run(spark, str(root), m, {"none": spark.range(0)})
    with pytest.raises(IntegrityError, match="some"):
        handoff.verify_run(spark, str(root), m, {"none": spark.range(0), "some": spark.range(2)})
    part = next((root / "t").glob("part*"))
    part.write_text("changed")
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(IntegrityError):
        handoff.verify_run(spark, str(root), m, {})


def test_uid_lists(spark):
    cells = {"['10-1', '2-1', \"PMC2_1\"]": ("ok", ["2-1", "10-1"]), '["3-2"]': ("ok", ["3-2"]), "('4-1',)": ("ok", ["4-1"]), "{'5-1'}": ("ok", ["5-1"]), "[]": ("ok", []), "": ("missing", []), " nan ": ("missing", []), None: ("missing", []), "{'a': 1}": ("not_a_list", []), "['x']": ("invalid_uids", []), "[1]": ("invalid_uids", []), "[": ("malformed", [])}
    df = spark.createDataFrame([(k,) for k in cells], "c string")
    assert {r["c"]: (r["u"]["status"], r["u"]["uids"]) for r in df.withColumn("u", cohort.uid_list(F.col("c"))).collect()} == cells


def test_listing_and_coverage(spark, tmp_path):
    counts = spark.createDataFrame([("m", "b", 5), ("m", "a", 5), ("m", "c", 90), ("d", "x", 1)], "field string, phrase string, n long")
    labels = spark.createDataFrame([("m", "a", ["other"]), ("m", "b", ["ct"]), ("m", "c", ["ct", "other"]), ("d", "x", ["y"])], "field string, phrase string, labels array<string>")
    assert rows(finalize.frequency_listing(counts)) == [("d", 1, "x", 1), ("m", 1, "c", 90), ("m", 2, "a", 5), ("m", 3, "b", 5)]
    unmatched = finalize.unmatched_phrases(counts, labels)
    assert rows(unmatched) == [("m", "a", 5)]
    cover = finalize.phrase_coverage(counts, unmatched)
    assert rows(cover) == [("d", 1, 1, 0, 0, 0.0, True), ("m", 3, 100, 1, 5, 5.0, False)]
    images = spark.createDataFrame([("i1", ["ct"])], "image_id string, m array<string>")
    (tmp_path / "out").mkdir()
    artifacts.write_label_outputs(images, labels, finalize.frequency_listing(unmatched), cover, str(tmp_path / "out"))
    assert (tmp_path / "out" / "unmatched.csv").read_text() == "field,position,phrase,n\nm,1,a,5\n" and '"within_limit": false' in (tmp_path / "out" / "summary.json").read_text()


def test_identifiers_of_any_length(spark):
    from casegrain.functions.keys import article_id, case_uid, ordered_pair

    long = "9" * 25
    df = spark.createDataFrame([(f"PMC{long}_2", f"{long}-10")], "a string, b string")
    r = df.select(case_uid(F.col("a")).alias("u"), article_id(F.lit("PMC000")).alias("z"), ordered_pair(F.col("b"), case_uid(F.col("a"))).alias("p")).first()
    assert r["u"] == f"{long}-2" and r["z"] == "0" and tuple(r["p"]) == (f"{long}-2", f"{long}-10")


def test_batches_of_runs_fail_on_a_long_line(spark):
    with pytest.raises(Exception, match="exceeds the limit"):
        batches.assign_shards(spark.createDataFrame([(0, 50), (1, 500)], "ordinal long, line_bytes long"), 100, 5).collect()
