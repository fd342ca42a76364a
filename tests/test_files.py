import io
import json
import tarfile
from datetime import datetime

import pytest
from pyspark.sql import types as T

from casegrain.operators.constraints import ConfigurationError, IntegrityError
from casegrain.session import Tables, spread, work_dir
from casegrain.sources import artifacts, files
from casegrain.streaming import ingest


def test_csv_keeps_text(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('patient_uid,note\n1-1,NA\n2-1,\n3-1,"a ""q"", b"\n4-1,007\n5-1,null\n')
    rows = files.read_text_csv(spark, files.single_source(str(p)), ["patient_uid"]).orderBy("csv_row").collect()
    assert [(r["csv_row"], r["note"]) for r in rows] == [(2, "NA"), (3, ""), (4, 'a "q", b'), (5, "007"), (6, "null")]
    typed = files.read_text_csv(spark, str(p), types={"note": T.IntegerType()}).orderBy("csv_row").collect()
    assert [r["note"] for r in typed] == [None, None, None, 7, None]
    with pytest.raises(ConfigurationError):
        files.read_text_csv(spark, str(p), ["absent"])
    with pytest.raises(ConfigurationError):
        files.single_source([str(p), str(p)])


S = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def test_json_lines(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1, "b": "x"}\n\n{"b": null, "a": 2}\n')
    assert [tuple(r) for r in files.read_json_lines(spark, str(p), S).orderBy("a").collect()] == [(1, "x"), (2, None)]
    for bad in ('{"a": 1}', '{"a": 1, "b": "x", "c": 2}', "[1]", "{", '{"a": 1, "b": "x", "a": 3}'):
        p.write_text(bad + "\n")
        with pytest.raises(IntegrityError):
            files.read_json_lines(spark, str(p), S)


def test_json_pairs(spark, tmp_path):
    p = tmp_path / "a.json"
    p.write_text(json.dumps([{"pair_id": ["x", "y"], "modality": "CT", "anatomy": "a", "diagnosis": "d"}]))
    assert files.read_json_pairs(spark, str(p)).first()["pair_index"] == 0
    p.write_text(json.dumps([{"pair_id": ["x"], "modality": "CT", "anatomy": "a", "diagnosis": "d"}]))
    with pytest.raises(IntegrityError):
        files.read_json_pairs(spark, str(p))


HOSTS = ("files.example",)


@pytest.mark.parametrize(
    ("xml", "problem"),
    [
        ("<OA><records><record id='PMC7'><link format='pdf' href='https://files.example/a.pdf'/><link format='tgz' href='https://files.example/d/a.tar.gz'/></record></records></OA>", None),
        ("<OA><records><record id='PMC8'><link format='tgz' href='https://files.example/a'/></record></records></OA>", "no_record"),
        ("<OA><records><record id='PMC7'><link format='tgz' href='https://evil.example/a'/></record></records></OA>", "host"),
        ("<OA><records><record id='PMC7'><link format='tgz' href='file:///a'/></record></records></OA>", "host"),
        ("<OA><records><record id='PMC7'><link format='tgz' href='x'/><link format='tgz' href='y'/></record></records></OA>", "several_links"),
        ("<OA><records><record id='PMC7'/></records></OA>", "no_link"), ("<OA>", "malformed"), (None, "missing"),
    ],
)
def test_package(xml, problem):
    got = files.package_link("PMC7", xml, HOSTS)
    assert got["problem"] == problem
    if not problem:
        assert (got["archive_name"], got["host"]) == ("a.tar.gz", "files.example")


def tar(members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for n, d in members.items():
            i = tarfile.TarInfo(n)
            i.size = len(d)
            t.addfile(i, io.BytesIO(d))
    return out.getvalue()


def test_archives(spark):
    data = tar({"A/x.nxml": b"<a/>", "A/b.JPG": b"1", "../escape.jpg": b"2", "A/readme.txt": b"3"})
    df = spark.createDataFrame([("one", bytearray(data)), ("two", bytearray(b"broken"))], "archive string, content binary")
    rows = files.archive_members(df).collect()
    assert [(r["archive"], r["member"]) for r in rows if not r["problem"]] == [("one", "A/b.JPG"), ("one", "A/x.nxml")]
    assert [r["archive"] for r in rows if r["problem"]] == ["two"]
    assert files.archive_members(df.where("archive = 'one'"), most_members=2).first()["problem"].startswith("ValueError")


def test_nxml_choice(spark):
    a = spark.createDataFrame([("p", "x.nxml", "PMC7", "7", 5), ("p", "y.nxml", "PMC7", "9", 50), ("q", "x.nxml", "PMC7", None, 5), ("r", "x.nxml", "PMC7", "8", 5), ("s", "x.nxml", "PMC7", "7", 1), ("s", "y.nxml", "PMC7", "7", 1)], "archive string, member string, pmc_id string, declared string, size long")
    m = spark.createDataFrame([(k,) for k in "pqrst"], "archive string")
    got = {r["archive"]: (r["member"], r["problem"]) for r in files.chosen_nxml(m, a).collect()}
    assert got == {"p": ("x.nxml", None), "q": ("x.nxml", None), "r": (None, "mismatch"), "s": (None, "several"), "t": (None, "missing")}


def test_caches_and_fetch(spark, tmp_path):
    (tmp_path / "7.xml").write_text("bare")
    (tmp_path / "PMC7.xml").write_text("long")
    (tmp_path / "PMC8.xml").write_text("eight")
    got = {r["pmc_id"]: bytes(r["content"]).decode() for r in files.cached_responses(spark, str(tmp_path)).collect()}
    assert got == {"PMC7": "bare", "PMC8": "eight"}

    def fetch(i):
        if i == "bad":
            raise OSError("down")
        return None if i == "none" else i.encode()

    ids = spark.createDataFrame([("a",), ("bad",), ("none",), ("a",)], "pmc_id string")
    assert {r["pmc_id"]: r["problem"] for r in files.fetched(ids, fetch).collect()} == {"a": None, "bad": "OSError: down", "none": "missing"}


def test_canonical_lines_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(2, {"z": 1, "a": None}, ["x"]), (1, None, [])], T.StructType([T.StructField("n", T.IntegerType()), T.StructField("b", T.StructType([T.StructField("z", T.IntegerType()), T.StructField("a", T.StringType())])), T.StructField("a", T.ArrayType(T.StringType()))]))
    out = tmp_path / "run" / "t"
    artifacts.write_json_lines(df, str(out), ["n"], single=True)
    text = "".join(p.read_text() for p in sorted(out.glob("part-*")))
    assert text == '{"a":[],"b":null,"n":1}\n{"a":["x"],"b":{"a":null,"z":1},"n":2}\n'
    with pytest.raises(ConfigurationError):
        artifacts.write_json_lines(df, str(out), ["n"])
    m = artifacts.manifest(spark, str(tmp_path / "run"), {"x": 1}, [])
    artifacts.verify_manifest(spark, str(tmp_path / "run"), m)
    before = artifacts.tree_hash(artifacts.file_hashes(spark, str(tmp_path / "run")))
    for p in out.glob(".*.crc"):
        p.unlink()
    next(out.glob("part-*")).write_text(text + " ")
    with pytest.raises(IntegrityError):
        artifacts.verify_manifest(spark, str(tmp_path / "run"), m)
    assert artifacts.tree_hash(artifacts.file_hashes(spark, str(tmp_path / "run"))) != before
    many = spark.range(9000).selectExpr("id AS n", "-id AS m")
    assert artifacts.row_digest(many, ["n"]) == artifacts.row_digest(many.repartition(7), ["n"]) != artifacts.row_digest(many, ["m"])


def test_driver_sinks(spark, tmp_path):
    artifacts.write_once(str(tmp_path / "r.json"), {"a": 1})
    artifacts.write_once(str(tmp_path / "r.json"), {"a": 1})
    with pytest.raises(IntegrityError):
        artifacts.write_once(str(tmp_path / "r.json"), {"a": 2})
    artifacts.write_csv(spark.createDataFrame([(2, "x"), (1, None)], "a int, b string"), str(tmp_path / "t.csv"), ["a"])
    assert (tmp_path / "t.csv").read_text() == "a,b\n1,\n2,x\n"
    with artifacts.run_lock(str(tmp_path / "lock")), pytest.raises(ConfigurationError):
        with artifacts.run_lock(str(tmp_path / "lock")):
            pass
    with pytest.raises(RuntimeError):
        with artifacts.publishing(str(tmp_path / "new")):
            raise RuntimeError
    assert not (tmp_path / "new").exists() and not list(tmp_path.glob(".new*"))
    f = spark.createDataFrame([("PMC1/1_1", "1_1_1", bytearray(b"i"), "c")], "folder string, name string, image binary, caption string")
    assert [r["written"] for r in artifacts.write_assets(f, str(tmp_path / "assets")).collect()] == [True]
    assert [r["written"] for r in artifacts.write_assets(f, str(tmp_path / "assets")).collect()] == [False]


def test_stream_merges_batches(spark, tmp_path):
    schema = "patient_uid string, csv_row long, seen timestamp"
    src, target = tmp_path / "in", str(tmp_path / "out")
    for rows in ([("1-1", 1, datetime(2024, 1, 1)), ("bad", 2, None)], [("PMC1_1", 5, datetime(2024, 2, 1)), ("2-1", 4, datetime(2024, 2, 2))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        s = ingest.patient_stream(spark, str(src), spark.read.parquet(str(src)).schema, 1).select("uid", "csv_row")
        ingest.merge_latest(s, target, "uid", "csv_row", str(tmp_path / "cp")).awaitTermination()
    assert {tuple(r) for r in ingest.latest(spark, target).collect()} == {("1-1", 5), ("2-1", 4)}
    m = ingest.monthly_arrivals(spark.readStream.schema(schema).parquet(str(src)), "seen")
    q = m.writeStream.outputMode("complete").format("memory").queryName("arrivals").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(rows) from arrivals").first()[0] == 3
    w = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    todo = ingest.outstanding(w, w.where("k = 'a'"), w.where("k <> 'c'"), "k")
    assert {tuple(r) for r in todo.collect()} == {("b", True), ("c", False)}


def test_late_rows_are_counted_in_their_month(spark, tmp_path):
    src, schema, last = str(tmp_path / "in"), "seen timestamp", {}
    for days in ([datetime(2024, 8, 1), datetime(2024, 8, 31)], [datetime(2024, 9, 1)], [datetime(2024, 1, 31), datetime(2024, 8, 2), None]):
        spark.createDataFrame([(d,) for d in days], schema).coalesce(1).write.mode("append").parquet(src)
        m = ingest.monthly_arrivals(spark.readStream.schema(schema).parquet(src), "seen")
        w = m.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
        w.foreachBatch(lambda b, n: last.update({r["start"]: r["rows"] for r in b.collect()})).trigger(availableNow=True).start().awaitTermination()
    assert last == {datetime(2024, 1, 1): 1, datetime(2024, 8, 1): 3, datetime(2024, 9, 1): 1}


def test_tables_and_spread(spark):
    assert work_dir(spark)
    t = Tables(spark, "x")
    df = t.keep(spark.range(5).toDF("i"))
    assert df.count() == 5
    t.drop(df)
    assert spread(spark.range(10).toDF("i").coalesce(1), "i").rdd.getNumPartitions() == 16


def test_settings_and_small_inputs(spark, tmp_path):
    from casegrain.sources import config

    p = tmp_path / "c.toml"
    p.write_text("most_white = 1\nlimit = 5\n")
    assert config.load_settings(str(p)).limit == 5
    for bad in ("nope = 1", "most_text = true", "most_white = 2.0", "limit = -1", 'most_text = "x"'):
        p.write_text(bad)
        with pytest.raises(ConfigurationError):
            config.load_settings(str(p))
    a = tmp_path / "a.jsonl"
    good = {"patient_uid": "1-1", "label": "human", "reason": "seen"}
    a.write_text(json.dumps(good) + "\n")
    assert config.load_adjudications(spark, str(a)).count() == 1
    for bad in (good | {"label": "x"}, good | {"reason": " "}, good | {"reason": " x"}):
        a.write_text(json.dumps(bad) + "\n")
        with pytest.raises(IntegrityError):
            config.load_adjudications(spark, str(a))
    a.write_text((json.dumps(good) + "\n") * 2)
    with pytest.raises(IntegrityError):
        config.load_adjudications(spark, str(a))
    with pytest.raises(ConfigurationError):
        config.require_apart(str(tmp_path / "x"), str(tmp_path))
    config.require_apart(str(tmp_path / "x"), str(tmp_path / "y"))
    (tmp_path / ".run-abc").mkdir()
    assert config.clear_stale(str(tmp_path), "run") == [".run-abc"]
    df = spark.range(10).toDF("i")
    assert [r["i"] for r in config.first_n(df, 3, "i").collect()] == [0, 1, 2] and config.first_n(df, None).count() == 10
    with pytest.raises(ConfigurationError):
        config.first_n(df, -1, "i")


def test_shard_files_and_snapshot(spark, tmp_path):
    from pyspark.sql import functions as F

    from casegrain.operators import batches

    df = spark.createDataFrame([(i, f"u{i}") for i in range(40)], "k long, u string")
    body = batches.request_body("m", F.lit("be exact"), F.col("u"))
    lines = batches.request_lines(df.withColumn("body", body), "citation", ["k"])
    assert json.loads(lines.first()["body"]).keys() == {"messages", "model"}
    index = batches.write_shards(lines, batches.assign_shards(lines, 10**6, 15), str(tmp_path / "out"))
    files_made = sorted((tmp_path / "out/shards").glob("shard=*/*.txt"))
    text = [[json.loads(x)["custom_id"] for x in f.read_text().splitlines()] for f in files_made]
    assert [len(t) for t in text] == [15, 15, 10] and sum(text, []) == [r["custom_id"] for r in index.orderBy("ordinal").collect()]
    kept = artifacts.snapshot([str(f) for f in files_made], str(tmp_path / "raw"))
    assert artifacts.snapshot([str(f) for f in reversed(files_made)], str(tmp_path / "raw")) == kept
