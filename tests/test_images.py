import numpy as np
import pytest
from pyspark.sql import functions as F

from casegrain.operators import finalize, merge
from casegrain.operators.constraints import IntegrityError
from casegrain.sources import files, images


def pgm(a):
    return b"P5 %d %d 255\n" % (a.shape[1], a.shape[0]) + a.astype(np.uint8).tobytes()


def decode(data):
    head, _, rest = data.partition(b"\n")
    kind, w, h, _ = head.split()
    if kind != b"P5":
        raise ValueError("no image")
    return np.frombuffer(rest, np.uint8).reshape(int(h), int(w))


def test_white_ratio():
    a = np.zeros((10, 10))
    a[:5] = 255
    assert images.white_ratio(a) == 0.5
    a[5, 0] = 250
    assert images.white_ratio(a) == 0.51
    big = np.zeros((768, 384))
    big[:384] = 255
    assert images.white_ratio(big) == 0.5
    clear = np.zeros((4, 4, 4))  # all transparent: white
    assert images.white_ratio(clear) == 1.0
    odd = np.random.default_rng(1).integers(0, 256, (500, 37)).astype(float)
    assert images._averaged(odd, 384).mean() == pytest.approx(odd.mean())


def test_measures_and_forms_in_spark(spark):
    a = np.zeros((10, 10))
    a[:5, :] = 255
    df = spark.createDataFrame([("a", bytearray(pgm(a))), ("b", bytearray(b"junk")), ("c", None), ("d", bytearray(pgm(np.zeros((0, 3)))))], "image_path string, content binary")
    got = {r["image_path"]: (r["white_ratio"], r["ocr_text_length"], r["problem"]) for r in images.image_measures(df, decode, lambda b: "x" * 201).collect()}
    assert got["a"] == (0.5, 201, None) and all(got[k][0] is None and got[k][2] for k in "bcd")
    assert merge.diagram_decision(images.image_measures(df.where("image_path = 'a'"), decode, lambda b: "x" * 201)).first()["reason"] == "ocr_text_length"
    out = {r["image_path"]: r for r in images.canonical_images(df, decode, lambda x: x.tobytes()).collect()}
    assert out["a"]["image"] == np.repeat(a.astype(np.uint8)[:, :, None], 3, axis=2).tobytes() and len(out["a"]["image_sha256"]) == 64 and out["b"]["image"] is None and out["b"]["problem"]


def test_reader_contract(tmp_path):
    (tmp_path / "data").write_text("x")
    said = images.reader_contract(lambda: "5.3\n", {"data": str(tmp_path / "data")})
    images.verify_contract(said, lambda: "5.3", {"data": str(tmp_path / "data")})
    (tmp_path / "data").write_text("y")
    with pytest.raises(IntegrityError, match="files"):
        images.verify_contract(said, lambda: "5.3", {"data": str(tmp_path / "data")})


def test_fetching_stops_at_final_errors(spark, tmp_path):
    log = tmp_path / "log"

    def fetch(i):
        with open(log, "a") as f:
            f.write(i + "\n")
        if i == "big":
            return b"x" * 100
        e = OSError(i)
        e.code = int(i)
        raise e

    got = {r["pmc_id"]: r["problem"] for r in files.fetched(spark.createDataFrame([("404",), ("429",), ("big",)], "pmc_id string"), fetch, most_bytes=50).collect()}
    assert got["big"] == "too_large" and got["404"].startswith("OSError") and got["429"].startswith("OSError")
    tried = log.read_text().split()
    assert (tried.count("404"), tried.count("429"), tried.count("big")) == (1, 3, 1)


def test_checked_articles(spark):
    sha = spark.range(1).select(F.sha2(F.lit("text"), 256)).first()[0]
    records = [("1-1", "new_data/a.nxml", sha.upper()), ("2-1", "new_data/b.nxml", sha), ("3-1", "new_data/c.nxml", sha), ("4-1", "../a.nxml", sha), ("5-1", "other/a.nxml", sha), ("6-1", None, sha), ("7-1", "new_data/a.xml", sha), ("8-1", "new_data/a.nxml", None)]
    made = spark.createDataFrame([("new_data/a.nxml", bytearray(b"text")), ("new_data/b.nxml", bytearray(b"test"))], "path string, content binary")
    got = {r["patient_uid"]: (r["content"] is not None, r["problem"]) for r in files.checked_articles(spark.createDataFrame(records, "patient_uid string, nxml_path string, nxml_sha256 string"), made).collect()}
    assert got == {"1-1": (True, None), "2-1": (False, "changed"), "3-1": (False, "missing"), **{f"{i}-1": (False, "bad_path") for i in (4, 5, 6, 7)}, "8-1": (False, "changed")}


def test_manifest_and_stats(spark):
    f = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4)], "image_path string, v int")
    assert [tuple(r) for r in merge.manifest_images(f).orderBy("ordinal").collect()] == [("a", 0, 1), ("b", 1, 2)]
    d = spark.createDataFrame([("a", True), ("b", False)], "image_path string, is_diagram boolean")
    assert sorted(r["v"] for r in merge.drop_diagrams(f, d).collect()) == [1, 3, 4]
    labels = spark.createDataFrame([("human",), ("animal",), (None,)], "label string")
    assert tuple(finalize.partition_stats(labels, "label", ["human", "animal"]).first()) == (3, 1, 1, False)
    pairs = spark.createDataFrame([(["b", "a"], "m", "x", "d", 1), (["a", "b"], "m2", "x", "d", 2), (["a", "a"], "m", "x", "d", 3), (["a"], " ", "x", "d", 4)], "pair_id array<string>, modality string, anatomy string, diagnosis string, source_pair_index long")
    assert {r["stat"]: r["n"] for r in finalize.labelling_stats(pairs).collect()} == {"records": 4, "two_images": 2, "all_labels": 3, "valid": 2, "final": 1, "repeats_removed": 1}
    assert {r["stat"]: r["n"] for r in finalize.labelling_stats(pairs.limit(0)).collect()} == dict.fromkeys(["records", "two_images", "all_labels", "valid", "final", "repeats_removed"], 0)
