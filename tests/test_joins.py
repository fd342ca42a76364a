import pytest

from casegrain.operators.joins import fits_broadcast, heavy_join, salted_join, small_join


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(spark, how):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(999, None)], "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k9", 3), ("zz", 4), (None, 5)], "k string, v int")
    plain = sorted(map(tuple, left.join(right, ["k"], how).collect()), key=repr)
    assert sorted(map(tuple, salted_join(left, right, ["k"], ["id"], how).collect()), key=repr) == plain


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_copies_are_not_broadcast(spark, tmp_path, how):
    spark.createDataFrame([(f"k{i}", i) for i in range(50)], "k string, v int").write.parquet(f"{tmp_path}/right")
    left, right = spark.createDataFrame([(i, f"k{i % 60}") for i in range(300)], "n int, k string"), spark.read.parquet(f"{tmp_path}/right")
    plain = sorted(map(str, left.join(right, ["k"], how).collect()))
    for out in (salted_join(left, right, ["k"], ["n"], how), small_join(left, right, ["k"], ["n"], how, most_bytes=1)):
        assert sorted(map(str, out.collect())) == plain
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_other_kinds_are_refused(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        salted_join(df, df, ["id"], ["id"], "full_outer")


def test_small_side_is_measured(spark):
    small = spark.createDataFrame([(i, f"k{i}", [str(i)]) for i in range(50)], "id int, k string, xs array<string>")
    assert fits_broadcast(small) and not fits_broadcast(small, most_rows=49) and not fits_broadcast(small, most_bytes=2000)
    left = spark.createDataFrame([(i, f"k{i % 60}") for i in range(300)], "n int, k string")
    plain = sorted(map(str, left.join(small, ["k"]).collect()))
    for most in (1, 1 << 20):
        assert sorted(map(str, small_join(left, small, ["k"], ["n"], most_bytes=most).collect())) == plain
    assert fits_broadcast(small.limit(0), 0, 0)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_by_broadcast(spark, how):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}", i % 7) for i in range(300)] + [(900 + i, None, 1) for i in range(200)], "id int, k string, v int")
    right = spark.createDataFrame([("hot", 1.5), ("k0", 2.5), ("k9", 3.5), ("zz", 4.5), (None, 5.5)], "k string, w double")
    plain = sorted(map(repr, left.join(right, ["k"], how).select("id", "k", "v", "w").collect()))
    out = heavy_join(left, right, ["k"], how, share=0.1, fewest=10)
    assert sorted(map(repr, out.select("id", "k", "v", "w").collect())) == plain
    assert sorted(map(repr, heavy_join(left, right, ["k"], how).select("id", "k", "v", "w").collect())) == plain
    assert "BroadcastHashJoin" in out._jdf.queryExecution().toString()


def test_a_kept_table_reports_its_rows(spark):
    from pyspark.sql import functions as F

    from casegrain.session import Tables

    store = Tables(spark, "test")
    df, seen = store.keep_with(spark.range(1000).repartition(7), "t", n=F.count(F.lit(1)), odd=F.sum(F.col("id") % 2))
    assert (seen["n"], seen["odd"]) == (1000, 500) and df.count() == 1000
    empty, seen = store.keep_with(spark.range(0), "e", n=F.count(F.lit(1)), odd=F.sum(F.col("id")))
    assert (seen["n"], seen["odd"], empty.count()) == (0, None, 0)
    store.drop(df, empty)
