from datetime import datetime

from pyspark.sql import functions as F

from casegrain.operators.references import heavy_keys, orphan_counts, orphan_references, orphan_report, target_state

T = "k string, recorded_at timestamp, withdrawn_at timestamp"
REF = "id long, k string, seen timestamp, recorded_at string"  # a column whose name clashes with the target's


def day(n):
    return datetime(2024, 1, 1 + n)


def orphans(spark, refs, targets, **kw):
    out = orphan_references(spark.createDataFrame(refs, REF), spark.createDataFrame(targets, T), [("k", "k")], "seen", **kw)
    return {(r["id"], r["reason"]) for r in out.collect()}, out


def test_reasons_and_ties(spark):
    targets = [("a", day(1), None), ("a", day(3), day(3)), ("b", day(1), day(1)), ("b", day(2), None), ("c", day(5), None), ("d", day(2), None), ("d", day(2), day(2)), ("e", None, None), (None, day(1), None)]
    refs = [(1, "a", day(4), "x"), (2, "b", day(4), "x"), (3, "c", day(4), "x"), (4, "d", day(4), "x"), (5, "zz", day(4), None), (6, None, day(4), "x"), (7, "c", None, "x"), (8, "e", day(1), ""), (9, "c", day(5), "x")]
    got, out = orphans(spark, refs, targets)
    # same instant: withdrawn wins (4); a reference without a date is never too early (7); a target without one exists (8)
    assert got == {(1, "withdrawn"), (3, "later"), (4, "withdrawn"), (5, "absent"), (6, "absent")}
    assert out.columns == ["id", "k", "seen", "recorded_at", "reason"]


def test_empty_sides(spark):
    assert orphans(spark, [], [("a", day(1), None)])[0] == set()
    assert orphans(spark, [(1, "a", day(1), None)], [])[0] == {(1, "absent")}


def test_heavy_keys_give_the_same_result(spark):
    refs = [(i, "hot" if i % 3 else f"k{i}", day(i % 20), None) for i in range(900)] + [(1000 + i, None, day(2), None) for i in range(300)]
    targets = [("hot", day(10), None)] + [(f"k{i}", day(i % 7), day(8) if i % 5 == 0 else None) for i in range(0, 900, 6)]
    assert {r["k"] for r in heavy_keys(spark.createDataFrame(refs, REF), ["k"], 0.1)} == {"hot", None}
    split, out = orphans(spark, refs, targets, heavy_share=0.1)
    whole, _ = orphans(spark, refs, targets, heavy_share=1.0)
    state = {}
    for k, seen, gone in targets:
        state[k] = (min(seen, state.get(k, (seen,))[0]), gone is not None)
    want = {(i, "absent" if k not in state else "withdrawn" if state[k][1] else "later") for i, k, s, _ in refs if k not in state or state[k][1] or state[k][0] > s}
    assert split == whole == want
    assert "BroadcastHashJoin" in out._jdf.queryExecution().toString()


def test_counts_ignore_duplicates(spark):
    rows = [("t", "c", "2024-01", "absent", "1")] * 3 + [("t", "c", "2024-01", "absent", "2")]
    df = spark.createDataFrame(rows, "source_table string, source_column string, period string, reason string, source_key string")
    assert [r["orphans"] for r in orphan_counts(df).collect()] == [2]


def test_state_of_composite_keys(spark):
    df = spark.createDataFrame([("1", "a", day(1), None), ("1", "b", day(2), day(2)), ("1", None, day(1), None)], "x string, y string, recorded_at timestamp, withdrawn_at timestamp")
    got = {(r["__t0"], r["__t1"], r["is_withdrawn"]) for r in target_state(df, ["x", "y"]).collect()}
    assert got == {("1", "a", False), ("1", "b", True)}
    assert target_state(df.where(F.lit(False)), ["x", "y"]).count() == 0


def test_report_is_the_count_of_the_rows(spark):
    refs = [(i, "hot" if i % 3 else f"k{i}", day(i % 20), "t") for i in range(900)] + [(1000 + i, None, day(2), "t") for i in range(30)] + [(7, "k7", None, "t"), (8, "hot", day(3), "u")]
    refs += refs[:100]
    targets = [("hot", day(10), None)] + [(f"k{i}", day(i % 7), day(8) if i % 5 == 0 else None) for i in range(0, 900, 6)]
    r, t = spark.createDataFrame(refs, "id long, k string, seen timestamp, label string"), spark.createDataFrame(targets, T)
    rows = orphan_references(r, t, [("k", "k")], "seen").withColumn("period", F.date_format("seen", "yyyy-MM"))
    want = {tuple(x) for x in rows.groupBy("label", "period", "reason").agg(F.countDistinct("id").alias("n")).collect()}
    for share in (0.1, 1.0):
        out = orphan_report(r, t, [("k", "k")], ["label"], "id", "seen", heavy_share=share)
        assert {(x["label"], x["period"], x["reason"], x["orphans"]) for x in out.collect()} == want and len(want) == 5
    assert orphan_report(r.limit(0), t, [("k", "k")], ["label"], "id", "seen").count() == 0
    assert {x["reason"] for x in orphan_report(r, t.limit(0), [("k", "k")], ["label"], "id", "seen").collect()} == {"absent"}
