"""Groups of records linked directly or through others (problem 4).

Method: minimum labels are propagated across edges and accelerated with pointer jumping; every round is written to the
shared folder, and rounds end when no label changes any more.

A round over the edges left: each vertex takes the least label among itself and its neighbours (a minimum, combined
before the shuffle, so a vertex with a third of all edges costs one row per map task). Vertices with a lesser neighbour
now point to it; pointers only lead to lesser labels, so they form trees. Pointer jumping replaces every pointer by the
pointer's pointer until all lead to a root: log(depth) joins. Edges are then rewritten to roots, and loops and repeats
drop out; what is left connects roots only, at most half of the vertices of the round. Rounds are therefore
logarithmic in the number of vertices, and all their work shrinks geometrically.

Joins on a label that many rows share (``heavy_share`` of all) would send them to one task: such labels, at most
``1 / heavy_share``, are looked up in a broadcast table instead, and their rows are spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrain.session import Tables

HEAVY_SHARE = 0.005
FEWEST = 100_000  # rows of one label that a task takes without trouble


def follow(rows: DataFrame, n: int, column: str, spread: str, pointers: DataFrame, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """``rows`` with ``column`` replaced by its pointer, or itself where ``pointers`` (x, p) has none; skew-safe.

    ``n`` is the number of rows; ``spread`` names a column of ``rows`` that is far from constant among hot rows.
    """
    spark = rows.sparkSession
    least = max(FEWEST, int(heavy_share * n))
    hot: list[str] = []
    if n > least:
        sizes = rows.groupBy(F.col(column).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        hot = [r["k"] for r in sizes.where(F.col("n") > least).select("k").collect()]
    right = pointers.select(F.col("x").alias("__x"), F.col("p").alias("__p"))
    if not hot:
        j = rows.join(right, F.col(column) == F.col("__x"), "left")
        return j.withColumn(column, F.coalesce("__p", column)).select(*rows.columns)
    known = {r["__x"]: r["__p"] for r in right.where(F.col("__x").isin(hot)).collect()}
    small = spark.createDataFrame([(k, known.get(k, k)) for k in hot], "__k string, __h string")
    j = rows.join(F.broadcast(small), F.col(column) == F.col("__k"), "left")
    j = j.withColumn("__at", F.when(F.col("__k").isNotNull(), F.concat(F.lit("\0"), F.col(spread))).otherwise(F.col(column)))
    j = j.join(right, F.col("__at") == F.col("__x"), "left")
    return j.withColumn(column, F.coalesce("__h", "__p", column)).select(*rows.columns)


def _edges(df: DataFrame) -> DataFrame:
    e = df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return e.where(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """(member, group_id): every non-null ``a`` or ``b`` of ``links``, with the least member of its group.

    Order is plain character order (of UTF-8 bytes). A row that lacks one end links nothing but its other end is a member;
    loops, repeated and reversed rows count once; an empty input gives no rows. Other columns of ``links`` are ignored.
    """
    spark = links.sparkSession
    store = Tables(spark, "components")
    links = links.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"))
    rows = {"n": F.count(F.lit(1))}
    edges, seen = store.keep_with(_edges(links), "edges", **rows)
    left = seen["n"]
    forests: list[tuple[DataFrame, int]] = []
    while left:
        both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("e"))
        least = both.select("e.x", "e.y").groupBy("x").agg(F.min("y").alias("p"))
        points, seen = store.keep_with(least.where(F.col("p") < F.col("x")), "points", **rows)
        n = seen["n"]
        while True:
            jumped = follow(points.withColumn("was", F.col("p")), n, "p", "x", points, heavy_share)
            jumped, seen = store.keep_with(jumped, "jumped", changed=F.sum((F.col("p") != F.col("was")).cast("int")))
            store.drop(points)
            points = jumped.select("x", "p")
            points.casegrain_path = jumped.casegrain_path
            if not seen["changed"]:
                break
        forests.append((points, n))
        half = follow(edges, left, "a", "b", points, heavy_share)
        moved, seen = store.keep_with(_edges(follow(half, left, "b", "a", points, heavy_share)), "edges", **rows)
        store.drop(edges)
        edges, left = moved, seen["n"]
    store.drop(edges)
    roots = None
    for points, n in reversed(forests):
        if roots is None:
            roots = points
        else:
            lifted = follow(points, n, "p", "x", roots, heavy_share)
            lower = roots
            roots = store.keep(lifted.unionByName(lower), "roots")
            store.drop(lower, points)
    members = links.select(F.explode(F.array("a", "b")).alias("member")).where(F.col("member").isNotNull()).distinct()
    if roots is None:
        return members.withColumn("group_id", F.col("member"))
    known = roots.select(F.col("x").alias("__m"), F.col("p").alias("__g"))
    return members.join(known, F.col("member") == F.col("__m"), "left").select("member", F.coalesce("__g", "member").alias("group_id"))
