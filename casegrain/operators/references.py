"""References to records that are absent, withdrawn or later than the reference (problem 3).

Method: references are pre-aggregated per key to find heavy keys; a key counts as heavy when it holds more than
``heavy_share`` of all references, so there are at most ``1 / heavy_share`` of them whatever the input. The target state
of heavy keys is therefore small enough to broadcast, which keeps a key with a third of all rows out of the shuffle;
all other keys meet their targets in a shuffled outer (anti) join, and both results are united. ``orphan_references`` gives
the referring rows; ``orphan_report`` counts per key and period before the joins and unites the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAVY_SHARE = 0.002
FEWEST = 64  # a key with fewer rows is never worth a broadcast
LOWEST = -(2**62)


def target_state(targets: DataFrame, keys: list[str], recorded: str = "recorded_at", withdrawn: str = "withdrawn_at") -> DataFrame:
    """One row per key: ``first_seen`` (earliest arrival) and ``is_withdrawn`` (state of the row that arrived last).

    Row versions that arrived at the same instant: the key is withdrawn if one of them says so. A row without an
    arrival time exists, but neither dates the key nor outranks a dated row. Rows with a null key part are ignored.
    """
    known = targets
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    gone = F.col(withdrawn).isNotNull().cast("long")
    stamp = F.coalesce(F.unix_micros(F.col(recorded).cast("timestamp")), F.lit(LOWEST)) * 2 + gone
    return known.groupBy(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(keys)]).agg(
        F.min(recorded).alias("first_seen"), (F.pmod(F.max(stamp), F.lit(2)) == 1).alias("is_withdrawn")
    )


def heavy_keys(refs: DataFrame, keys: list[str], share: float = HEAVY_SHARE, weight: Column | None = None, fewest: int = FEWEST) -> list:
    """Keys that hold more than ``share`` of all rows (or of all ``weight``); at most ``1 / share`` rows reach the driver."""
    weight = F.lit(1) if weight is None else weight
    sizes = refs.groupBy(*keys).agg(F.sum(weight).alias("n"))
    total = refs.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first()["n"]
    return sizes.where((F.col("n") >= fewest) & (F.col("n") > F.lit(share * total))).collect()


def orphan_references(
    refs: DataFrame,
    targets: DataFrame,
    keys: list[tuple[str, str]],
    ref_recorded: str = "recorded_at",
    target_recorded: str = "recorded_at",
    target_withdrawn: str = "withdrawn_at",
    heavy_share: float = HEAVY_SHARE,
) -> DataFrame:
    """The rows of ``refs`` whose record is missing, with a column ``reason`` (absent, withdrawn, later).

    ``keys`` pairs each key column of ``refs`` with that of ``targets``. A null in a key part of the reference matches
    nothing, so such a row is absent; drop rows without a reference before. A reference without an arrival time cannot be
    earlier than its target. Row multiplicity is kept; extra columns pass through; an empty ``targets`` makes all absent.
    """
    spark = refs.sparkSession
    rk, tk = [r for r, _ in keys], [t for _, t in keys]
    state = target_state(targets, tk, target_recorded, target_withdrawn)
    heavy = heavy_keys(refs, rk, heavy_share)
    names = [f"__t{i}" for i in range(len(keys))]

    def judged(part: DataFrame, known: DataFrame) -> DataFrame:
        on: Column = F.lit(True)
        for r, t in zip(rk, names, strict=True):
            on = on & (F.col(r) == F.col(t))
        j = part.join(known, on, "left")
        why = (
            F.when(F.col(names[0]).isNull(), "absent")
            .when(F.col("is_withdrawn"), "withdrawn")
            .when(F.col("first_seen") > F.col(ref_recorded), "later")
        )
        return j.select(*[part[c] for c in part.columns], why.alias("reason")).where(F.col("reason").isNotNull())

    if not heavy:
        return judged(refs, state)
    schema = T.StructType([T.StructField(n, refs.schema[r].dataType) for n, r in zip(names, rk, strict=True)])
    hot = spark.createDataFrame([tuple(h[k] for k in rk) for h in heavy], schema)
    hot_state = state.join(F.broadcast(hot), names, "left_semi")
    hit: Column = F.lit(True)
    for r, t in zip(rk, names, strict=True):
        hit = hit & F.col(r).eqNullSafe(F.col(t))
    hot_refs = refs.join(F.broadcast(hot), hit, "left_semi")
    cold_refs = refs.join(F.broadcast(hot), hit, "left_anti")
    return judged(hot_refs, F.broadcast(hot_state)).unionByName(judged(cold_refs, state))


def orphan_report(
    refs: DataFrame,
    targets: DataFrame,
    keys: list[tuple[str, str]],
    labels: list[str],
    source_key: str = "source_key",
    ref_recorded: str = "recorded_at",
    period: str = "yyyy-MM",
    target_recorded: str = "recorded_at",
    target_withdrawn: str = "withdrawn_at",
    heavy_share: float = HEAVY_SHARE,
) -> DataFrame:
    """(labels, period, reason, orphans): distinct ``source_key`` per period whose record is missing.

    References are first added up per key and period with the first and last arrival, so a hot key is a few rows before any
    join; heavy keys are checked against a broadcast of their targets, the rest in a shuffled outer join, and both counts are
    united. Only groups in whose span of arrivals the target itself appeared are counted row by row. Nulls as in
    ``orphan_references``; an absent date falls in no period (null) and is never too early.
    """
    spark = refs.sparkSession
    rk, tk = [r for r, _ in keys], [t for _, t in keys]
    state = target_state(targets, tk, target_recorded, target_withdrawn)
    names = [f"__t{i}" for i in range(len(keys))]
    month = F.date_format(ref_recorded, period).alias("period")
    single = refs.select(*labels, *rk, source_key, month, F.col(ref_recorded).alias("__at"))
    one = single.groupBy(*labels, *rk, "period", source_key).agg(F.min("__at").alias("lo"), F.max("__at").alias("hi"))
    groups = one.groupBy(*labels, *rk, "period").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def on(part: DataFrame, known: DataFrame) -> DataFrame:
        c: Column = F.lit(True)
        for r, t in zip(rk, names, strict=True):
            c = c & (F.col(r) == F.col(t))
        return part.join(known, c, "left")

    def judged(part: DataFrame, known: DataFrame) -> DataFrame:
        why = (
            F.when(F.col(names[0]).isNull(), "absent").when(F.col("is_withdrawn"), "withdrawn").when(F.col("first_seen") > F.col("hi"), "later").when(F.col("first_seen") > F.col("lo"), "straddled")
        )
        return on(part, known).withColumn("reason", why).where(F.col("reason").isNotNull()).select(*labels, *rk, "period", "n", "first_seen", "reason")

    heavy = heavy_keys(groups, rk, heavy_share, F.col("n"))
    if heavy:
        schema = T.StructType([T.StructField(n, refs.schema[r].dataType) for n, r in zip(names, rk, strict=True)])
        hot = F.broadcast(spark.createDataFrame([tuple(h[k] for k in rk) for h in heavy], schema))
        hit: Column = F.lit(True)
        for r, t in zip(rk, names, strict=True):
            hit = hit & F.col(r).eqNullSafe(F.col(t))
        found = judged(groups.join(hot, hit, "left_semi"), F.broadcast(state.join(hot, names, "left_semi"))).unionByName(judged(groups.join(hot, hit, "left_anti"), state))
    else:
        found = judged(groups, state)
    whole = found.where("reason <> 'straddled'").groupBy(*labels, "period", "reason").agg(F.sum("n").alias("orphans"))
    part = found.where("reason = 'straddled'").select(*labels, *rk, "period", "first_seen")
    rows = single.join(part, [*labels, *rk, "period"]).where(F.col("first_seen") > F.col("__at"))
    rows = rows.select(*labels, *rk, "period", source_key).distinct().groupBy(*labels, "period", F.lit("later").alias("reason")).agg(F.count(F.lit(1)).alias("orphans"))
    return whole.unionByName(rows).groupBy(*labels, "period", "reason").agg(F.sum("orphans").alias("orphans"))


def orphan_counts(orphans: DataFrame, table: str = "source_table", column: str = "source_column", period: str = "period") -> DataFrame:
    """Orphans per table, column, month and reason; duplicate rows count once."""
    cols = [table, column, period, "reason"]
    return orphans.groupBy(*cols, "source_key").agg(F.lit(1).alias("one")).groupBy(*cols).agg(F.count("one").alias("orphans"))
