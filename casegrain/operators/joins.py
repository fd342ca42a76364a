"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrain.operators.references import heavy_keys

SALTS = 16
BROADCAST_BYTES = 32 << 20  # of values as text; a hash table of them takes a few times that
BROADCAST_ROWS = 500_000


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``left`` joined with the much smaller ``right``; rows of one key are spread over ``salts`` tasks by ``spread_by``.

    Each row of ``right`` is copied once per salt, so a key with a third of all rows of ``left`` puts about 1/48 of them into a
    task. For inner, left, left_semi and left_anti joins; null keys match nothing, as in any equi-join.

    Both sides are always sorted and merged: Spark takes the copies for no larger than ``right`` itself, so by its own choice it
    would send ``salts`` times its broadcast threshold, as compressed in files, through the driver.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how}")
    a = left.withColumn("__salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    b = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b.hint("merge"), [*keys, "__salt"], how).drop("__salt")


def heavy_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", share: float = 0.005, fewest: int = 100_000) -> DataFrame:
    """``left`` joined (inner or left) with ``right``, which has at most one row per key.

    Keys with more than ``share`` of the rows of ``left``, at most ``1 / share`` of them, meet their row by broadcast and never
    enter the shuffle; nor do rows with a null key, which match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a heavy join cannot be {how}")
    known = left
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    heavy = heavy_keys(known, keys, share, fewest=fewest)
    others = [c for c in right.columns if c not in keys]
    if heavy:
        hot = F.broadcast(left.sparkSession.createDataFrame([tuple(h[k] for k in keys) for h in heavy], T.StructType([left.schema[k] for k in keys])))
        out = known.join(hot, keys, "left_anti").join(right, keys, how).unionByName(known.join(hot, keys, "left_semi").join(F.broadcast(right.join(hot, keys, "left_semi")), keys, how))
    else:
        out = known.join(right, keys, how)
    out = out.select(*left.columns, *others)
    if how == "inner":
        return out
    missing = left.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
    return out.unionByName(missing.select(*left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in others]))


def fits_broadcast(df: DataFrame, most_bytes: int = BROADCAST_BYTES, most_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` is proven small, by its rows and the length of its values; meant for a table that is cheap to read."""
    size = F.lit(16 * len(df.columns))
    for f in df.schema.fields:
        if not isinstance(f.dataType, T.NumericType | T.BooleanType | T.DatetimeType):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f.name)) if not isinstance(f.dataType, T.StringType) else F.col(f.name)), F.lit(0))
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= most_rows and total <= most_bytes


def small_join(left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str], how: str = "inner", most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``left`` joined with ``right``: by broadcast if a measurement proves ``right`` small, else salted."""
    if fits_broadcast(right, most_bytes):
        return left.join(F.broadcast(right), keys, how)
    return salted_join(left, right, keys, spread_by, how)
