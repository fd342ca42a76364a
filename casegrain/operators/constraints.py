"""Checks as DataFrames: one row per violation, and a driver-side guard that raises before anything is published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class IntegrityError(ValueError):
    """A dataset breaks its contract."""


class ConfigurationError(ValueError):
    """Parameters or inputs are not what a step needs."""


class StageOrderError(ValueError):
    """A stage is run before what it needs is whole."""


class ResponseError(ValueError):
    """Responses are missing, unexpected or unusable."""


class BatchStateError(ValueError):
    """A batch is not in a state that allows the step."""


class DiagramError(ValueError):
    """An image cannot be judged."""


def require_columns(df: DataFrame, names: list[str], label: str = "table") -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ConfigurationError(f"{label} lacks the columns {missing}")


def require_exact_columns(df: DataFrame, names: list[str], label: str = "table") -> None:
    if set(df.columns) != set(names):
        raise ConfigurationError(f"{label}: missing {sorted(set(names) - set(df.columns))}, unexpected {sorted(set(df.columns) - set(names))}")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, n) of key values on several rows; null is a value like any other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def missing_keys(df: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys of ``df`` that ``other`` lacks."""
    return df.select(*keys).distinct().join(other.select(*keys), list(keys), "left_anti")


def difference(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """(keys, side): keys that only one side has; empty if the populations are equal."""
    return missing_keys(a, b, *keys).withColumn("side", F.lit("left")).unionByName(missing_keys(b, a, *keys).withColumn("side", F.lit("right")))


def changed_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows (with multiplicity) of either side that the other lacks; empty if a rebuilt artifact equals the stored one."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def problems(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """(keys, problem): a row per broken rule; each rule is a condition that holds for bad rows, null counting as not bad."""
    named = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return df.select(*keys, F.explode(named).alias("problem"))


def require_none(bad: DataFrame, what: str, shown: int = 20) -> None:
    """Raise with the first rows, in a fixed order, if there are any."""
    rows = bad.orderBy(*bad.columns).limit(shown).collect()
    if rows:
        raise IntegrityError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def gaps(df: DataFrame, column: str) -> DataFrame:
    """One row (least, most, n, distinct) if the values are not exactly 0..n-1."""
    a = df.agg(F.min(column).alias("least"), F.max(column).alias("most"), F.count(F.lit(1)).alias("n"), F.countDistinct(column).alias("different"))
    return a.where("n > 0 AND (least <> 0 OR most <> n - 1 OR different <> n)")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
