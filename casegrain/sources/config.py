"""Closed configuration and small driver-side inputs."""

from __future__ import annotations

import dataclasses
import shutil
import tomllib
from pathlib import Path
from typing import get_type_hints

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrain.operators.constraints import ConfigurationError, duplicates, require_none
from casegrain.sources.files import read_json_lines


@dataclasses.dataclass(frozen=True)
class Settings:
    """Parameters of a run; ``limit`` None means all."""

    most_white: float = 0.5
    most_text: int = 200
    least_title_chars: int = 20
    least_title_words: int = 4
    shard_bytes: int = 190_000_000
    shard_requests: int = 45_000
    limit: int | None = None

    def __post_init__(self) -> None:
        ranges = {"most_white": (0, 1), "most_text": (0, 10**6), "least_title_chars": (1, 10**4), "least_title_words": (1, 10**3), "shard_bytes": (1, 200_000_000), "shard_requests": (1, 50_000), "limit": (0, 2**62)}
        for name, (low, high) in ranges.items():
            v = getattr(self, name)
            if v is not None and not low <= v <= high:
                raise ConfigurationError(f"{name} must lie in {low}..{high}")


def load_settings(path: str, kind: type = Settings):
    """A TOML file with known keys of the right type only; a truth value is not a number."""
    with open(path, "rb") as f:
        given = tomllib.load(f)
    hints = get_type_hints(kind)
    if unknown := sorted(set(given) - set(hints)):
        raise ConfigurationError(f"unknown settings {unknown}")
    for k, v in given.items():
        allowed = hints[k] if not hasattr(hints[k], "__args__") else hints[k].__args__
        if isinstance(v, bool) or not (isinstance(v, allowed) or (hints[k] is float and isinstance(v, int))):
            raise ConfigurationError(f"{k} has the wrong type")
    return kind(**given)


ADJUDICATION = T.StructType([T.StructField(n, T.StringType()) for n in ("patient_uid", "label", "reason")])


def load_adjudications(spark: SparkSession, path: str, labels: tuple[str, ...] = ("human", "animal")) -> DataFrame:
    """Decisions (patient_uid, label, reason): exact fields, one per uid, a known label, a reason that is neither blank nor padded."""
    d = read_json_lines(spark, path, ADJUDICATION)
    reason = F.col("reason")
    bad = ~F.coalesce(F.col("label").isin(*labels), F.lit(False)) | F.coalesce((F.trim(reason) != reason) | (reason == ""), F.lit(True)) | F.col("patient_uid").isNull()
    require_none(d.where(bad), "adjudications")
    require_none(duplicates(d, "patient_uid"), "adjudications given twice")
    return d


def require_apart(output: str, *inputs: str) -> None:
    """Output and inputs may not lie inside each other."""
    out = Path(output).resolve()
    for p in map(Path, inputs):
        q = p.resolve()
        if out == q or q in out.parents or out in q.parents:
            raise ConfigurationError(f"{output} and {p} overlap")


def clear_stale(parent: str, name: str) -> list[str]:
    """Removes temporary folders that an interrupted ``publishing`` of ``name`` left behind; symbolic links are refused."""
    gone = []
    for p in sorted(Path(parent).glob(f".{name}-*")):
        if p.is_symlink():
            raise ConfigurationError(f"{p} is a symbolic link")
        shutil.rmtree(p)
        gone.append(p.name)
    return gone


def first_n(df: DataFrame, n: int | None, *order) -> DataFrame:
    """The first ``n`` rows in a total order (a sampling feature); None keeps all, a negative number is an error."""
    if n is not None and n < 0:
        raise ConfigurationError("a limit cannot be negative")
    return df if n is None else df.orderBy(*order).limit(n)
