"""Requests in shards of bounded size, and responses reconciled with them."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrain.functions.keys import custom_id
from casegrain.session import Tables

MOST_BYTES, MOST_REQUESTS = 190_000_000, 45_000


URL = "/v1/chat/completions"


def total_index(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its position in a total order, from 0.

    The sorted rows are written once, each with its partition and its place there; the offsets of the partitions, one number
    each, are all the driver sees. No step holds more than a partition of the sort.
    """
    store = Tables(df.sparkSession, "index")
    place = F.monotonically_increasing_id()
    s = store.keep(df.orderBy(*order).withColumn("__part", F.shiftright(place, 33)).withColumn("__at", place.bitwiseAND(F.lit((1 << 33) - 1))), "sorted")
    offsets, at = [], 0
    for r in sorted(s.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["__part"]):
        offsets.append((r["__part"], at))
        at += r["n"]
    o = df.sparkSession.createDataFrame(offsets, "__part bigint, __offset bigint")
    return s.join(F.broadcast(o), "__part").withColumn(name, F.col("__offset") + F.col("__at")).select(*df.columns, name)


def request_lines(requests: DataFrame, stage: str, order: list[str]) -> DataFrame:
    """``requests`` with ordinal, custom_id, line and line_bytes. ``body`` is canonical JSON; ``order`` must be total."""
    rows = total_index(requests, order, "ordinal")
    tail = F.lit(f',"method":"POST","url":"{URL}"}}')
    core = F.concat(F.lit('{"body":'), F.col("body"), tail)
    cid = custom_id(stage, F.col("ordinal"), core)
    line = F.concat(F.lit('{"body":'), F.col("body"), F.lit(',"custom_id":"'), cid, F.lit('"'), tail)
    return rows.withColumn("custom_id", cid).withColumn("line", line).withColumn("line_bytes", (F.octet_length(line) + 1).cast("bigint"))


def _next_starts(sizes: np.ndarray, most_bytes: int, most_requests: int) -> np.ndarray:
    """For each line, where the next shard starts if one starts at it."""
    if len(sizes) and sizes.max() > most_bytes:
        raise ValueError(f"a request of {sizes.max()} bytes exceeds the limit of {most_bytes}")
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(len(sizes))
    return np.minimum(np.searchsorted(ends, ends[:-1] + most_bytes, "right") - 1, at + most_requests)


def assign_shards(lines: DataFrame, most_bytes: int = MOST_BYTES, most_requests: int = MOST_REQUESTS, per_task: int = 2_000_000) -> DataFrame:
    """(ordinal, shard, line_number): each shard is filled in order until the next line would exceed a limit.

    Greedy filling depends on all lines before, yet only through the place where a shard starts. The lines, as ordinals and
    sizes, are cut into runs of ``per_task``. Each run finds, for every line of its first ``most_requests`` at which a shard can
    start, where the first shard behind the run starts; the driver follows one such number per run; then all runs are filled at
    once. Ordinals are 0 to n - 1. A line beyond ``most_bytes`` fails the job.
    """
    spark = lines.sparkSession
    per_task = max(per_task, most_requests)
    sized = lines.select("ordinal", F.col("line_bytes").cast("long").alias("line_bytes"))
    n = sized.count()
    runs = -(-n // per_task)
    run = F.floor(F.col("ordinal") / per_task)

    def borders(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("ordinal", ignore_index=True)
        here = int(g["run"].iat[0]) * per_task
        own = int((g["ordinal"] < here + per_task).sum())
        after = _next_starts(g["line_bytes"].to_numpy(), most_bytes, most_requests)[:own].tolist()
        out, count, last = [0] * own, [1] * own, list(range(own))
        for i in range(own - 1, -1, -1):
            j = after[i]
            if j < own:
                out[i], count[i], last[i] = out[j], count[j] + 1, last[j]
            else:
                out[i] = j - own
        k = min(own, most_requests)
        return pd.DataFrame({"run": here // per_task, "entry": range(k), "exit": out[:k], "shards": count[:k], "last": [here + x for x in last[:k]]})

    starts = {0: (0, 0, 0)}  # run -> first start in it, shards before, start of the shard before
    if runs > 1:
        shared = F.when((F.col("ordinal") % per_task < most_requests) & (run > 0), F.array(run, run - 1)).otherwise(F.array(run))
        ways = Tables(spark, "shards").keep(sized.withColumn("run", F.explode(shared)).groupBy("run").applyInPandas(borders, "run long, entry long, exit long, shards long, last long"), "borders")
        for r in range(runs - 1):
            entry, before, _ = starts[r]
            w = ways.where((F.col("run") == r) & (F.col("entry") == entry)).first()
            starts[r + 1] = (w["exit"], before + w["shards"], w["last"])

    def fill(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("ordinal", ignore_index=True)
        here = int(g["run"].iat[0])
        entry, before, last = starts[here]
        after = _next_starts(g["line_bytes"].to_numpy(), most_bytes, most_requests)
        shard, first = np.full(len(g), before - 1), np.full(len(g), last)
        i = entry
        while i < len(g):
            j = int(after[i])
            shard[i:j], first[i:j] = before, here * per_task + i
            i, before = j, before + 1
        return pd.DataFrame({"ordinal": g["ordinal"], "shard": shard, "line_number": g["ordinal"] - first + 1})

    return sized.withColumn("run", run).groupBy("run").applyInPandas(fill, "ordinal long, shard int, line_number int")


def request_body(model: str, developer: Column, user: Column, effort: str | None = None) -> Column:
    """Canonical JSON of a chat request; an absent effort is left out."""
    said = F.array(F.struct(developer.alias("content"), F.lit("developer").alias("role")), F.struct(user.alias("content"), F.lit("user").alias("role")))
    return F.to_json(F.struct(said.alias("messages"), F.lit(model).alias("model"), F.lit(effort).cast("string").alias("reasoning_effort")))


def write_shards(lines: DataFrame, shards: DataFrame, path: str) -> DataFrame:
    """One JSON lines file per shard below ``path``, as shard=<s>/, and the index of all requests beside them.

    Each shard is sorted and written by one task; it is bounded by the shard limits. Returns the index.
    """
    rows = lines.join(shards, "ordinal")
    out = rows.select("shard", "ordinal", F.col("line").alias("value")).repartition("shard").sortWithinPartitions("shard", "ordinal")
    out.drop("ordinal").write.partitionBy("shard").text(f"{path}/shards")
    index = rows.select("ordinal", "custom_id", "shard", "line_number", "line_bytes", F.sha2(F.concat("line", F.lit("\n")), 256).alias("line_sha256"))
    index.write.parquet(f"{path}/index")
    return index.sparkSession.read.parquet(f"{path}/index")


RESPONSE = "custom_id string, error string, response struct<status_code: int, body: struct<choices: array<struct<index: int, finish_reason: string, message: struct<role: string, content: string, refusal: string>>>>>"


def read_responses(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per non-blank line: custom_id, text (of a usable answer), problem (of any other)."""
    r = lines.where(F.trim(column) != "").withColumn("r", F.from_json(column, RESPONSE))
    choice = F.get("r.response.body.choices", F.lit(0))
    status = F.col("r.response.status_code")
    problem = (
        F.when(F.col("r").isNull() | F.col("r.custom_id").isNull(), "malformed")
        .when(F.col("r.error").isNotNull(), "error")
        .when(status.isNull() | (status < 200) | (status > 299), "http_status")
        .when(F.coalesce(F.size("r.response.body.choices"), F.lit(0)) != 1, "choices")
        .when(choice["index"] != 0, "choice_index")
        .when(~F.coalesce(choice["finish_reason"] == "stop", F.lit(False)), "finish_reason")
        .when(F.coalesce(choice["message"]["refusal"], F.lit("")) != "", "refusal")
        .when(F.coalesce(F.trim(choice["message"]["content"]), F.lit("")) == "", "blank")
    )
    return r.select(F.col("r.custom_id").alias("custom_id"), F.when(problem.isNull(), choice["message"]["content"]).alias("text"), problem.alias("problem"))


def reconcile(index: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers, problems): each request needs exactly one usable response.

    ``problems`` (custom_id, problem) holds unexpected, duplicate, missing and unusable ones; a set is accepted only if it is empty.
    """
    counted = responses.groupBy("custom_id").agg(F.count(F.lit(1)).alias("n"), F.min("problem").alias("problem"), F.max("text").alias("text"))
    j = index.select("custom_id", "ordinal", "pair_index", F.lit(True).alias("asked")).join(counted, "custom_id", "full_outer")
    why = F.when(F.col("asked").isNull(), "unexpected").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate").otherwise(F.col("problem"))
    j = j.withColumn("why", why)
    return j.where("why IS NULL").select("custom_id", "ordinal", "pair_index", "text"), j.where("why IS NOT NULL").select("custom_id", F.col("why").alias("problem"))


def _no_repeats(pairs):
    keys = [k for k, _ in pairs]
    if len(keys) != len(set(keys)):
        raise ValueError("repeated key")
    return dict(pairs)


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


def strict_items(text: str | None) -> tuple[str | None, list[dict]]:
    """(problem, items) of a labelled-pairs answer: one optional code fence around a JSON array of exact records."""
    body = (text or "").strip()
    fence = re.fullmatch(r"```(?:json)?\s*\n(.*)\n\s*```", body, re.S)
    body = fence.group(1).strip() if fence else body
    try:
        found = json.loads(body, object_pairs_hook=_no_repeats, parse_constant=_no_constant)
    except ValueError as e:
        return f"json: {e}"[:120], []
    if not isinstance(found, list):
        return "not_an_array", []
    for x in found:
        if not isinstance(x, dict) or set(x) != {"pair_id", "modality", "anatomy", "diagnosis"}:
            return "fields", []
        ids = x["pair_id"]
        if not (isinstance(ids, list) and len(ids) == 2 and all(isinstance(i, str) and i.strip() for i in ids)):
            return "pair_id", []
        if not all(isinstance(x[f], str) and x[f].strip() for f in ("modality", "anatomy", "diagnosis")):
            return "label", []
    return None, [{"pair_id": [i.strip() for i in x["pair_id"]], **{f: x[f].strip() for f in ("modality", "anatomy", "diagnosis")}} for x in found]


ITEMS = "array<struct<pair_id: array<string>, modality: string, anatomy: string, diagnosis: string>>"


def parse_items(answers: DataFrame) -> DataFrame:
    """``answers`` with ``problem`` and ``items``; JSON strictness (repeated keys, NaN, trailing text) needs Python."""

    @F.pandas_udf(f"struct<problem: string, items: {ITEMS}>")
    def parsed(s: pd.Series) -> pd.DataFrame:
        rows = [strict_items(x) for x in s]
        return pd.DataFrame({"problem": [r[0] for r in rows], "items": [r[1] for r in rows]})

    return answers.withColumn("__p", parsed("text")).select(*answers.columns, "__p.*")


# Phrases that mark a refusal, and the labelled lines of a citation answer.
REFUSALS = ["as an ai language model", "i cannot assist", "i can't assist", "i am unable to comply", "i'm unable to comply"]
CITATION_ANSWER = r"(?s)^Reason for Citation:[ \t]*\S[^\r\n]*\r?\nPossible Similarities:[ \t]*\S[^\r\n]*\r?\nExplanation:[ \t]*\S.*$"


def _refused(text: Column) -> Column:
    return F.exists(F.array(*[F.lit(r) for r in REFUSALS]), lambda r: F.lower(text).contains(r))


def citation_problem(text: Column) -> Column:
    """Problem of a citation answer, null if it has exactly the three labelled fields."""
    return F.when(_refused(text), "refusal").when(~F.coalesce(F.trim(text).rlike(CITATION_ANSWER), F.lit(False)), "fields")


def level_problem(text: Column, questions: bool) -> Column:
    """Problem of an answer in levels: heading lines 1 to 3 in order with nothing before and text below each; a question asks at each level."""
    heading = r"(?im)^[ \t]*level[ \t]+([123])(?:\b[^\r\n]*)?$"
    levels = F.regexp_extract_all(text, F.lit(heading), 1)
    parts = F.split(text, heading)
    below = F.slice(parts, 2, 99)
    silent = F.exists(below, lambda p: ~p.contains("?")) if questions else F.lit(False)
    return (
        F.when(_refused(text), "refusal").when(~F.coalesce(levels == F.array(*[F.lit(x) for x in "123"]), F.lit(False)), "levels").when(F.trim(F.regexp_replace(parts[0], r"\s", "")) != "", "text_before")
        .when(F.exists(below, lambda p: F.regexp_replace(p, r"\s", "") == ""), "empty_level").when(silent, "no_question")
    )
