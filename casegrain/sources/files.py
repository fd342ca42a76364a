"""File sources: CSV and JSON lines read strictly, XML records, archives, batch responses."""

from __future__ import annotations

import ftplib
import io
import json
import tarfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrain.functions.keys import safe_path_problem
from casegrain.operators.constraints import ConfigurationError, IntegrityError, require_columns


def single_source(paths: str | list[str]) -> str:
    """Exactly one existing file."""
    given = [paths] if isinstance(paths, str) else list(paths)
    if len(given) != 1 or not Path(given[0]).is_file():
        raise ConfigurationError(f"exactly one existing input file is needed, not {given}")
    return given[0]


def read_text_csv(spark: SparkSession, path: str, required: list[str] = (), types: dict[str, T.DataType] | None = None) -> DataFrame:
    """A CSV with every column as text: "NA", "null" and empty cells stay text. ``types`` casts named columns.

    ``csv_row`` is the number of the row, from 2 as the header is line 1; quoted line breaks do not count as rows. The file is
    read unsplit for it, as is right for the one bounded table of raw patients.
    """
    with open(path, encoding="utf-8-sig", newline="") as f:
        import csv

        header = next(csv.reader(f), [])
    if len(header) != len(set(header)):
        raise ConfigurationError(f"{path} repeats a column name")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", mode="FAILFAST", enforceSchema=True)
    require_columns(df, list(required), path)
    df = df.na.fill("").withColumn("csv_row", F.monotonically_increasing_id() + 2)
    for c, t in (types or {}).items():
        df = df.withColumn(c, F.col(c).try_cast(t))
    return df


def read_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType, exact: bool = True) -> DataFrame:
    """JSON lines with a closed schema: blank lines are skipped; a line that is no object, is malformed or has other fields raises.

    The reader drops unknown fields silently, so the key sets of all lines are compared before the rows are used.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    keys = F.json_object_keys("value")
    names = F.array(*[F.lit(n) for n in schema.fieldNames()])
    bad = keys.isNull() | ((F.size(F.array_except(keys, names)) > 0) | (F.size(F.array_except(names, keys)) > 0) if exact else F.lit(False)) | F.try_parse_json("value").isNull()
    first = lines.where(bad).select(F.col("_metadata.file_path").alias("file"), F.substring("value", 1, 120).alias("line")).limit(5).collect()
    if first:
        raise IntegrityError("; ".join(f"{r['file']}: {r['line']!r}" for r in first))
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def response_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines (value, file) of response files; a directory stands for its *.jsonl in order; a file named twice raises."""
    files: list[str] = []
    for p in map(Path, paths):
        files += [str(x.resolve()) for x in sorted(p.glob("*.jsonl"))] if p.is_dir() else [str(p.resolve())]
    if not files or len(files) != len(set(files)):
        raise ConfigurationError(f"response files must be given, once each: {files}")
    return spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file"))


def read_json_pairs(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of labelled pairs with pair_index, the position in the list."""
    with open(path, encoding="utf-8") as f:
        rows = json.load(f)
    if not isinstance(rows, list):
        raise IntegrityError(f"{path} is not a list")
    for n, r in enumerate(rows):
        ids = r.get("pair_id") if isinstance(r, dict) else None
        if not (isinstance(ids, list) and len(ids) == 2 and all(isinstance(i, str) and i.strip() for i in ids) and all(isinstance(r.get(k), str) and r[k].strip() for k in ("modality", "anatomy", "diagnosis"))):
            raise IntegrityError(f"{path}: item {n} is not a labelled pair")
    return spark.createDataFrame([(n, r["pair_id"], r["modality"], r["anatomy"], r["diagnosis"]) for n, r in enumerate(rows)], "pair_index long, pair_id array<string>, modality string, anatomy string, diagnosis string")


PACKAGE = "pmc_id string, problem string, download_url string, host string, archive_name string"


def package_link(pmc_id: str, data: bytes | str | None, hosts: tuple[str, ...]) -> dict:
    """The one archive link of a metadata response, or the problem with it."""
    out = {"pmc_id": pmc_id, "problem": None, "download_url": None, "host": None, "archive_name": None}
    raw = data.encode() if isinstance(data, str) else data
    if not raw:
        return out | {"problem": "missing"}
    try:
        if b"<!ENTITY" in raw:
            raise ValueError("entity")
        root = ET.fromstring(raw)
    except (ET.ParseError, ValueError):
        return out | {"problem": "malformed"}
    digits = pmc_id.upper().removeprefix("PMC")
    records = [r for r in root.iter("record") if (r.get("id") or "").upper().removeprefix("PMC") == digits]
    links = {x.get("href", "").strip() for r in records for x in r.iter("link") if x.get("format") == "tgz"} - {""}
    if not records:
        return out | {"problem": "no_record"}
    if len(links) != 1:
        return out | {"problem": "no_link" if not links else "several_links"}
    url = urlparse(links.pop())
    if url.scheme not in ("ftp", "http", "https") or (url.hostname or "") not in hosts:
        return out | {"problem": "host"}
    return out | {"download_url": url.geturl(), "host": url.hostname, "archive_name": url.path.rsplit("/", 1)[-1]}


def read_packages(responses: DataFrame, hosts: tuple[str, ...]) -> DataFrame:
    """``responses`` (pmc_id, content) -> one row per article with its archive link or problem."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([package_link(i, c, hosts) for i, c in zip(b["pmc_id"], b["content"], strict=True)], columns=["pmc_id", "problem", "download_url", "host", "archive_name"])

    return responses.select("pmc_id", "content").mapInPandas(scan, PACKAGE)


def cached_responses(spark: SparkSession, folder: str) -> DataFrame:
    """(pmc_id, content) of a folder of ``<digits>.xml`` or ``PMC<digits>.xml``; the bare name wins."""
    f = spark.read.format("binaryFile").load(f"{folder}/*.xml")
    name = F.regexp_extract("path", r"([^/]+)\.xml$", 1)
    f = f.select(F.regexp_extract(name, r"(?i)^(?:PMC)?(\d+)$", 1).alias("n"), name.rlike("^[0-9]").alias("bare"), "content").where(F.col("n") != "")
    return f.groupBy("n").agg(F.max_by("content", "bare").alias("content")).select(F.concat(F.lit("PMC"), "n").alias("pmc_id"), "content")


def final_error(e: Exception) -> bool:
    """Errors that another try cannot mend: refusals by HTTP (all of 4xx but 429) and permanent ones by FTP."""
    code = getattr(e, "code", None)
    return isinstance(e, ftplib.error_perm) or (isinstance(code, int) and 400 <= code < 500 and code != 429)


def fetched(ids: DataFrame, fetch, column: str = "pmc_id", tries: int = 3, most_bytes: int = 1 << 30) -> DataFrame:
    """(column, content, problem) through an injected ``fetch(id) -> bytes | None``; a failing id never fails the job.

    Network errors are tried again unless they are final; content beyond ``most_bytes`` is refused.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i in b[column]:
                content, problem = None, "missing"
                for _ in range(tries):
                    try:
                        content = fetch(i)
                        problem = None if content else "missing"
                        if content and len(content) > most_bytes:
                            content, problem = None, "too_large"
                        break
                    except (OSError, ftplib.Error) as e:  # network errors; anything else is a bug and fails the task
                        problem = f"{type(e).__name__}: {e}"[:200]
                        if final_error(e):
                            break
                rows.append((i, content, problem))
            yield pd.DataFrame(rows, columns=[column, "content", "problem"])

    return ids.select(column).distinct().mapInPandas(scan, f"{column} string, content binary, problem string")


MEMBER = "archive string, member string, size long, content binary, problem string"


def archive_members(archives: DataFrame, most_members: int = 50_000, most_bytes: int = 4 << 30, most_each: int = 1 << 30, keep: str = r"(?i)\.(?:nxml|jpe?g|png|gif|tiff?|bmp|webp)$") -> DataFrame:
    """Regular members of tar archives (archive, content) whose names match ``keep``, ordered by lower-case name.

    Unsafe names (absolute, climbing out) are left out. An archive beyond a limit or damaged gives one row with ``problem``.
    """
    import re

    wanted = re.compile(keep)

    def one(name: str, data: bytes) -> list[tuple]:
        rows, total = [], 0
        try:
            with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as tar:
                for n, m in enumerate(tar, 1):
                    if n > most_members:
                        raise ValueError("too many members")
                    if not m.isfile():
                        continue
                    total += m.size
                    if total > most_bytes or m.size > most_each:
                        raise ValueError("too many bytes")
                    path = m.name.replace("\\", "/")
                    if path.startswith("/") or ".." in path.split("/") or not wanted.search(path):
                        continue
                    rows.append((name, m.name, m.size, tar.extractfile(m).read(), None))
        except (tarfile.TarError, ValueError, EOFError, OSError) as e:
            return [(name, None, None, None, f"{type(e).__name__}: {e}"[:200])]
        return sorted(rows, key=lambda r: r[1].lower())

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for a, c in zip(b["archive"], b["content"], strict=True):
                yield pd.DataFrame(one(a, c), columns=["archive", "member", "size", "content", "problem"])

    return archives.select("archive", "content").mapInPandas(scan, MEMBER)


def chosen_nxml(members: DataFrame, articles: DataFrame) -> DataFrame:
    """(archive, member, problem): the one article file of each archive.

    ``articles``: archive, member, pmc_id (asked for), declared (of the file's front matter, null if none), size. One file that
    declares the asked id wins; without any declaration a single file is taken; else the archive has a problem.
    """
    digits = lambda c: F.regexp_replace(F.upper(c), "^PMC", "")
    own = F.coalesce(digits(F.col("declared")) == digits(F.col("pmc_id")), F.lit(False))
    g = articles.groupBy("archive").agg(
        F.sum(own.cast("int")).alias("own"), F.count(F.lit(1)).alias("n"), F.count("declared").alias("declared"),
        F.min_by("member", F.struct(~own, -F.col("size"), F.lower("member"))).alias("member"),
    )
    problem = F.when(F.col("own") > 1, "several").when((F.col("own") == 0) & (F.col("declared") > 0), "mismatch").when((F.col("own") == 0) & (F.col("n") > 1), "undeclared")
    none = members.select("archive").distinct().join(g.select("archive"), "archive", "left_anti").select("archive", F.lit(None).cast("string").alias("member"), F.lit("missing").alias("problem"))
    return g.select("archive", F.when(problem.isNull(), F.col("member")).alias("member"), problem.alias("problem")).unionByName(none)


def checked_articles(records: DataFrame, files: DataFrame, tree: str = "new_data") -> DataFrame:
    """(patient_uid, content, problem): each record's article file if it is the one recorded.

    ``records``: patient_uid, nxml_path, nxml_sha256; ``files``: path, content. bad_path: absolute, climbing out, outside
    ``tree`` or no .nxml; missing: no such file; changed: another hash than recorded. Content is null where there is a problem.
    """
    bad = F.coalesce(safe_path_problem(F.col("nxml_path")), F.lit(True)) | ~F.col("nxml_path").startswith(f"{tree}/") | ~F.lower("nxml_path").endswith(".nxml")
    j = records.select("patient_uid", "nxml_path", "nxml_sha256").join(files.select(F.col("path").alias("nxml_path"), "content"), "nxml_path", "left")
    same = F.coalesce(F.sha2("content", 256) == F.lower("nxml_sha256"), F.lit(False))
    problem = F.when(bad, "bad_path").when(F.col("content").isNull(), "missing").when(~same, "changed")
    return j.select("patient_uid", F.when(problem.isNull(), F.col("content")).alias("content"), problem.alias("problem"))
