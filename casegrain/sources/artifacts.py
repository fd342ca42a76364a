"""Sinks with canonical bytes: sorted, atomic, hashed and verifiable."""

from __future__ import annotations

import csv
import fcntl
import hashlib
import io
import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrain.operators.batches import total_index
from casegrain.operators.constraints import ConfigurationError, IntegrityError


def canonical_json(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def _sorted_type(c: Column, t: T.DataType) -> Column:
    """The column with the fields of every struct in order of name; null structs stay null."""
    if isinstance(t, T.StructType):
        inner = F.struct(*[_sorted_type(c[f.name], f.dataType).alias(f.name) for f in sorted(t.fields, key=lambda f: f.name)])
        return F.when(c.isNotNull(), inner)
    if isinstance(t, T.ArrayType) and isinstance(t.elementType, (T.StructType, T.ArrayType)):
        return F.transform(c, lambda x: _sorted_type(x, t.elementType))
    return c


def canonical_rows(df: DataFrame) -> Column:
    """Each row as canonical JSON: keys sorted at every level, nulls written."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    row = F.struct(*[_sorted_type(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields])
    return F.to_json(row, {"ignoreNullFields": "false"})


def write_json_lines(df: DataFrame, path: str, order: list[str], single: bool = False) -> None:
    """Canonical JSON lines in a total order. Part files sort as the rows do, so reading them by name keeps the order;
    ``single`` makes one file, for small tables."""
    out = df.orderBy(*order).select(canonical_rows(df).alias("value"))
    with publishing_shared(df.sparkSession, path) as temporary:
        (out.coalesce(1) if single else out).write.mode("overwrite").text(temporary)


@contextmanager
def publishing(path: str) -> Iterator[str]:
    """A sibling folder to build in; renamed to ``path`` if all went well, removed otherwise. A non-empty ``path`` is refused."""
    target = Path(path)
    if target.is_symlink() or (target.exists() and any(target.iterdir())):
        raise ConfigurationError(f"{path} is not empty")
    target.parent.mkdir(parents=True, exist_ok=True)
    temporary = tempfile.mkdtemp(prefix=f".{target.name}-", dir=target.parent)
    try:
        yield temporary
        if target.exists():
            target.rmdir()
        os.replace(temporary, target)
    finally:
        shutil.rmtree(temporary, ignore_errors=True)


@contextmanager
def publishing_shared(spark: SparkSession, path: str) -> Iterator[str]:
    """``publishing`` for folders that executors write, on any Hadoop file system."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    target = make(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = fs.makeQualified(target)
    if fs.exists(target) and (not fs.getFileStatus(target).isDirectory() or len(fs.listStatus(target))):
        raise ConfigurationError(f"{path} is not empty")
    temporary = make(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    try:
        yield temporary.toString()
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(temporary, target):
            raise IntegrityError(f"{path} could not be published")
    finally:
        if fs.exists(temporary):
            fs.delete(temporary, True)


@contextmanager
def replacing(path: str) -> Iterator[io.BufferedWriter]:
    """A file to write in place of ``path``: a temporary sibling, synced, then renamed."""
    fd, temporary = tempfile.mkstemp(dir=Path(path).parent)
    try:
        with os.fdopen(fd, "wb") as f:
            yield f
            f.flush()
            os.fsync(f.fileno())
        os.replace(temporary, path)
    except BaseException:
        Path(temporary).unlink(missing_ok=True)
        raise


def write_bytes(path: str, data: bytes) -> None:
    with replacing(path) as f:
        f.write(data)


def write_json(path: str, value) -> None:
    write_bytes(path, (json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True, allow_nan=False) + "\n").encode())


def write_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """One CSV file in order, ``\\n`` line ends; rows pass the driver one partition of the sort at a time."""
    with replacing(path) as f:
        text = io.TextIOWrapper(f, encoding="utf-8", newline="")
        out = csv.writer(text, lineterminator="\n")
        out.writerow(df.columns)
        for r in df.orderBy(*order).toLocalIterator():
            out.writerow(["" if v is None else v for v in r])
        text.flush()
        text.detach()


def write_once(path: str, value) -> None:
    """A receipt: a later write must be equal."""
    if Path(path).exists():
        if json.loads(Path(path).read_text()) != value:
            raise IntegrityError(f"{path} exists with other content")
        return
    write_json(path, value)


def file_hashes(spark: SparkSession, root: str) -> DataFrame:
    """(path relative to root, bytes, sha256) of every file below ``root``."""
    base = Path(root).resolve()
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(base))
    rel = F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), f"^{base}/", "")
    return f.select(rel.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def tree_hash(hashes: DataFrame) -> str:
    """SHA-256 over path, NUL, hash, LF of all files in order of path."""
    h = hashlib.sha256()
    for r in hashes.select("path", "sha256").orderBy("path").toLocalIterator():
        h.update(r["path"].encode() + b"\0" + r["sha256"].encode() + b"\n")
    return h.hexdigest()


def row_digest(df: DataFrame, order: list[str]) -> str:
    """A digest of rows in order, without bringing the rows to the driver: canonical rows are hashed where they are, hashes of
    ordered runs are combined."""
    s = total_index(df, order, "__i").select(F.sha2(canonical_rows(df), 256).alias("h"), F.col("__i").alias("i"))
    runs = s.groupBy(F.floor(F.col("i") / 4096).alias("run"))
    h = hashlib.sha256()
    for r in runs.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "h"))), lambda x: x["h"]), ""), 256).alias("h")).orderBy("run").toLocalIterator():
        h.update(r["h"].encode())
    return h.hexdigest()


def manifest(spark: SparkSession, root: str, config: dict, stages: list[dict]) -> dict:
    """What a run was made of: configuration, stages, every file with its hash."""
    files = {r["path"]: {"bytes": r["bytes"], "sha256": r["sha256"]} for r in file_hashes(spark, root).orderBy("path").toLocalIterator()}
    return {"config": config, "config_sha256": hashlib.sha256(canonical_json(config).encode()).hexdigest(), "stages": stages, "artifacts": files}


def verify_manifest(spark: SparkSession, root: str, said: dict) -> None:
    """Raise if a file is missing, new or changed."""
    rows = [(p, a["bytes"], a["sha256"]) for p, a in said["artifacts"].items()]
    want = spark.createDataFrame(rows, "path string, bytes long, sha256 string")
    bad = want.exceptAll(file_hashes(spark, root)).unionByName(file_hashes(spark, root).exceptAll(want)).select("path").distinct().orderBy("path").limit(20).collect()
    if bad:
        raise IntegrityError(f"changed, missing or new: {[r['path'] for r in bad]}")


@contextmanager
def run_lock(path: str) -> Iterator[None]:
    """One run at a time per folder."""
    with open(path, "a") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError as e:
            raise ConfigurationError(f"{path} is locked by another run") from e
        yield


def write_assets(figures: DataFrame, root: str) -> DataFrame:
    """Writes images and captions (folder, name, image, caption) below ``root``; gives (folder, name, written).

    Every file is written to a temporary sibling and renamed, so a task that is run again leaves the same files; an existing
    file with other bytes raises. ``root`` is a folder all executors share.
    """

    def one(path: Path, data: bytes) -> bool:
        if path.exists():
            if path.read_bytes() != data:
                raise IntegrityError(f"{path} exists with other content")
            return False
        path.parent.mkdir(parents=True, exist_ok=True)
        write_bytes(str(path), data)
        return True

    def scan(batches):
        import pandas as pd

        for b in batches:
            made = []
            for folder, name, image, caption in zip(b["folder"], b["name"], b["image"], b["caption"], strict=True):
                here = Path(root) / folder
                made.append(one(here / f"{name}.jpg", bytes(image)) | one(here / f"{name}.txt", caption.encode()))
            yield pd.DataFrame({"folder": b["folder"], "name": b["name"], "written": made})

    return figures.select("folder", "name", "image", "caption").mapInPandas(scan, "folder string, name string, written boolean")


def file_digest(path: str | Path) -> bytes:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").digest()


def snapshot(paths: list[str], root: str) -> str:
    """Copies files into a folder named by their contents; a snapshot that exists is checked, not written again.

    Files are hashed and copied in pieces, so their size does not matter to the driver's memory.
    """
    parts = sorted((file_digest(p), p) for p in paths)
    target = Path(root) / hashlib.sha256(b"".join(d for d, _ in parts)).hexdigest()
    if not target.exists():
        with publishing(str(target)) as temporary:
            for n, (_, p) in enumerate(parts):
                shutil.copyfile(p, f"{temporary}/{n:05d}.jsonl")
    if [file_digest(p) for p in sorted(target.glob("*.jsonl"))] != [d for d, _ in parts]:
        raise IntegrityError(f"{target} does not hold what its name says")
    return str(target)


def write_label_outputs(images: DataFrame, labels: DataFrame, unmatched: DataFrame, coverage: DataFrame, root: str) -> None:
    """The files of a labelling: images.jsonl (a folder of parts), labels.jsonl, unmatched.csv in order of position, summary.json."""
    write_json_lines(images, f"{root}/images.jsonl", ["image_id"])
    write_json_lines(labels, f"{root}/labels.jsonl", ["field", "phrase"])
    write_csv(unmatched, f"{root}/unmatched.csv", ["field", "position"])
    write_json(f"{root}/summary.json", {r["field"]: {k: v for k, v in r.asDict().items() if k != "field"} for r in coverage.orderBy("field").collect()})
