"""Sessions, the shared work folder and materialised tables.

Jobs must survive the loss of executors, so lineage is only ever cut with a table written to the folder all
executors share (``spark.checkpoint.dir``), never with executor-local storage.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def get_session(app: str = "casegrain", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the engine relies on (UTC, AQE with skew handling, Arrow)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder is set in local mode only: on a cluster it would be another folder on each machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="casegrain-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def temporary_root(spark: SparkSession, label: str) -> str:
    """The name of a folder of its own in the shared folder; it is removed at the end of the driver's process."""
    root = f"{work_dir(spark)}/casegrain-{label}-{uuid.uuid4().hex}"
    _roots.append((spark, root))
    return root


class Tables:
    """Materialised tables of one operator run, in the shared folder.

    ``keep`` writes a DataFrame as Parquet and returns it as a scan of those files, so a later stage that loses an
    executor re-reads files rather than recomputing its whole history. ``drop`` removes tables that are no longer read.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = temporary_root(spark, label)
        self.n = 0

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:04d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.casegrain_path = path
        return out

    def keep_with(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """``keep``, with aggregates of the rows taken while they are written; the writing tasks report them once each."""
        seen = Observation()
        out = self.keep(df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), name)
        return out, seen.get

    def drop(self, *dfs: DataFrame | None) -> None:
        for df in dfs:
            path = getattr(df, "casegrain_path", None)
            if path:
                remove(self.spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder of any Hadoop file system; a path that is not there is left."""
    jvm = spark._jvm
    live = spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(live.sc().hadoopConfiguration() if live else jvm.org.apache.hadoop.conf.Configuration()).delete(p, True)


_roots: list[tuple[SparkSession, str]] = []


@atexit.register
def clean_up() -> None:
    """Removes the tables that results may still have been read from; also at the end of the driver's process."""
    while _roots:
        spark, root = _roots.pop()
        try:
            remove(spark, root)
        except Exception:  # noqa: BLE001, S112  the session may be gone
            continue


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in enough partitions for work that is heavy per byte.

    A scan is cut by bytes, so a table of a few hundred megabytes may give fewer tasks than there are cores. Only such a
    table is redistributed (by ``keys``); one with plenty of partitions is read where it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 3 * cores else df.repartition(4 * cores, *keys)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def same_names(df: DataFrame, *cols: str) -> DataFrame:
    """Exactly these columns, by position-independent name; clashes with other columns of the input go away."""
    return df.select(*[df[c] for c in cols])
