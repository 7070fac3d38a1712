"""Session helpers and the shared scratch folder used to cut lineage.

Intermediate tables (transactions, per-level occurrences, text round trips) are
written as Parquet under the folder the cluster names in
``spark.checkpoint.dir``. A machine-local fallback is created only when the
session runs in local mode and no checkpoint folder is configured (tests,
single-node runs); on a cluster a missing setting is an error.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds a side must keep to be broadcast by an explicit hint: its rows and
# the bytes of its values. Both are measured on the side as written; larger
# sides take the shuffle path.
DEFAULT_BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "basketry") -> SparkSession:
    """A local session with AQE on and the web UI off (tests, bench)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local inputs: let AQE keep more than one or two partitions, or
        # a self-join that multiplies rows 30x runs on a single core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (once per session).

    The worker processes import the functions by name, wherever the driver
    found the package; Spark distributes the archive to every executor.
    """
    sc = spark.sparkContext
    if getattr(sc, "_basketry_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="basketry-", suffix=".zip")
    atexit.register(os.unlink, path)     # Spark serves it until the driver ends
    with os.fdopen(fd, "wb") as f, zipfile.ZipFile(f, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("basketry", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._basketry_shipped = True


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, set up if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set in the runtime conf either
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
    elif re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # not local-cluster[...]
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="basketry-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every "
            "executor can reach (HDFS, S3, ...)")
    return sc.getCheckpointDir()


class Workspace:
    """A per-run folder under the checkpoint root for written tables.

    ``materialize`` writes a DataFrame once and returns a fresh DataFrame
    reading it back: the lineage is cut, a lost executor costs a re-read
    of files instead of a recomputation of the whole plan.
    """

    made: list[str] = []   # run folders of this process, for :func:`drop_since`

    def __init__(self, spark: SparkSession, root: str | None = None, *, path: str | None = None):
        """A fresh run folder, or with ``path`` the folder of an earlier run."""
        self.spark = spark
        self.reopened = path is not None
        base = path or root or checkpoint_root(spark)
        self.path = base if path else f"{base.rstrip('/')}/basketry-{uuid.uuid4().hex}"
        if self.path not in Workspace.made:
            Workspace.made.append(self.path)

    def location(self, name: str) -> str:
        return f"{self.path}/{name}"

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.location(name))

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        # what a run that was broken off left half written is written again
        df.write.mode("overwrite" if self.reopened else "errorifexists").parquet(self.location(name))
        return self.read(name, df.schema)

    def measured(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """:meth:`materialize`, and aggregates of the rows taken while they are written.

        The metrics ride on the write's own tasks (``Observation``), whose
        results count once however often a task is tried, so no other job reads
        the table to count it.
        """
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        table = self.materialize(df.observe(seen, *[c.alias(m) for m, c in metrics.items()]), name)
        return table, seen.get

    def note(self, name: str, text: str) -> None:
        """A small file beside the tables, replaced as a whole."""
        fs, path = _file(self.spark, self.location(name))
        draft = path.suffix(".draft")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.delete(path, False)
        fs.rename(draft, path)

    def noted(self, name: str) -> str | None:
        """The text of :meth:`note`; None if it was never written."""
        fs, path = _file(self.spark, self.location(name))
        for at in (path, path.suffix(".draft")):     # a draft is whole once the old note is gone
            if fs.exists(at):
                return "\n".join(r[0] for r in self.spark.read.text(at.toString()).collect())
        return None

    def drop(self) -> None:
        """Delete the run folder (call once its results are consumed).

        DataFrames returned by the run read these files lazily, so they
        become unusable afterwards. Uses the Hadoop file system of the
        session, so it works for any shared store the cluster names.
        """
        _delete(self.spark, self.path)
        if self.path in Workspace.made:
            Workspace.made.remove(self.path)


def _file(spark: SparkSession, location: str) -> tuple:
    """The Hadoop file system of a location, and its path there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _delete(spark: SparkSession, folder: str) -> None:
    fs, path = _file(spark, folder)
    fs.delete(path, True)


def drop_since(spark: SparkSession, before: int) -> None:
    """Delete the run folders made after the first ``before`` of ``Workspace.made``."""
    while len(Workspace.made) > before:
        _delete(spark, Workspace.made.pop())


def small_side(df: DataFrame, name: str, broadcast_rows: int | None,
               workspace: Workspace | None = None) -> tuple[DataFrame, bool]:
    """Write a join side once; the written table, and whether it may be broadcast.

    Rows and bytes are taken while it is written, and the caller reads the
    written table, so the side is computed once and no job only measures it.
    """
    ws = workspace or Workspace(df.sparkSession)
    if not broadcast_rows or broadcast_rows <= 0:
        return ws.materialize(df, name), False
    size = F.lit(0)
    for f in df.schema.fields:
        fixed = isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))
        size = size + (F.lit(8) if fixed else F.coalesce(
            F.octet_length(F.col(f.name).cast("string")), F.lit(0)) + F.lit(8))
    side, seen = ws.measured(df, name, n=F.count(F.lit(1)), b=F.sum(size.cast("bigint")))
    return side, seen["n"] <= broadcast_rows and (seen["b"] or 0) <= BROADCAST_BYTES
