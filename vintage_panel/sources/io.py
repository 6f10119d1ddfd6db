"""Table scans, date windows and materialised tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_table(
    spark: SparkSession, root: str | None, name: str, cols: Sequence[str] | None = None
) -> DataFrame:
    """Parquet table below ``root``, or a catalog table when ``root`` is None.

    A folder written by :func:`replace_path` is read in its current version.
    """
    df = spark.table(name) if root is None else read_path(spark, f"{root}/{name}.parquet")
    return df.select(*cols) if cols else df


def in_window(
    c: Column, start: date | None = None, end: date | None = None, closed: str = "left"
) -> Column:
    """Date-window condition; ``closed`` is ``left`` ([start, end)) or ``both``."""
    if closed not in ("left", "both"):
        raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start))
    if end is not None:
        cond = cond & ((c <= F.lit(end)) if closed == "both" else (c < F.lit(end)))
    return cond


def date_window(
    df: DataFrame,
    col: str,
    start: date | None = None,
    end: date | None = None,
    closed: str = "left",
) -> DataFrame:
    return df.filter(in_window(F.col(col), start, end, closed))


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach, as named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return named.rstrip("/")


# ---------------------------------------------------------------- replacing stored tables
POINTER = "_current"  # names the version that readers see; Spark skips names with an underscore
VERSION = "v-"
PREVIOUS = 1  # versions kept beside the current one, for readers that began before the switch


def _stamp() -> str:
    """Later versions sort after earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


class _Store:
    """A folder through Hadoop's file systems, so that any store that Spark reaches will do."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self.fs = self.path().getFileSystem(self.conf)

    def path(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def current(self) -> str | None:
        if not self.fs.exists(self.path(POINTER)):
            return None
        stream = self.fs.open(self.path(POINTER))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def switch(self, version: str) -> None:
        """One rename over the old pointer: a reader finds the old version or the new one."""
        fresh = self.path(f"{POINTER}.{version}")
        stream = self.fs.create(fresh, True)
        stream.write(bytearray(version.encode()))
        stream.close()
        fs = self.jvm.org.apache.hadoop.fs
        kind = getattr(fs, "Options$Rename")
        options = self.jvm.java.lang.reflect.Array.newInstance(kind._java_lang_class, 1)
        self.jvm.java.lang.reflect.Array.set(options, 0, kind.OVERWRITE)
        fs.FileContext.getFileContext(self.path().toUri(), self.conf).rename(fresh, self.path(POINTER), options)

    def versions(self) -> list[str]:
        """Versions that were written to their end, oldest first."""
        names = [s.getPath().getName() for s in self.fs.listStatus(self.path())]
        return sorted(n for n in names if n.startswith(VERSION) and self.fs.exists(self.path(f"{n}/_SUCCESS")))

    def prune(self, keep: int) -> None:
        now = self.current()
        older = [v for v in self.versions() if v < now]
        for version in older[: max(0, len(older) - keep)]:
            self.fs.delete(self.path(version), True)


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a folder written by :func:`replace_path`, or a plain Parquet folder."""
    store = _Store(spark, path)
    version = store.current() if store.fs.exists(store.path()) else None
    return spark.read.parquet(f"{store.folder}/{version}" if version else path)


def replace_path(
    df: DataFrame, path: str, *, partition_by: Sequence[str] = (), keep: int = PREVIOUS
) -> DataFrame:
    """Writes ``df`` as a new version below ``path``, then points readers at it.

    The switch is the rename of one small file.  Until then, and if the write fails, readers
    have the old version; those that began before it go on reading it, as ``keep`` older
    versions stay.  ``df`` may itself read ``path``.  Returns the new version.
    """
    spark = df.sparkSession
    store = _Store(spark, path)
    version = VERSION + _stamp()
    target = f"{store.folder}/{version}"
    try:
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(target)
    except Exception:
        store.fs.delete(store.path(version), True)
        raise
    store.switch(version)
    store.prune(keep)
    return spark.read.schema(df.schema).parquet(target)


def replace_table(
    df: DataFrame,
    name: str,
    *,
    bucket_by: str | None = None,
    buckets: int = 200,
    partition_by: Sequence[str] = (),
    keep: int = PREVIOUS,
) -> DataFrame:
    """Create or replace the catalog table ``name``, without a moment in which it is missing.

    Each version is a table of its own; ``name`` is a view of the current one, switched by a single
    change of the catalog, whatever the new schema.  With ``bucket_by``, rows are hashed by that column into
    ``buckets`` sorted files, so later aggregates and joins by it move no rows (see
    ``skew.CO_LOCATED``); tables that meet in a join need the same number of buckets.
    """
    spark = df.sparkSession
    version = f"{name}__{_stamp().replace('-', '_')}"
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        # one task per bucket, so a bucket is one file and not one per task
        writer = df.repartition(buckets, bucket_by).write.format("parquet")
        writer = writer.partitionBy(*partition_by) if partition_by else writer
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    try:
        writer.saveAsTable(version)
    except Exception:
        spark.sql(f"drop table if exists {version}")
        raise
    spark.sql(f"create or replace view {name} as select * from {version}")
    database, _, own = version.lower().rpartition(".")
    tables = spark.catalog.listTables(database or None, f"{name.lower().rpartition('.')[2]}__*")
    older = sorted(t.name for t in tables if len(t.name) == len(own) and t.name < own)
    for old in older[: max(0, len(older) - keep)]:
        spark.sql(f"drop table if exists {database}.{old}" if database else f"drop table if exists {old}")
    return spark.table(name)


def materialize(
    df: DataFrame,
    target: str | None = None,
    *,
    partition_by: Sequence[str] = (),
    as_table: bool = False,
    bucket_by: str | None = None,
    buckets: int = 200,
) -> DataFrame:
    """Create or replace a stored table from ``df`` and read it back.

    Reading back cuts the lineage: a lost executor re-reads files instead of
    recomputing everything upstream.  ``target`` is a folder (:func:`replace_path`) or, with
    ``as_table``, a catalog table (:func:`replace_table`); readers see the old one until the new
    one is whole.  Without ``target`` a new folder below :func:`shared_dir` is used, which goes when the
    session ends.
    """
    spark = df.sparkSession
    if as_table:
        if target is None:
            raise ValueError("a catalog table needs a name")
        return replace_table(df, target, bucket_by=bucket_by, buckets=buckets, partition_by=partition_by)
    if bucket_by:
        raise ValueError("buckets are known to the catalog only: pass as_table")
    if target is None:
        target = f"{shared_dir(spark)}/materialized-{uuid.uuid4().hex}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return replace_path(df, target, partition_by=partition_by)
