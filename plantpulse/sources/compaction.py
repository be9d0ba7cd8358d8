"""Compaction of a lake's small files, published by a manifest: readers see the old set of files or the new one.

Beside its hour folders a lake may have ``_compact/v=<n>``, whole hours written anew, and ``_manifests/v=<n>``, which names
the files that the compacted ones stand for. A manifest appears by one rename, so a reader never sees half of it; files
that were added after it are read as before.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITIONS = ("year", "month", "day", "hour")
ENTRY = "file STRING, action STRING, version BIGINT, at TIMESTAMP"
REPLACED, ADDED = "replaced", "added"


def _paths(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def latest_version(spark: SparkSession, path: str) -> int | None:
    """Number of the manifest that is in force; None for a lake that was never compacted."""
    at, files = _paths(spark, f"{path}/_manifests/v=*")
    found = [int(f.getPath().getName().removeprefix("v=")) for f in files.globStatus(at) or []]
    return max(found, default=None)


def manifest(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(f"{path}/_manifests/v={version}")


def _listing(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file"), "length")


def _hour_of(file: str) -> list[Column]:
    return [F.regexp_extract(file, f"{name}=([^/]+)/", 1).alias(name) for name in PARTITIONS]


@dataclass
class FileSet:
    """The files that make up a lake: plain ones in its hour folders, and compacted ones by version."""

    plain: list[str]
    compacted: dict[int, list[str]]

    def read(self, spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
        parts = [(path, self.plain)] + [(f"{path}/_compact/v={v}", files) for v, files in sorted(self.compacted.items())]
        frames = [spark.read.schema(schema).option("basePath", base).json(files) for base, files in parts if files]
        if not frames:
            return spark.createDataFrame([], schema)
        out = frames[0]
        for other in frames[1:]:
            out = out.unionByName(other)
        return out


def active_files(spark: SparkSession, path: str, version: int | None = None, hours: DataFrame | None = None) -> FileSet:
    """The files in force under a manifest, the latest by default; of some hours only, if given."""
    version = latest_version(spark, path) if version is None else version
    entries = manifest(spark, path, version)
    gone = entries.where(F.col("action") == REPLACED).select("file")
    plain = _listing(spark, path).select("file").join(gone, "file", "left_anti").withColumn("version", F.lit(None).cast("bigint"))
    rows = plain.unionByName(entries.where(F.col("action") == ADDED).select("file", "version"))
    if hours is not None:
        rows = rows.select("*", *_hour_of("file")).join(hours, list(PARTITIONS), "left_semi").select("file", "version")
    found = FileSet([], {})
    for r in rows.collect():
        (found.plain if r["version"] is None else found.compacted.setdefault(r["version"], [])).append(r["file"])
    return found


def small_file_hours(spark: SparkSession, path: str, least_files: int = 2, small_bytes: int = 64 << 20) -> DataFrame:
    """Hours with at least ``least_files`` files in force that are smaller than ``small_bytes``."""
    entries = manifest(spark, path, latest_version(spark, path))
    gone = entries.where(F.col("action") == REPLACED).select("file")
    sizes = _listing(spark, path).join(gone, "file", "left_anti")
    versions = [r["version"] for r in entries.where(F.col("action") == ADDED).select("version").distinct().collect()]
    for v in versions:
        sizes = sizes.unionByName(_listing(spark, f"{path}/_compact/v={v}").join(gone, "file", "left_anti"))
    return sizes.where(F.col("length") < small_bytes).select(*_hour_of("file")).groupBy(*PARTITIONS).count().where(F.col("count") >= least_files).drop("count")


def _publish(spark: SparkSession, path: str, entries: DataFrame, version: int) -> None:
    """Write a manifest aside and rename it to its number; fails if another one took the number meanwhile."""
    aside = f"{path}/_manifests/.{uuid.uuid4().hex}"
    entries.coalesce(1).write.parquet(aside)
    source, files = _paths(spark, aside)
    target, _ = _paths(spark, f"{path}/_manifests/v={version}")
    if files.exists(target) or not files.rename(source, target):
        files.delete(source, True)
        raise RuntimeError(f"manifest {version} of {path} was published by someone else; compact again")


def compact(spark: SparkSession, path: str, schema: T.StructType, least_files: int = 2, small_bytes: int = 64 << 20) -> int | None:
    """Write the hours that have many small files anew and publish them; the new version, or None if there was nothing to do.

    The old files stay until ``vacuum``, so a reader that began before goes on with them. A compaction that fails before the
    manifest leaves files that nobody reads. Rows are counted on both sides before publishing.
    """
    hours = small_file_hours(spark, path, least_files, small_bytes)
    before = latest_version(spark, path)
    chosen = active_files(spark, path, before, hours)
    replaced = chosen.plain + [f for files in chosen.compacted.values() for f in files]
    if not replaced:
        return None
    version = (before or 0) + 1
    out = f"{path}/_compact/v={version}"
    rows = chosen.read(spark, path, schema)
    rows.hint("rebalance", *PARTITIONS).write.mode("overwrite").partitionBy(*PARTITIONS).json(out)
    written = spark.read.schema(schema).json(out)
    if written.count() != rows.count():
        raise RuntimeError(f"compacted rows of {path} differ from the old ones")
    now = F.current_timestamp()
    gone = spark.createDataFrame([(f,) for f in replaced], "file STRING")
    made = _listing(spark, out).select("file", F.lit(ADDED).alias("action"), F.lit(version).cast("bigint").alias("version"), now.alias("at"))
    kept = manifest(spark, path, before).join(gone.withColumn("action", F.lit(ADDED)), ["file", "action"], "left_anti")
    entries = kept.select("file", "action", "version", "at").unionByName(made).unionByName(
        gone.select("file", F.lit(REPLACED).alias("action"), F.lit(version).cast("bigint").alias("version"), now.alias("at")))
    _publish(spark, path, entries, version)
    return version


def vacuum(spark: SparkSession, path: str, older_than: str = "24 hours") -> int:
    """Delete files that were replaced longer ago than ``older_than``; returns their number. Readers that old find them missing."""
    before = latest_version(spark, path)
    entries = manifest(spark, path, before)
    old = (F.col("action") == REPLACED) & (F.col("at") <= F.current_timestamp() - F.expr(f"INTERVAL {older_than}"))
    gone = [r["file"] for r in entries.where(old).select("file").collect()]
    for file in gone:
        at, files = _paths(spark, file)
        files.delete(at, False)
    if gone:
        names = spark.createDataFrame([(f,) for f in gone], "file STRING")
        _publish(spark, path, entries.join(names, "file", "left_anti"), before + 1)
    return len(gone)
