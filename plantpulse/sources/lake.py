"""Hour-partitioned NDJSON lake, its file inventory, and CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantpulse import constants as C
from plantpulse.functions import partition_columns, partitions_of_path
from plantpulse.schemas import LAKE
from plantpulse.sources.compaction import PARTITIONS, active_files, compact, latest_version


def with_partitions(df: DataFrame, partition_by: str = "event", clock: Column | None = None) -> DataFrame:
    """Partition strings from the event time (replayable) or from the processing clock."""
    at = F.col("event_time") if partition_by == "event" else (F.current_timestamp() if clock is None else clock)
    # a row without a usable event time still has to land somewhere
    at = F.coalesce(at, F.timestamp_millis("_ingested_at"))
    return df.withColumns(partition_columns(at))


def write_lake(df: DataFrame, path: str, partition_by: str = "event", mode: str = "append") -> None:
    """Batch write. The rebalance hint splits a hot hour over several files and merges small ones."""
    rows = with_partitions(df, partition_by).drop("event_time")
    rows.hint("rebalance", *PARTITIONS).write.mode(mode).partitionBy(*PARTITIONS).json(path)


def stream_lake(df: DataFrame, path: str, checkpoint: str, partition_by: str = "event",
                interval: str | None = C.LAKE_FLUSH, files_per_hour: int = 4):
    """Streaming write; offsets are committed by the checkpoint after the files are written."""
    rows = with_partitions(df, partition_by).drop("event_time")
    # few files per hour and micro-batch, and a hot hour still is several tasks' work
    rows = rows.repartition(*PARTITIONS, F.pmod(F.xxhash64("device_id", "ts"), F.lit(files_per_hour)))
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        rows.writeStream.format("json").partitionBy(*PARTITIONS).option("checkpointLocation", checkpoint)
        .option("path", path).trigger(**trigger).start()
    )


def read_lake(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
              schema: T.StructType = LAKE) -> DataFrame:
    """Lake rows with string partitions. ``start`` / ``end`` are hours like ``2026-03-11 05``.

    They become predicates on the partition columns, so only those folders are read. Of a compacted lake, the files in
    force under its latest manifest are read.
    """
    compacted = latest_version(spark, path) is not None
    rows = active_files(spark, path).read(spark, path, schema) if compacted else spark.read.schema(schema).json(path)
    hour = F.concat_ws(" ", F.concat_ws("-", "year", "month", "day"), "hour")
    if start is not None:
        rows = rows.where(hour >= start)
    if end is not None:
        rows = rows.where(hour <= end)
    return rows.where("temperature_c IS NOT NULL AND device_id IS NOT NULL")


def compact_lake(spark: SparkSession, path: str, least_files: int = 2, small_bytes: int = 64 << 20) -> int | None:
    """Merge the small files of each hour that has several; the manifest version that names the new files, if any."""
    return compact(spark, path, LAKE, least_files, small_bytes)


def lake_inventory(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """One row per lake file. Only file metadata is listed, no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.round(F.col("length") / 1024.0, 1).alias("size_kb"),
                        F.col("modificationTime").alias("modified")).withColumns(partitions_of_path("path"))


def lake_inventory_by_hour(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy(*PARTITIONS).agg(F.count("path").alias("archivos"), F.sum("size_kb").alias("total_kb"))


def inventory_totals(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.count("path").alias("archivos"), F.sum("size_kb").alias("total_kb"),
                         F.min("modified").alias("oldest"), F.max("modified").alias("newest"))


def newest_files(inventory: DataFrame, n: int = 10) -> DataFrame:
    return inventory.orderBy(F.col("modified").desc(), "path").limit(n).select("path", "size_kb", "modified")


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def read_metric_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Query-result CSV: ``#`` annotation lines are skipped, the first other line is the header."""
    reader = spark.read.option("header", "true").option("comment", "#")
    return (reader.schema(schema) if schema else reader).csv(path)
