"""Long and wide metric forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.schemas import METRIC_FIELDS


def to_long(stats: DataFrame, fields: tuple[str, ...] = METRIC_FIELDS) -> DataFrame:
    """One row per device, time and field."""
    wide = stats.select("device_id", F.col("window_start").alias("ts"), *[F.col(f).cast("double").alias(f) for f in fields])
    return wide.unpivot(["device_id", "ts"], list(fields), "field", "value")


def pivot_fields(long: DataFrame, fields: tuple[str, ...] = METRIC_FIELDS) -> DataFrame:
    """Back to one row per device and time; the field list is fixed, so no scan to find it."""
    return long.groupBy("device_id", "ts").pivot("field", list(fields)).agg(F.first("value"))


def time_device_means(stats: DataFrame) -> DataFrame:
    """The time x device matrix in long form: one row per time and device, whatever the devices."""
    return stats.groupBy("window_start", "device_id").agg(F.avg("avg_temp_c").alias("avg_temp_c"))


def pivot_devices(means: DataFrame, devices: list[str]) -> DataFrame:
    """One row per time and one column for each of the devices the caller names; other devices are not in it."""
    return means.groupBy("window_start").pivot("device_id", devices).agg(F.first("avg_temp_c"))


def coverage_matrix(unified: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """Row counts per device and source, absent combinations as 0."""
    return unified.groupBy("device_id").pivot("source", list(sources)).agg(F.count(F.lit(1))).fillna(0)
