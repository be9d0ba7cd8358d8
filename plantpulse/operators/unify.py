"""Hot plus cold union and the reports over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.functions import parse_ts, partition_label, round_half_up
from plantpulse.operators.fleet import top_n


def hot_side(stats: DataFrame) -> DataFrame:
    return stats.select("device_id", F.col("avg_temp_c").alias("value"), F.col("window_start").alias("ts"),
                        F.lit(C.SOURCE_HOT).alias("source"))


def cold_side(lake: DataFrame) -> DataFrame:
    # real timestamps on both sides; comparing the two text formats would misorder rows
    return lake.where("temperature_c IS NOT NULL AND device_id IS NOT NULL").select(
        "device_id", F.col("temperature_c").alias("value"), parse_ts("ts").alias("ts"), F.lit(C.SOURCE_COLD).alias("source"))


def unify(hot: DataFrame | None, cold: DataFrame | None) -> DataFrame:
    """Bag union with a source tag; with one side absent it is the other side."""
    sides = [side for side in (hot_side(hot) if hot is not None else None,
                               cold_side(cold) if cold is not None else None) if side is not None]
    if not sides:
        raise ValueError("at least one side is needed")
    return sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])


def unified_stats(unified: DataFrame, threshold: float = C.ALERT_THRESHOLD_C) -> DataFrame:
    return (
        unified.where(F.col("value").isNotNull()).groupBy("source", "device_id")
        .agg(F.count(F.lit(1)).alias("registros"), round_half_up(F.avg("value"), 2).alias("media_c"),
             round_half_up(F.min("value"), 2).alias("min_c"), round_half_up(F.max("value"), 2).alias("max_c"),
             round_half_up(F.stddev_samp("value"), 2).alias("desv_std"),
             F.count_if(F.col("value") > threshold).alias("sobre_umbral"))
        .orderBy("source", "device_id")
    )


def source_summary(unified: DataFrame, *by: str) -> DataFrame:
    return unified.groupBy(*by).agg(
        F.count("value").alias("registros"), round_half_up(F.avg("value"), 2).alias("temp_media"),
        round_half_up(F.max("value"), 2).alias("temp_max"), round_half_up(F.min("value"), 2).alias("temp_min"))


def source_counts(unified: DataFrame) -> DataFrame:
    return unified.groupBy("source").agg(F.count(F.lit(1)).alias("registros"))


def latest_of_both(unified: DataFrame, n: int = 5000) -> DataFrame:
    """Newest ``n`` rows of the union; rows of one time are in order of device, source and value."""
    return top_n(unified, n, F.col("ts").desc(), F.col("device_id"), F.col("source"), F.col("value"))


def source_share(unified: DataFrame) -> DataFrame:
    hot = F.count_if(F.col("source") == C.SOURCE_HOT)
    cold = F.count_if(F.col("source") == C.SOURCE_COLD)
    total = F.count(F.lit(1))
    return unified.agg(hot.alias("hot"), cold.alias("cold"),
                       F.round(F.try_divide(hot * 100.0, total), 6).alias("hot_pct"),
                       F.round(F.try_divide(cold * 100.0, total), 6).alias("cold_pct"))


def coverage(unified: DataFrame) -> DataFrame:
    return unified.groupBy("source").agg(F.min("ts").alias("desde"), F.max("ts").alias("hasta"))


def rows_per_partition(lake: DataFrame) -> DataFrame:
    parts = lake.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("registros"))
    return parts.withColumn("particion", partition_label()).orderBy("year", "month", "day", "hour")


def lake_device_stats(lake: DataFrame) -> DataFrame:
    return lake.groupBy("device_id").agg(
        F.count("temperature_c").alias("registros"), round_half_up(F.avg("temperature_c"), 2).alias("temp_media"),
        round_half_up(F.max("temperature_c"), 2).alias("temp_max"), round_half_up(F.min("temperature_c"), 2).alias("temp_min"),
        round_half_up(F.stddev_samp("temperature_c"), 2).alias("desv_std"))
