"""Event-time windows and per-device analytic functions over window statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.functions import alert_flag
from plantpulse.operators import chunks


def window_stats(df: DataFrame, window: str = C.WINDOW_LENGTH, threshold: float = C.ALERT_THRESHOLD_C) -> DataFrame:
    """Tumbling per-device statistics with the alert flag.

    The same code serves batch and streaming. The aggregates combine on the map
    side, so the shuffle carries one row per device, window and task.
    """
    return (
        df.where(F.col("temperature_c").isNotNull())
        .groupBy("device_id", F.window("event_time", window).alias("w"))
        .agg(F.avg("temperature_c").alias("avg_temp_c"), F.max("temperature_c").alias("max_temp_c"),
             F.count(F.lit(1)).alias("count_readings"))
        .select("device_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "avg_temp_c", "max_temp_c", "count_readings",
                alert_flag("avg_temp_c", threshold).cast("int").alias("alert"))
    )


def rolling(df: DataFrame, value: str = "avg_temp_c", n: int = 5, fns: tuple[str, ...] = ("mean", "std", "max"),
            key: str = "device_id", order: str = "window_start") -> DataFrame:
    """Trailing ``n``-row mean / sample std / max, from the first row on; std of one row is 0."""
    extended = chunks.with_halo(chunks.with_slice(df, order, chunks.DAY), key, [order], n - 1)
    frame = chunks.slice_window(key, [order]).rowsBetween(-(n - 1), 0)
    available = {
        "mean": F.avg(value).over(frame),
        "std": F.coalesce(F.stddev_samp(value).over(frame), F.lit(0.0)),
        "max": F.max(value).over(frame),
    }
    return chunks.without_halo(extended.withColumns({f"roll_{f}": available[f] for f in fns}))


def bollinger(df: DataFrame, value: str = "avg_temp_c", n: int = 5, k: float = 2.0) -> DataFrame:
    bands = rolling(df, value, n, ("mean", "std"))
    return bands.withColumns({
        "upper_band": F.col("roll_mean") + k * F.col("roll_std"),
        "lower_band": F.col("roll_mean") - k * F.col("roll_std"),
    })


def with_device_stats(df: DataFrame, value: str, key: str = "device_id", population: bool = False) -> DataFrame:
    """Attach mean, std and count of the row's device by aggregate and join.

    No sort of the big side; the small side is broadcast only when its size
    is under the session threshold, and a hot device is split by the skew join.
    """
    std = F.stddev_pop(value) if population else F.stddev_samp(value)
    stats = df.groupBy(key).agg(F.avg(value).alias("_mean"), std.alias("_std"), F.count(value).alias("_n"))
    return df.join(stats, key)


def zscore(df: DataFrame, value: str = "avg_temp_c", cut: float = 2.0) -> DataFrame:
    z = F.try_divide(F.col(value) - F.col("_mean"), F.col("_std"))
    return (
        with_device_stats(df, value).withColumn("z_score", z)
        .withColumn("outlier", F.coalesce(F.abs("z_score") > cut, F.lit(False)))
        .drop("_mean", "_std", "_n")
    )


def sigma_band(df: DataFrame, value: str = "avg_temp_c") -> DataFrame:
    """value ± one sample std of its device, for devices with more than two rows."""
    return (
        with_device_stats(df, value).where("_n > 2")
        .withColumns({"band_low": F.col(value) - F.col("_std"), "band_high": F.col(value) + F.col("_std")})
        .drop("_mean", "_std", "_n")
    )


def tail_n(df: DataFrame, n: int = 20, key: str = "device_id", order: list[str] | None = None) -> DataFrame:
    """Newest ``n`` rows per device.

    The rank filter is applied before the shuffle too (window group limit), so
    each task sends at most ``n`` rows per device however hot the device is.
    """
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in (order or ["window_start"])])
    return df.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= n).drop("_rn")


def ordinal(df: DataFrame, key: str = "device_id", order: str = "window_start") -> DataFrame:
    return chunks.ordinal(df, key, [order], order)


def alert_intervals(stats: DataFrame) -> DataFrame:
    """One interval [ts, ts + 1 minute] per window in alert."""
    return stats.where("alert = 1").select(
        "device_id", F.col("window_start").alias("start"),
        (F.col("window_start") + F.expr("INTERVAL 1 MINUTE")).alias("finish"), "avg_temp_c",
    )
