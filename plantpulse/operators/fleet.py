"""Queries over window statistics: ranges, latest values, summaries, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.functions import heat_color, round_half_up, status_label
from plantpulse.operators.quantiles import exact_quantiles

TS = "window_start"


def _anchor(df: DataFrame, anchor: Column | None, ts: str = TS) -> Column:
    """Right end of a relative range. The default is the newest row, as a scalar subquery."""
    return df.select(F.max(ts)).scalar() if anchor is None else anchor


def metric_range(df: DataFrame, minutes: int, anchor: Column | None = None, device_id: str | None = None,
                 ts: str = TS) -> DataFrame:
    """Rows of the last ``minutes`` before the anchor, optionally of one device."""
    rows = df.where(F.col("device_id") == device_id) if device_id is not None else df
    return rows.where(F.col(ts) >= _anchor(df, anchor, ts) - F.make_dt_interval(mins=F.lit(minutes)))


def non_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def over_threshold(df: DataFrame, threshold: float = C.ALERT_THRESHOLD_C, value: str = "avg_temp_c") -> DataFrame:
    return df.where(F.col(value) > threshold)


def in_alert(df: DataFrame) -> DataFrame:
    return df.where("alert = 1")


def latest(stats: DataFrame, minutes: int | None = None, anchor: Column | None = None) -> DataFrame:
    """Newest row per device. ``max_by`` keeps one row per device and task, without a sort."""
    rows = stats if minutes is None else metric_range(stats, minutes, anchor)
    # one max_by per column: fixed-width buffers keep this a hash aggregate
    others = [F.max_by(c, TS).alias(c) for c in rows.columns if c != "device_id"]
    return rows.groupBy("device_id").agg(*others)


def latest_in_alert(stats: DataFrame, minutes: int = 60, anchor: Column | None = None,
                    threshold: float = C.ALERT_THRESHOLD_C) -> DataFrame:
    """Newest over-threshold row per device."""
    return latest(over_threshold(metric_range(stats, minutes, anchor), threshold))


def panels(stats: DataFrame, minutes: int = 30, anchor: Column | None = None) -> DataFrame:
    """Active devices, devices in alert, mean and maximum of the last values."""
    return latest(stats, minutes, anchor).agg(
        F.count(F.lit(1)).alias("active"), F.count_if(F.col("alert") == 1).alias("in_alert"),
        F.avg("avg_temp_c").alias("mean_last"), F.max("max_temp_c").alias("max_last"))


def device_stats(stats: DataFrame) -> DataFrame:
    """count, mean, min, max of the window averages."""
    return stats.groupBy("device_id").agg(
        F.count("avg_temp_c").alias("count"), F.avg("avg_temp_c").alias("mean_c"),
        F.min("avg_temp_c").alias("min_c"), F.max("avg_temp_c").alias("max_c"))


def device_short_summary(stats: DataFrame) -> DataFrame:
    return stats.groupBy("device_id").agg(
        round_half_up(F.avg("avg_temp_c"), 2).alias("temp_media"), round_half_up(F.max("max_temp_c"), 2).alias("temp_max"),
        F.sum("count_readings").alias("lecturas"), F.sum("alert").alias("alertas"))


def device_profile(stats: DataFrame) -> DataFrame:
    """Full per-device profile with quartiles and alert share, rounded as displayed."""
    base = stats.groupBy("device_id").agg(
        F.count("avg_temp_c").alias("ventanas"), F.avg("avg_temp_c").alias("m"), F.max("max_temp_c").alias("hi"),
        F.min("avg_temp_c").alias("lo"), F.stddev_samp("avg_temp_c").alias("s"),
        F.sum("alert").alias("alertas"), F.sum("count_readings").alias("lecturas_total"))
    quartiles = exact_quantiles(stats, ["device_id"], "avg_temp_c", {"q1": 0.25, "q3": 0.75})
    q = [round_half_up(c, 2) for c in ("q1", "q3")]
    return base.join(quartiles, "device_id", "left").select(
        "device_id", "ventanas", round_half_up("m", 2).alias("temp_media"), round_half_up("hi", 2).alias("temp_max"),
        round_half_up("lo", 2).alias("temp_min"), round_half_up("s", 2).alias("desv_std"),
        q[0].alias("p25"), q[1].alias("p75"), "alertas", "lecturas_total",
        round_half_up(F.col("alertas") * 100.0 / F.col("ventanas"), 1).alias("pct_alerta"),
        round_half_up(q[1] - q[0], 2).alias("iqr"))


def device_features(stats: DataFrame, threshold: float = C.ALERT_THRESHOLD_C) -> DataFrame:
    """Feature row per device for clustering."""
    moments = stats.groupBy("device_id").agg(
        F.avg("avg_temp_c").alias("mean_c"), F.stddev_samp("avg_temp_c").alias("std_c"),
        F.max("avg_temp_c").alias("max_c"), F.min("avg_temp_c").alias("min_c"),
        F.avg((F.col("avg_temp_c") > threshold).cast("double")).alias("alert_rate"))
    return moments.join(exact_quantiles(stats, ["device_id"], "avg_temp_c", {"p90_c": 0.9}), "device_id", "left")


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def extent(stats: DataFrame) -> DataFrame:
    """Rows, distinct timestamps, distinct devices and time range of a table."""
    return stats.agg(
        F.count(F.lit(1)).alias("filas"), F.count_distinct(TS).alias("ventanas"),
        F.count_distinct("device_id").alias("maquinas"), F.min(TS).alias("desde"), F.max(TS).alias("hasta"))


def roster(stats: DataFrame) -> DataFrame:
    return stats.select("device_id").distinct().orderBy("device_id")


def hottest_device(stats: DataFrame) -> DataFrame:
    means = stats.groupBy("device_id").agg(F.avg("avg_temp_c").alias("mean_c"))
    return means.agg(F.max_by("device_id", "mean_c").alias("device_id"), F.max("mean_c").alias("mean_c"))


def alert_summary(stats: DataFrame) -> DataFrame:
    """Alert windows per device: count, mean, peak; most alerts first."""
    return (
        in_alert(stats).groupBy("device_id")
        .agg(F.count("alert").alias("alertas"), F.avg("avg_temp_c").alias("temp_media"),
             F.max("max_temp_c").alias("temp_max_pico"))
        .orderBy(F.col("alertas").desc(), "device_id")
    )


def alert_counts(stats: DataFrame) -> DataFrame:
    return in_alert(stats).groupBy("device_id").agg(F.count(F.lit(1)).alias("alertas"))


def alerts_by_hour(stats: DataFrame) -> DataFrame:
    return in_alert(stats).groupBy(F.hour(TS).alias("hour"), "device_id").agg(F.count(F.lit(1)).alias("alertas"))


def latest_n(df: DataFrame, n: int = 5000, order: str = "ts", tie: str = "event_id") -> DataFrame:
    """Newest ``n`` rows under a total order."""
    return top_n(df, n, F.col(order).desc(), F.col(tie).desc())


def top_n(df: DataFrame, n: int, *order: Column, groups: int = 64) -> DataFrame:
    """First ``n`` rows of ``order``, merged in two steps.

    Each task keeps its ``n`` best rows; a plain limit would send those of all
    tasks to one task, here they meet in ``groups`` tasks first.
    """
    best = Window.partitionBy("_group").orderBy(*order)
    spread = df.withColumn("_group", F.spark_partition_id() % groups)
    kept = spread.withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") <= n).drop("_rn", "_group")
    return kept.orderBy(*order).limit(n)


def compare_devices(stats: DataFrame, a: str, b: str) -> DataFrame:
    """Two device series on one time axis: one aggregate over both, no self join."""
    one = lambda d: F.max(F.when(F.col("device_id") == d, F.col("avg_temp_c")))
    return (
        stats.where(F.col("device_id").isin(a, b)).groupBy(TS)
        .agg(one(a).alias("temp_a"), one(b).alias("temp_b"))
        .withColumn("diff", F.col("temp_a") - F.col("temp_b"))
    )


# --- parameterized service queries ---------------------------------------------

def _bounded(name: str, value: float, low: float, high: float) -> None:
    if not low <= value <= high:
        raise ValueError(f"{name} must lie in {low}..{high}, got {value}")


def machines_status(stats: DataFrame, range_minutes: int = 5, anchor: Column | None = None) -> DataFrame:
    """Last average and alert state of every device seen in the range."""
    _bounded("range_minutes", range_minutes, 1, 60)
    return latest(stats, range_minutes, anchor).select(
        "device_id", round_half_up("avg_temp_c", 2).alias("avg_temp_c"), (F.col("alert") == 1).alias("alert"),
        F.col(TS).alias("ts")).orderBy("device_id")


def machine_history(stats: DataFrame, device_id: str, range_minutes: int = 30, limit: int = 200,
                    anchor: Column | None = None) -> DataFrame:
    """Oldest ``limit`` windows of one device in the range; an unknown device gives no rows."""
    _bounded("range_minutes", range_minutes, 1, 1440)
    _bounded("limit", limit, 1, 2000)
    return metric_range(stats, range_minutes, anchor, device_id).select(
        "device_id", F.col(TS).alias("ts"), round_half_up("avg_temp_c", 3).alias("avg_temp_c")).orderBy("ts").limit(limit)


def alerts(stats: DataFrame, range_minutes: int = 60, anchor: Column | None = None,
           threshold: float = C.ALERT_THRESHOLD_C) -> DataFrame:
    """Windows over the threshold, newest first within each device."""
    _bounded("range_minutes", range_minutes, 1, 1440)
    return over_threshold(metric_range(stats, range_minutes, anchor), threshold).select(
        "device_id", F.col(TS).alias("ts"), round_half_up("avg_temp_c", 2).alias("avg_temp_c"),
    ).orderBy("device_id", F.col("ts").desc())


def stats_report(stats: DataFrame, range_minutes: int = 60, anchor: Column | None = None) -> DataFrame:
    _bounded("range_minutes", range_minutes, 1, 1440)
    report = device_stats(metric_range(stats, range_minutes, anchor))
    return report.select("device_id", "count", *[round_half_up(c, 2).alias(c) for c in ("mean_c", "min_c", "max_c")]
                         ).orderBy("device_id")


def roster_table(spark, devices: tuple[str, ...] = C.ROSTER) -> DataFrame:
    return spark.createDataFrame([(d,) for d in devices], "device_id STRING")


def machines_summary(stats: DataFrame, devices: DataFrame, minutes: int = 10, anchor: Column | None = None,
                     threshold: float = C.ALERT_THRESHOLD_C) -> DataFrame:
    """Every rostered device with its last average, or the no-data status."""
    last = latest(stats, minutes, anchor).select("device_id", F.col("avg_temp_c").alias("_last"))
    return devices.join(last, "device_id", "left").select(
        "device_id", round_half_up("_last", 2).alias("avg_temp_c"), status_label("_last", threshold).alias("status"),
        heat_color("_last").alias("color"))
