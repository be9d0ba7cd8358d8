"""Trend, forecast, correlation and change-point jobs over window statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.functions import round_half_up, time_bucket, trend_label
from plantpulse.operators import chunks, folds
from plantpulse.operators.chunks import SLICE
from plantpulse.operators.windows import ordinal, with_device_stats
from plantpulse.session import cut

TS = "window_start"
SHIFT = 70.0  # subtracted before summing products, so large sums keep their digits


def linear_trend(stats: DataFrame, min_n: int = 3) -> DataFrame:
    """Least-squares line of the average over the row position, per device."""
    lines = ordinal(stats).groupBy("device_id").agg(
        F.regr_slope("avg_temp_c", F.col("idx").cast("double")).alias("_slope"),
        F.regr_intercept("avg_temp_c", F.col("idx").cast("double")).alias("_start"),
        F.count("avg_temp_c").alias("n"),
    ).where(F.col("n") >= min_n)
    return lines.select(
        "device_id", "n", round_half_up("_slope", 4).alias("slope"), trend_label("_slope").alias("tendencia"),
        round_half_up("_start", 2).alias("temp_inicio"),
        round_half_up(F.col("_start") + F.col("_slope") * (F.col("n") - 1), 2).alias("temp_final"))


def forecast(stats: DataFrame, horizon_minutes: int = 30, z: float = 1.96, min_n: int = 3,
             threshold: float = C.ALERT_THRESHOLD_C) -> DataFrame:
    """Per-device linear forecast, one row per future minute with a 95 % band."""
    if not 10 <= horizon_minutes <= 60:
        raise ValueError("horizon_minutes must lie in 10..60")
    # minutes since a fixed origin keep gaps in the series; small numbers keep the sums exact
    minute = (F.unix_seconds(F.col(TS).cast("timestamp")) - F.lit(1_767_225_600)) / 60.0
    points = stats.select("device_id", minute.alias("_x"), F.col("avg_temp_c").alias("_y"), TS)
    lines = points.groupBy("device_id").agg(
        F.regr_slope("_y", "_x").alias("_b"), F.avg("_x").alias("_mx"), F.avg("_y").alias("_my"),
        F.regr_syy("_y", "_x").alias("_syy"), F.regr_sxy("_y", "_x").alias("_sxy"),
        F.count("_y").alias("_n"), F.max("_x").alias("_last"), F.max(TS).alias("_last_ts"),
    ).where(F.col("_n") >= min_n)
    residual = F.sqrt(F.greatest(F.lit(0.0), F.col("_syy") - F.col("_b") * F.col("_sxy")) / (F.col("_n") - 2))
    future = lines.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon_minutes))))
    yhat = F.col("_my") + F.col("_b") * (F.col("_last") + F.col("step") - F.col("_mx"))
    return future.select(
        "device_id", "step", (F.col("_last_ts") + F.make_dt_interval(mins=F.col("step"))).alias("ts"), yhat.alias("yhat"),
        (yhat - z * residual).alias("yhat_lower"), (yhat + z * residual).alias("yhat_upper"),
        (yhat > threshold).alias("alert"))


def forecast_alerts(forecasted: DataFrame) -> DataFrame:
    """Predicted alert minutes and the last prediction per device."""
    return forecasted.groupBy("device_id").agg(
        F.count_if("alert").alias("alertas"), F.max_by("yhat", "step").alias("yhat"),
        F.max_by("yhat_lower", "step").alias("yhat_lower"), F.max_by("yhat_upper", "step").alias("yhat_upper"))


def pairwise_corr(stats: DataFrame, devices_per_block: int = 256, slice_seconds: int = chunks.DAY) -> DataFrame:
    """Pearson correlation of every device pair over their common minutes.

    Pairs of rows are never produced: each group holds one day of two device
    blocks as a matrix and emits only the six sums per pair.
    """
    means = stats.groupBy("device_id", TS).agg(F.avg("avg_temp_c").alias("v")).where("v IS NOT NULL")
    devices = stats.agg(F.count_distinct("device_id")).first()[0]
    blocks = max(1, -(-devices // devices_per_block))
    sums = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    own = F.pmod(F.xxhash64("device_id"), F.lit(blocks)).cast("int")
    others = F.sequence(F.lit(0), F.lit(blocks - 1))
    placed = (
        means.select("device_id", F.unix_seconds(F.col(TS).cast("timestamp")).alias("t"), (F.col("v") - SHIFT).alias("v"),
                     time_bucket(TS, slice_seconds).alias("_slice"), own.alias("_own"))
        .withColumn("_other", F.explode(others))
        .withColumn("_lo", F.least("_own", "_other")).withColumn("_hi", F.greatest("_own", "_other"))
    )

    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        grid = pdf.pivot(index="t", columns="device_id", values="v")
        x = grid.to_numpy()
        names = grid.columns.to_numpy()
        block = pdf.drop_duplicates("device_id").set_index("device_id")["_own"].reindex(names).to_numpy()
        lo, hi = pdf["_lo"].iat[0], pdf["_hi"].iat[0]
        seen = (~np.isnan(x)).astype(float)
        x = np.nan_to_num(x)
        made = {"n": seen.T @ seen, "sx": x.T @ seen, "sy": seen.T @ x, "sxx": (x * x).T @ seen,
                "syy": seen.T @ (x * x), "sxy": x.T @ x}
        # each pair belongs to one block pair only
        wanted = (names[:, None] < names[None, :]) & (made["n"] > 0)
        wanted &= ((block[:, None] == lo) & (block[None, :] == hi)) | ((block[:, None] == hi) & (block[None, :] == lo))
        a, b = np.nonzero(wanted)
        return pd.DataFrame({"machine_a": names[a], "machine_b": names[b], **{k: m[a, b] for k, m in made.items()}})

    schema = "machine_a STRING, machine_b STRING, " + ", ".join(f"{s} DOUBLE" for s in sums)
    total = placed.groupBy("_slice", "_lo", "_hi").applyInPandas(partial, schema).groupBy("machine_a", "machine_b").agg(
        *[F.sum(s).alias(s) for s in sums])
    cov = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    corr = F.when((F.col("n") > 1) & (vx > 0) & (vy > 0), cov / F.sqrt(vx * vy))
    return total.select("machine_a", "machine_b", F.col("n").cast("bigint").alias("n"), corr.alias("corr"))


def _signs(times: np.ndarray, size: int) -> np.ndarray:
    """A row of ``size`` signs per time, the same wherever that time stands."""
    words = (times.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)) ^ (np.arange(size // 64, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        words = (words ^ (words >> np.uint64(shift))) * np.uint64(factor)
    words ^= words >> np.uint64(31)
    bits = np.unpackbits(words.view(np.uint8).reshape(len(times), -1), axis=1)
    return bits.astype(np.float32) * 2 - 1


def series_sketches(means: DataFrame, size: int = 512, slice_seconds: int = chunks.DAY) -> DataFrame:
    """(device_id, sketch): random projections of each device's standardized series to ``size`` numbers, of length 1.

    The inner product of two sketches estimates the correlation of the series, with an error of about 1 / sqrt(size).
    ``means`` has device_id, t (seconds) and v. A task projects one day of a device; the days are then added up.
    """
    scale = means.groupBy("device_id").agg(F.avg("v").alias("_m"), F.stddev_pop("v").alias("_s")).where("_s > 0")
    scaled = means.join(scale, "device_id").select("device_id", "t", ((F.col("v") - F.col("_m")) / F.col("_s")).alias("z"), F.floor(F.col("t") / slice_seconds).alias("_slice"))

    def project(pdf: pd.DataFrame) -> pd.DataFrame:
        made = pdf["z"].to_numpy(np.float32) @ _signs(pdf["t"].to_numpy(), size)
        return pd.DataFrame({"device_id": [pdf["device_id"].iat[0]], "part": [made.astype(float)]})

    parts = scaled.groupBy("device_id", "_slice").applyInPandas(project, "device_id STRING, part ARRAY<DOUBLE>")
    zeros = F.array_repeat(F.lit(0.0), size)
    whole = parts.groupBy("device_id").agg(F.aggregate(F.collect_list("part"), zeros, lambda s, x: F.zip_with(s, x, lambda a, b: a + b)).alias("sketch"))
    length = F.sqrt(F.aggregate("sketch", F.lit(0.0), lambda s, x: s + x * x))
    return whole.withColumn("_l", length).where("_l > 0").select("device_id", F.transform("sketch", lambda x: (x / F.col("_l")).cast("float")).alias("sketch"))


def correlation_candidates(sketches: DataFrame, wanted: int, rows: int = 2_048, columns: int = 65_536) -> DataFrame:
    """(device_id, other): for each device the ``wanted`` others whose sketches are nearest to its own.

    A group holds ``rows`` devices and ``columns`` others, multiplies their sketches and gives out ``wanted`` rows a device;
    the best of all groups stay. So the output grows with the devices, and no pair is a row unless it is among the best.
    """
    devices = sketches.count()
    tall, wide = max(1, -(-devices // rows)), max(1, -(-devices // columns))
    place = F.xxhash64("device_id")
    left = sketches.select("device_id", "sketch", F.pmod(place, F.lit(tall)).cast("int").alias("_a"), F.explode(F.sequence(F.lit(0), F.lit(wide - 1))).alias("_b"))
    right = sketches.select("device_id", "sketch", F.explode(F.sequence(F.lit(0), F.lit(tall - 1))).alias("_a"), F.pmod(place, F.lit(wide)).cast("int").alias("_b"))

    def best(mine: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(mine) and len(others):
            own, names = np.stack(mine["sketch"]), others["device_id"].to_numpy()
            near = own @ np.stack(others["sketch"]).T
            near[mine["device_id"].to_numpy()[:, None] == names[None, :]] = -np.inf
            top = np.argpartition(-near, min(wanted, near.shape[1]) - 1, axis=1)[:, :wanted]
            at = np.repeat(np.arange(len(mine)), top.shape[1])
            found = pd.DataFrame({"device_id": mine["device_id"].to_numpy()[at], "other": names[top.ravel()], "near": near[at, top.ravel()].astype(float)})
            out.append(found[np.isfinite(found["near"])])
        return pd.concat(out) if out else pd.DataFrame({"device_id": [], "other": [], "near": []})

    met = left.groupBy("_a", "_b").cogroup(right.groupBy("_a", "_b")).applyInPandas(best, "device_id STRING, other STRING, near DOUBLE")
    order = Window.partitionBy("device_id").orderBy(F.desc("near"), "other")
    return met.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= wanted).select("device_id", "other")


def top_correlated(stats: DataFrame, k: int = 10, oversample: int = 4, size: int = 512) -> DataFrame:
    """The ``k`` devices that correlate most with each device over their common minutes: device_id, rank, other, n, corr.

    Where all pairs are too many: sketches give ``k * oversample`` candidates a device, whose correlation is then computed
    exactly, each pair once. Ties go to the smaller name. A device whose values never change has no partners.
    """
    means = cut(stats.groupBy("device_id", TS).agg(F.avg("avg_temp_c").alias("v")).where("v IS NOT NULL").select(
        "device_id", F.unix_seconds(F.col(TS).cast("timestamp")).alias("t"), (F.col("v") - SHIFT).alias("v")), "corr-means")
    candidates = correlation_candidates(cut(series_sketches(means, size), "corr-sketches"), k * oversample)
    pairs = candidates.select(F.least("device_id", "other").alias("a"), F.greatest("device_id", "other").alias("b")).distinct()
    pairs = cut(pairs, "corr-pairs")
    side = lambda name, value: means.select(F.col("device_id").alias(name), "t", F.col("v").alias(value))
    met = pairs.join(side("a", "x"), "a").join(side("b", "y"), ["b", "t"])
    exact = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.corr("x", "y").alias("corr")).where("corr IS NOT NULL AND NOT isnan(corr)")
    ends = F.explode(F.array(F.struct(F.col("a").alias("device_id"), F.col("b").alias("other")), F.struct(F.col("b").alias("device_id"), F.col("a").alias("other"))))
    both = exact.select(ends.alias("_p"), "n", "corr").select("_p.*", "n", "corr")
    order = Window.partitionBy("device_id").orderBy(F.desc("corr"), "other")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("device_id", "rank", "other", "n", "corr")


def corr_with(stats: DataFrame, device: str) -> DataFrame:
    """Correlation of one device with each other one: as many rows as devices, where all pairs are too many."""
    own = stats.where(F.col("device_id") == device).select("window_start", F.col("avg_temp_c").alias("_own"))
    met = stats.where(F.col("device_id") != device).join(own, "window_start")
    return met.groupBy("device_id").agg(F.count(F.lit(1)).alias("n"), F.corr("avg_temp_c", "_own").alias("corr"))


def ranked_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select("machine_a", "machine_b", round_half_up("corr", 3).alias("corr")).orderBy(
        F.col("corr").desc(), "machine_a", "machine_b")


def _cusum_step(threshold: float, drift: float):
    def step(state, z):
        up, down = state
        up, down = max(0.0, up + z - drift), max(0.0, down - z - drift)
        alarm = up > threshold or down > threshold
        return (alarm, up, down), ((0.0, 0.0) if alarm else (up, down))

    return step


def cusum(stats: DataFrame, threshold: float = 4.0, drift: float = 0.5, min_n: int = 10,
          slice_seconds: int = chunks.DAY) -> DataFrame:
    """Two-sided CUSUM per device on population z-values; both sums restart at an alarm.

    A slice's sums depend little on where they started, so the end of each
    slice run from zero predicts the start of the next; wrong predictions are
    found and folded again.
    """
    if not 2 <= threshold <= 10:
        raise ValueError("threshold must lie in 2..10")
    std = F.when(F.col("_std") > 0, F.col("_std")).otherwise(1.0)
    rows = (
        chunks.with_slice(with_device_stats(stats, "avg_temp_c", population=True), TS, slice_seconds)
        .where(F.col("_n") >= min_n)
        .select("device_id", F.unix_micros(F.col(TS).cast("timestamp")).alias("_ts"), "avg_temp_c",
                ((F.col("avg_temp_c") - F.col("_mean")) / std).alias("_z"), *SLICE)
    )
    rows = cut(rows, "cusum-rows")
    state = ["_up", "_down"]
    fold = folds.stepper(_cusum_step(threshold, drift), ["device_id", *SLICE], ["_z"], ["_ts", "avg_temp_c"],
                         ["is_break", "s_pos", "s_neg"], state)
    schema = ("device_id STRING, _slice BIGINT, _part BIGINT, _ts BIGINT, avg_temp_c DOUBLE, is_break BOOLEAN, s_pos DOUBLE, s_neg DOUBLE, "
              "_up DOUBLE, _down DOUBLE")
    slices = rows.select("device_id", *SLICE).distinct()
    zeros = slices.withColumns({c: F.lit(0.0) for c in state}).withColumn("_kind", F.lit(0))
    first = folds.ordered(
        rows.withColumn("_kind", F.lit(1)).unionByName(zeros, allowMissingColumns=True).na.fill(0, ["_ts"]),
        ["device_id", *SLICE], ["_kind", "_ts"], fold, schema)
    ends = first.groupBy("device_id", *SLICE).agg(F.max_by(F.struct(*state), "_ts").alias("_end"))
    previous = F.lag("_end").over(Window.partitionBy("device_id").orderBy(*SLICE))
    entries = cut(ends.select("device_id", *SLICE, *[F.coalesce(previous[c], F.lit(0.0)).alias(c) for c in state]),
                  "cusum-entries")
    marked = folds.sliced(rows, entries, "device_id", ["_ts"], state, [0.0, 0.0], fold, schema, "cusum")
    return marked.select("device_id", F.timestamp_micros("_ts").alias(TS), "avg_temp_c", "is_break", "s_pos", "s_neg")


def regimes(marked: DataFrame) -> DataFrame:
    """Segments between change points: position, time range, size, mean, std."""
    one = F.col("is_break").cast("bigint")
    segmented = chunks.with_running(marked, "device_id", [TS], TS, one, "_breaks")
    parts = segmented.groupBy("device_id", "_breaks").agg(
        F.min(TS).alias("desde"), F.max(TS).alias("hasta"), F.count(F.lit(1)).alias("puntos"),
        round_half_up(F.avg("avg_temp_c"), 2).alias("media_c"), round_half_up(F.stddev_samp("avg_temp_c"), 2).alias("std_c"))
    # a break on the very first row leaves no rows before it, yet that empty regime is counted
    return parts.select("device_id", (F.col("_breaks") + 1).alias("regimen"), "desde", "hasta", "puntos", "media_c", "std_c")
