import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plantpulse.operators import chunks, fleet, quantiles, reshape, trends, windows

BASE = 1773187200


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def series():
    """Several days of minutes: a device with a third of the rows, gaps, level shifts."""
    rng = np.random.default_rng(3)
    rows = []
    for d, n in enumerate([2500, 1200, 900, 2, 1]):
        minutes = np.sort(rng.choice(5 * 1440, size=n, replace=False))
        level = 60 + 5 * d + np.where(minutes > 3000, 12, 0)
        for m, v in zip(minutes.tolist(), (level + rng.normal(0, 4, n)).tolist()):
            rows.append((f"m{d}", m, round(v, 3)))
    return pd.DataFrame(rows, columns=["device_id", "m", "avg_temp_c"])


@pytest.fixture(scope="module")
def stats(spark, series):
    df = spark.createDataFrame(series, "device_id STRING, m BIGINT, avg_temp_c DOUBLE").repartition(7)
    return df.select("device_id", F.timestamp_seconds(F.lit(BASE) + F.col("m") * 60).alias("window_start"), "avg_temp_c",
                     (F.col("avg_temp_c") + 1).alias("max_temp_c"), F.lit(3).cast("bigint").alias("count_readings"),
                     (F.col("avg_temp_c") > 80).cast("int").alias("alert"), "m")


def to_pandas(df):
    return df.orderBy("device_id", "m").toPandas()


def test_rolling_matches_pandas_across_slices(series, stats):
    got = to_pandas(windows.rolling(stats))
    g = series.groupby("device_id")["avg_temp_c"]
    for name in ("mean", "std", "max"):
        want = g.transform(lambda x, f=name: getattr(x.rolling(5, min_periods=1), f)().fillna(0))
        np.testing.assert_allclose(got[f"roll_{name}"], want, rtol=1e-9, atol=1e-9)
    assert len(got) == len(series)


def test_halo_over_sparse_slices(spark):
    rows = [("m", i * 86400 * 3, float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "device_id STRING, s BIGINT, avg_temp_c DOUBLE").withColumn("window_start", F.timestamp_seconds("s"))
    got = [r.roll_mean for r in windows.rolling(df, fns=("mean",)).orderBy("s").collect()]
    assert got == pd.Series(range(12), dtype=float).rolling(5, min_periods=1).mean().tolist()


def test_ordinal_and_running(series, stats):
    got = to_pandas(windows.ordinal(stats))
    assert got["idx"].tolist() == series.groupby("device_id").cumcount().tolist()
    run = to_pandas(chunks.with_running(stats, "device_id", ["window_start"], "window_start", F.col("m"), "total"))
    assert run["total"].tolist() == series.groupby("device_id")["m"].cumsum().tolist()


def test_zscore_and_band(series, stats):
    got = to_pandas(windows.zscore(stats))
    want = series.groupby("device_id")["avg_temp_c"].transform(lambda x: (x - x.mean()) / x.std())
    np.testing.assert_allclose(got["z_score"].astype(float), want, rtol=1e-7)
    assert got["outlier"].tolist() == (want.abs() > 2).tolist()
    assert windows.sigma_band(stats).select("device_id").distinct().count() == 3


def test_tail_limits_before_the_shuffle(stats):
    tail = windows.tail_n(stats, 20)
    assert plan_of(tail).count("WindowGroupLimit") >= 2
    assert {r.device_id: r["count"] for r in tail.groupBy("device_id").count().collect()} == {"m0": 20, "m1": 20, "m2": 20, "m3": 2, "m4": 1}


def test_latest_needs_no_sort(stats, series):
    latest = fleet.latest(stats)
    assert "Window" not in plan_of(latest) and "max_by" in plan_of(latest)
    want = series.sort_values("m").groupby("device_id").tail(1).set_index("device_id")["avg_temp_c"].to_dict()
    assert {r.device_id: r.avg_temp_c for r in latest.collect()} == want


def test_aggregation_combines_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("m").alias("device_id"), F.timestamp_seconds("id").alias("event_time"),
                                  F.col("id").cast("double").alias("temperature_c"))
    plan = plan_of(windows.window_stats(df))
    assert "partial_avg" in plan and "CartesianProduct" not in plan
    assert windows.window_stats(df).count() == 17


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    values = {"a": rng.normal(70, 10, 4000).round(2), "b": np.full(1000, 5.0), "c": np.array([1.0, 2.0, 4.0, 9.0]),
              "d": np.array([3.0]), "e": np.concatenate([rng.exponential(1, 500), [1e9]])}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("a", None), ("f", None), ("c", float("nan"))]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE").repartition(6)
    probs = {"p0": 0.0, "p5": 0.05, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r.k: r for r in quantiles.exact_quantiles(df, ["k"], "v", probs).collect()}
    assert set(got) == set(values)
    for k, vs in values.items():
        np.testing.assert_allclose([got[k][p] for p in probs], np.quantile(vs, list(probs.values())), rtol=1e-12)
    everything = quantiles.exact_quantiles(df, [], "v", {"q": 0.3}).first().q
    assert everything == pytest.approx(np.quantile(np.concatenate(list(values.values())), 0.3))


def test_quantiles_of_small_groups_and_coarse_sketches(spark):
    rng = np.random.default_rng(4)
    small = {f"s{n}": rng.normal(size=n).round(1) for n in range(1, 25)}
    probs = {f"p{int(p * 1000)}": p for p in (0.0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 0.975, 1.0)}
    large = {"many": rng.normal(size=20_000), "outlier": np.concatenate([rng.random(20_000), [1e12]]), "ties": rng.integers(0, 3, 5000).astype(float)}
    for values, accuracy in ((small, quantiles.ACCURACY), (large, 100)):
        df = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs], "k STRING, v DOUBLE").repartition(5)
        for r in quantiles.exact_quantiles(df, ["k"], "v", probs, accuracy).collect():
            np.testing.assert_allclose([r[p] for p in probs], np.quantile(values[r.k], list(probs.values())), rtol=1e-12, atol=1e-12, err_msg=r.k)


def test_only_brackets_are_looked_at(spark):
    """An outlier widens no bin: a task sees the rows around the ranks only."""
    df = spark.range(200_000).select(F.rand(3).alias("v")).union(spark.sql("SELECT 1e12D AS v")).withColumn("k", F.lit("a"))
    got = quantiles.exact_quantiles(df, ["k"], "v", {"q": 0.5})
    plan = got._jdf.queryExecution().executedPlan()
    assert 0.49 < got.first().q < 0.51 and "Window" in plan.toString()


def test_histogram_counts_every_row(stats, series):
    got = quantiles.histogram(stats, "avg_temp_c", 20, "device_id").toPandas()
    assert got["n"].sum() == len(series) and got["bin"].between(0, 19).all()


def test_box_and_profile(stats, series):
    outliers = quantiles.box_outliers(stats, "avg_temp_c", "device_id").where("is_outlier").count()
    q = series.groupby("device_id")["avg_temp_c"].quantile([0.25, 0.75]).unstack()
    joined = series.join(q, on="device_id")
    iqr = joined[0.75] - joined[0.25]
    want = ((joined.avg_temp_c < joined[0.25] - 1.5 * iqr) | (joined.avg_temp_c > joined[0.75] + 1.5 * iqr)).sum()
    assert outliers == want
    row = quantiles.profile(stats).first()
    assert row.p95 == pytest.approx(np.percentile(series.avg_temp_c, 95)) and row["std"] == pytest.approx(np.std(series.avg_temp_c))


def sequential_cusum(x, threshold, drift=0.5):
    std = x.std() or 1.0
    up = down = 0.0
    breaks = []
    for i, z in enumerate((x - x.mean()) / std):
        up, down = max(0.0, up + z - drift), max(0.0, down - z - drift)
        if up > threshold or down > threshold:
            breaks.append(i)
            up = down = 0.0
    return breaks


@pytest.mark.parametrize("threshold", [2.0, 4.0, 10.0])
def test_cusum_matches_the_sequential_walk(series, stats, threshold):
    marked = trends.cusum(stats, threshold).toPandas().sort_values(["device_id", "window_start"])
    assert set(marked.device_id) == {"m0", "m1", "m2"}
    for device, part in marked.groupby("device_id"):
        x = series[series.device_id == device]["avg_temp_c"].to_numpy()
        assert np.flatnonzero(part["is_break"].to_numpy()).tolist() == sequential_cusum(x, threshold)


def test_cusum_with_short_slices_repairs_predictions(series, stats):
    marked = trends.cusum(stats, 10.0, slice_seconds=600).toPandas().sort_values(["device_id", "window_start"])
    for device, part in marked.groupby("device_id"):
        x = series[series.device_id == device]["avg_temp_c"].to_numpy()
        assert np.flatnonzero(part["is_break"].to_numpy()).tolist() == sequential_cusum(x, 10.0)


def test_regimes(series, stats):
    got = trends.regimes(trends.cusum(stats)).toPandas()
    x = series[series.device_id == "m0"]["avg_temp_c"].to_numpy()
    edges = [0, *sequential_cusum(x, 4.0), len(x)]
    want = [b - a for a, b in zip(edges, edges[1:]) if b > a]
    assert got[got.device_id == "m0"].sort_values("regimen")["puntos"].tolist() == want


@pytest.mark.parametrize("per_block", [256, 2])
def test_pairwise_corr_matches_pandas(series, stats, per_block):
    got = {(r.machine_a, r.machine_b): (r.n, r["corr"]) for r in trends.pairwise_corr(stats, per_block).collect()}
    wide = series.pivot(index="m", columns="device_id", values="avg_temp_c")
    want = wide.corr()
    for (a, b), (n, c) in got.items():
        both = wide[[a, b]].dropna()
        assert a < b and n == len(both)
        if c is not None and n > 2:
            assert c == pytest.approx(want.loc[a, b], abs=1e-9)
    assert ("m0", "m1") in got and ("m1", "m2") in got
    assert "CartesianProduct" not in plan_of(trends.pairwise_corr(stats))


def test_trend_matches_polyfit(series, stats):
    got = {r.device_id: r for r in trends.linear_trend(stats).collect()}
    assert set(got) == {"m0", "m1", "m2"}
    for device, row in got.items():
        y = series[series.device_id == device]["avg_temp_c"].to_numpy()
        slope, start = np.polyfit(np.arange(len(y)), y, 1)
        assert row.slope == pytest.approx(slope, abs=6e-5) and row.temp_inicio == pytest.approx(start, abs=6e-3)


def test_forecast_follows_a_line(spark):
    df = spark.range(50).select(F.lit("m").alias("device_id"), F.timestamp_seconds(F.lit(BASE) + F.col("id") * 60).alias("window_start"),
                                (F.col("id") * 0.5 + 60).alias("avg_temp_c"))
    rows = trends.forecast(df, 10).orderBy("step").collect()
    assert [r.yhat for r in rows] == [pytest.approx(60 + 0.5 * (49 + k)) for k in range(1, 11)]
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper and r.alert for r in rows)
    assert trends.forecast_alerts(trends.forecast(df, 10)).first().alertas == 10
    with pytest.raises(ValueError):
        trends.forecast(df, 5)


def test_service_bounds_and_unknown_device(stats):
    with pytest.raises(ValueError):
        fleet.machines_status(stats, 0)
    with pytest.raises(ValueError):
        fleet.machine_history(stats, "m0", 30, 2001)
    assert fleet.machine_history(stats, "nobody", 30).count() == 0


def test_anchor_as_parameter(stats, series):
    anchor = F.timestamp_seconds(F.lit(BASE + 1440 * 60))
    got = fleet.metric_range(stats.where(F.col("window_start") <= anchor), 60, anchor).count()
    assert got == series[(series.m >= 1380) & (series.m <= 1440)].shape[0]


def test_roster_join_keeps_silent_devices(spark, stats):
    rows = fleet.machines_summary(stats, fleet.roster_table(spark, ("m0", "m9")), 10).collect()
    assert {r.device_id: r.status for r in rows}["m9"] == "SIN DATOS" and len(rows) == 2


def test_pivot_round_trip(stats):
    wide = reshape.pivot_fields(reshape.to_long(stats))
    want = stats.select("device_id", F.col("window_start").alias("ts"), "avg_temp_c")
    assert wide.select("device_id", "ts", "avg_temp_c").exceptAll(want).count() == 0 and wide.count() == stats.count()


def test_sketches_find_the_most_correlated_devices(spark):
    """300 devices in groups that follow one signal each: recall against all pairs, and output linear in devices."""
    rng = np.random.default_rng(4)
    signals = rng.standard_normal((30, 600))
    series = np.stack([signals[d % 30] * (1 + d % 3) + rng.standard_normal(600) * 0.8 + d for d in range(300)])
    frame = pd.DataFrame({"device_id": np.repeat([f"d{d:03d}" for d in range(300)], 600), "m": np.tile(np.arange(600), 300), "avg_temp_c": series.ravel()})
    gaps = rng.random(len(frame)) < 0.05
    df = spark.createDataFrame(frame[~gaps]).select("device_id", F.timestamp_seconds(F.lit(1773187200) + F.col("m") * 60).alias("window_start"), "avg_temp_c")
    got = trends.top_correlated(df, k=5).toPandas()
    assert len(got) == 300 * 5 and got.groupby("device_id")["rank"].apply(list).map(lambda r: sorted(r) == [1, 2, 3, 4, 5]).all()
    wide = frame[~gaps].pivot(index="m", columns="device_id", values="avg_temp_c").corr()
    hit = total = 0
    for device, part in got.groupby("device_id"):
        true = wide[device].drop(device).sort_values(ascending=False)
        hit, total = hit + len(set(part["other"]) & set(true.index[:5])), total + 5
        assert np.allclose(part.sort_values("rank")["corr"], true[part.sort_values("rank")["other"]], atol=1e-9)
    assert hit / total >= 0.99


def test_sketches_of_constant_short_and_no_series(spark):
    rows = [("flat", i, 5.0) for i in range(20)] + [("a", i, float(i)) for i in range(20)] + [("b", i, 2.0 * i + (i % 2)) for i in range(20)] + [("one", 3, 1.0)]
    df = spark.createDataFrame(rows, "device_id STRING, m BIGINT, avg_temp_c DOUBLE").select("device_id", F.timestamp_seconds(F.lit(1773187200) + F.col("m") * 60).alias("window_start"), "avg_temp_c")
    got = {(r.device_id, r.other): (r["rank"], r.n) for r in trends.top_correlated(df).collect()}
    assert got == {("a", "b"): (1, 20), ("b", "a"): (1, 20)}
    assert trends.top_correlated(df.limit(0)).count() == 0
