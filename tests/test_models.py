import numpy as np
import pytest
from pyspark.sql import functions as F

from plantpulse.operators import learners
from plantpulse.operators.forest import IsolationForestJob

BASE = 1773187200


@pytest.fixture(scope="module")
def stats(spark):
    """Normal readings around 70 with a few far values."""
    rng = np.random.default_rng(5)
    rows = [(f"m{i % 4}", BASE + 60 * i, float(v)) for i, v in enumerate(rng.normal(70, 5, 1500))]
    rows += [("m0", BASE - 60 * (i + 1), v) for i, v in enumerate([120.0, 5.0, 130.0])]
    df = spark.createDataFrame(rows, "device_id STRING, s BIGINT, avg_temp_c DOUBLE")
    return df.select("device_id", F.timestamp_seconds("s").alias("window_start"), "avg_temp_c",
                     (F.col("avg_temp_c") > 80).cast("int").alias("alert"))


@pytest.fixture(scope="module")
def model(stats):
    return IsolationForestJob().fit(stats)


def test_scores_are_sane(stats, model):
    scored = model.score(stats)
    row = scored.agg(F.min("score").alias("lo"), F.max("score").alias("hi"), F.avg(F.col("is_anomaly").cast("int")).alias("share")).first()
    assert -1.0 <= row.lo < row.hi < 0.0
    # flagged share is the contamination, up to ties of the step function
    assert 0.03 < row["share"] <= 0.1 + 1 / 1503
    far = scored.where("avg_temp_c > 115 OR avg_temp_c < 10").collect()
    assert len(far) == 3 and all(r.is_anomaly for r in far)


def test_sweep_is_calm_in_the_middle(spark, model):
    curve = {r.avg_temp_c: r for r in model.sweep(spark, 40, 100, 5).collect()}
    assert len(curve) == 13
    assert not curve[70.0].is_anomaly and curve[95.0].is_anomaly and curve[40.0].is_anomaly
    assert curve[70.0].score > curve[85.0].score > curve[100.0].score - 1e-9
    assert curve[95.0].interpretation.startswith("Temperatura excepcionalmente ALTA (95.0°C > p95=")


def test_step_function_equals_walking_the_leaves(spark, model):
    leaves = model.leaves.toPandas()
    edges, scores = model._step_function()
    for x in [-1e9, 60.0, 70.123, float(edges[3]), 1e9]:
        depth = leaves[(leaves.lo < x) & (x <= leaves.hi)].groupby("tree")["depth"].first()
        assert len(depth) == 100
        at = model.score(spark.createDataFrame([(x,)], "avg_temp_c DOUBLE")).first().score
        c = 2 * (np.log(255) + 0.5772156649015329) - 2 * 255 / 256
        assert at == pytest.approx(-(2 ** (-depth.mean() / c)))


def test_fit_does_not_depend_on_partitioning(stats, model):
    again = IsolationForestJob().fit(stats.repartition(9))
    assert again.offset == model.offset
    assert sorted(map(tuple, again.leaves.collect())) == sorted(map(tuple, model.leaves.collect()))


def test_save_and_load(spark, stats, model, tmp_path):
    model.save(str(tmp_path / "forest"))
    back = type(model).load(spark, str(tmp_path / "forest"))
    want = model.score(stats).select("window_start", "score", "is_anomaly", "interpretation")
    assert back.score(stats).select(*want.columns).exceptAll(want).count() == 0
    assert back.status(spark).first().samples == 1503


def test_limits(stats):
    with pytest.raises(ValueError):
        IsolationForestJob().fit(stats.limit(9))
    with pytest.raises(ValueError):
        IsolationForestJob(contamination=0.6)


def test_constant_and_null_values(spark, stats):
    flat = stats.withColumn("avg_temp_c", F.lit(70.0))
    scored = IsolationForestJob(n_trees=10).fit(flat).score(flat)
    assert scored.where("is_anomaly").count() == 0
    missing = spark.createDataFrame([(None,)], "avg_temp_c DOUBLE")
    assert IsolationForestJob(n_trees=10).fit(stats).score(missing).first().score is None


def test_alert_classifier(stats):
    out = learners.alert_classifier(stats, n_trees=20)
    metrics = out["metrics"].first()
    assert metrics.accuracy > 0.97
    assert out["confusion"].agg(F.sum("n")).first()[0] == out["scored"].where("in_test").count()
    assert out["importances"].agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert out["scored"].count() == stats.count()
    share = out["scored"].where("in_test").count() / 1503
    assert 0.15 < share < 0.25


def test_classifier_needs_two_classes(stats):
    with pytest.raises(ValueError):
        learners.alert_classifier(stats, threshold=1000.0)


def test_clusters_separate_hot_devices(spark):
    rows = [(f"m{d}", BASE + 60 * i, (60.0 if d < 4 else 90.0) + d * 0.1 + (i % 3)) for d in range(8) for i in range(30)]
    df = spark.createDataFrame(rows, "device_id STRING, s BIGINT, avg_temp_c DOUBLE").withColumn("window_start", F.timestamp_seconds("s"))
    out = learners.cluster_devices(df, k=2, n_init=3)
    groups = {r.device_id: r.cluster for r in out["assignments"].collect()}
    assert len({groups[f"m{d}"] for d in range(4)}) == 1 and groups["m0"] != groups["m7"]
    centers = sorted(r.mean_c for r in out["centroids"].collect())
    assert centers[0] == pytest.approx(61.15, abs=0.05) and centers[1] == pytest.approx(91.55, abs=0.05)
    with pytest.raises(ValueError):
        learners.cluster_devices(df, k=6)


def test_device_codes_are_places_in_the_alphabet(spark, stats):
    names = [f"d{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(n,) for n in names for _ in range(2)], "device_id STRING").repartition(5)
    codes = learners.device_codes(df)
    assert [(r.device_id, r.device_enc) for r in codes.orderBy("device_id").collect()] == [(n, float(i)) for i, n in enumerate(names)]
    # only the table with a row per range is seen by one task
    windows = [line for line in codes._jdf.queryExecution().executedPlan().toString().split("\n") if "Window" in line]
    assert windows and not any("device_id" in line for line in windows)


def test_all_starts_move_in_the_same_passes(spark, monkeypatch):
    rows = [(f"m{d}", BASE + 60 * i, 50.0 + 15 * (d % 3) + d * 0.1 + (i % 4)) for d in range(12) for i in range(20)]
    df = spark.createDataFrame(rows, "device_id STRING, s BIGINT, avg_temp_c DOUBLE").withColumn("window_start", F.timestamp_seconds("s"))
    passes = []
    original = learners._lloyd

    def counted(points, centers, *rest):
        passes.append(len(centers))
        return original(points, centers, *rest)

    monkeypatch.setattr(learners, "_lloyd", counted)
    out = learners.cluster_devices(df, k=3, n_init=10)
    assert passes == [10]
    sizes = {r.cluster: (r.devices, r.inertia) for r in out["sizes"].collect()}
    assert sorted(n for n, _ in sizes.values()) == [4, 4, 4]
    means = [r.mean_c for r in out["centroids"].orderBy("cluster").collect()]
    assert means == sorted(means)
    # no assignment of one device to another cluster is better
    points = {r.device_id: r for r in out["assignments"].collect()}
    assert {points[f"m{d}"].cluster for d in (0, 3, 6, 9)} == {0}


def test_equal_devices_make_one_cluster(spark):
    rows = [(f"m{d}", BASE + 60 * i, 60.0) for d in range(4) for i in range(5)]
    df = spark.createDataFrame(rows, "device_id STRING, s BIGINT, avg_temp_c DOUBLE").withColumn("window_start", F.timestamp_seconds("s"))
    out = learners.cluster_devices(df, k=3)
    assert out["sizes"].agg(F.sum("devices"), F.sum("inertia")).first() == (4, 0.0)


def test_predict_one_reading(spark, model):
    hot, usual = (model.predict(spark, v, "m7").first() for v in (140.0, 70.0))
    assert hot.device_id == "m7" and hot.is_anomaly and not usual.is_anomaly
    assert hot.score < usual.score and 0 <= usual.failure_prob < hot.failure_prob <= 1
    sweep = {r.avg_temp_c: r.score for r in model.sweep(spark, 70, 70, 5).collect()}
    assert usual.score == sweep[70.0]
