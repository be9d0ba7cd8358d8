"""Alert classifier on pyspark.ml, and clustering of devices."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.operators.fleet import device_features
from plantpulse.operators.ranks import ranked
from plantpulse.operators.windows import rolling
from plantpulse.session import cut

TS = "window_start"
ALERT_FEATURES = ("avg_temp_c", "hour", "minute", "device_enc", "roll_mean", "roll_std", "roll_max")
CLUSTER_FEATURES = ("mean_c", "std_c", "max_c", "alert_rate")


def alert_features(stats: DataFrame, threshold: float = C.ALERT_THRESHOLD_C) -> DataFrame:
    """Per-window features and label, before the device code is attached."""
    return rolling(stats).select(
        "device_id", TS, "avg_temp_c", F.hour(TS).alias("hour"), F.minute(TS).alias("minute"),
        "roll_mean", "roll_std", "roll_max", (F.col("avg_temp_c") > threshold).cast("int").alias("label"))


def device_codes(rows: DataFrame) -> DataFrame:
    """(device_id, device_enc): the place of each device in the sorted list of all."""
    return ranked(rows.select("device_id").distinct(), ["device_id"], name="_place").select("device_id", F.col("_place").cast("double").alias("device_enc"))


def alert_classifier(stats: DataFrame, threshold: float = C.ALERT_THRESHOLD_C, seed: int = 42,
                     n_trees: int = 100) -> dict[str, DataFrame]:
    """Random forest of the alert label: metrics, confusion, importances and scored rows.

    The 80/20 split hashes the row's key, so it does not depend on partitioning.
    """
    table = cut(alert_features(stats, threshold), "alert-features")
    classes = table.agg(F.count_distinct("label")).first()[0]
    if classes < 2:
        raise ValueError("both classes are needed: widen the time range")
    # the device's place in the alphabet, as a plain number: categories would limit the number of devices. Ranges of
    # devices are ranked by one task each; no list of devices comes to the driver or goes with the model
    codes = device_codes(table)
    coded = table.join(codes, "device_id")
    rows = VectorAssembler(inputCols=list(ALERT_FEATURES), outputCol="features").transform(coded).withColumn(
        "in_test", F.pmod(F.xxhash64("device_id", F.col(TS).cast("string"), F.lit(seed)), F.lit(100)) >= 80)
    model = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=n_trees, seed=seed, maxBins=64).fit(
        rows.where(~F.col("in_test"))).copy()  # a copy leaves the training summary, and with it the session, behind
    spark = stats.sparkSession
    scored = model.transform(rows).select(
        "device_id", TS, "avg_temp_c", "label", F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("prob_alert"), "in_test")
    test = scored.where("in_test")
    confusion = test.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    hit, said, is_alert = F.col("label") == F.col("prediction"), F.col("prediction") == 1, F.col("label") == 1
    metrics = test.agg(
        F.avg(hit.cast("double")).alias("accuracy"),
        F.coalesce(F.try_divide(F.count_if(said & is_alert), F.count_if(said)), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.count_if(said & is_alert), F.count_if(is_alert)), F.lit(0.0)).alias("recall"))
    importances = spark.createDataFrame(
        [(name, float(model.featureImportances[i])) for i, name in enumerate(ALERT_FEATURES)],
        "feature STRING, importance DOUBLE").orderBy("importance")
    return {"metrics": metrics, "confusion": confusion, "importances": importances, "scored": scored}


def _distance(point: Column, center: Column) -> Column:
    """Squared distance of two arrays of numbers."""
    return F.aggregate(F.zip_with(point, center, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)


def _centers_literal(centers: dict[int, list[list[float]]]) -> Column:
    """Centers of every start as one array of arrays, in the order of the starts."""
    return F.array(*[F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers[i]]) for i in sorted(centers)])


def _nearest(point: Column, centers: Column) -> Column:
    """struct(d, c): distance to and number of the nearest center, the first one of equally near ones."""
    each = F.transform(centers, lambda center, i: F.struct(_distance(point, center).alias("d"), i.alias("c")))
    return F.array_min(each)


def _spread_starts(points: DataFrame, k: int, n_init: int, seed: int) -> dict[int, list[list[float]]]:
    """First centers of every start: each further one is drawn with a chance in proportion to the squared distance from those
    drawn. All starts draw in the same pass, k passes in all; a draw is a race of exponential times by a hash of the device."""
    starts = F.sequence(F.lit(0), F.lit(n_init - 1))
    centers: dict[int, list[list[float]]] = {}
    for turn in range(k):
        uniform = (F.pmod(F.xxhash64("device_id", F.col("start"), F.lit(turn), F.lit(seed)), F.lit(1 << 52)) + 1) / float((1 << 52) + 1)
        weight = _nearest(F.col("z"), F.get(_centers_literal(centers), F.col("start")))["d"] if centers else F.lit(1.0)
        raced = points.withColumn("start", F.explode(starts)).withColumn("_time", F.when(weight > 0, -F.log(uniform) / weight))
        # where all devices lie on centers, the first of them is taken again
        drawn = raced.groupBy("start").agg(F.min_by("z", F.struct(F.col("_time").isNull(), "_time", "device_id")).alias("z")).collect()
        for r in drawn:
            centers.setdefault(r["start"], []).append(list(r["z"]))
    return centers


def _lloyd(points: DataFrame, centers: dict[int, list[list[float]]], rounds: int, tolerance: float) -> tuple[dict[int, list[list[float]]], dict[int, float]]:
    """Centers after Lloyd's rounds, and the sum of squared distances, of every start. A round is one pass for all starts."""
    inertia: dict[int, float] = {}
    for _ in range(rounds + 1):
        table = _centers_literal(centers)
        near = points.select("z", F.posexplode(F.transform(table, lambda own: _nearest(F.col("z"), own))).alias("start", "near"))
        size = len(next(iter(centers.values()))[0])
        sums = near.groupBy("start", "near.c").agg(
            F.count(F.lit(1)).alias("n"), F.sum("near.d").alias("d"), *[F.sum(F.col("z")[j]).alias(f"s{j}") for j in range(size)]).collect()
        moved, inertia = 0.0, dict.fromkeys(centers, 0.0)
        after = {i: list(c) for i, c in centers.items()}
        for r in sums:
            inertia[r["start"]] += r["d"]
            new = [r[f"s{j}"] / r["n"] for j in range(size)]
            moved = max(moved, sum((a - b) ** 2 for a, b in zip(new, centers[r["start"]][r["c"]])))
            after[r["start"]][r["c"]] = new
        if moved <= tolerance:
            break
        centers = after
    return centers, inertia


def cluster_devices(stats: DataFrame, k: int = 3, seed: int = 42, n_init: int = 10, threshold: float = C.ALERT_THRESHOLD_C,
                    rounds: int = 100, tolerance: float = 1e-12) -> dict[str, DataFrame]:
    """K-means of devices on population-scaled features; centroids in the original scale.

    All ``n_init`` starts move in the same passes over the devices, so the jobs do not grow with their number; the driver
    holds their centers. The start with the least sum of squared distances counts, ties to the first. Clusters are
    numbered by their mean temperature.
    """
    if not 2 <= k <= 5:
        raise ValueError("k must lie in 2..5")
    table = device_features(stats, threshold).fillna(0.0)
    table = cut(table, "device-features")
    scale = table.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{c}") for c in CLUSTER_FEATURES],
                      *[F.stddev_pop(c).alias(f"s_{c}") for c in CLUSTER_FEATURES]).first()
    if scale["n"] < 2:
        raise ValueError("at least two devices are needed")
    spread = {c: scale[f"s_{c}"] or 1.0 for c in CLUSTER_FEATURES}
    points = cut(table.withColumn("z", F.array(*[(F.col(c) - scale[f"m_{c}"]) / spread[c] for c in CLUSTER_FEATURES])), "device-points")
    centers, inertia = _lloyd(points, _spread_starts(points, min(k, scale["n"]), n_init, seed), rounds, tolerance)
    best = min(inertia, key=lambda i: (inertia[i], i))
    final = sorted(centers[best])
    nearest = _nearest(F.col("z"), _centers_literal({0: final})[0])
    assigned = points.select("device_id", nearest["c"].alias("cluster"), *CLUSTER_FEATURES, "p90_c", nearest["d"].alias("distance"))
    assigned = cut(assigned, "clusters")
    spark = stats.sparkSession
    centroids = spark.createDataFrame(
        [(i, *[float(center[j] * spread[c] + scale[f"m_{c}"]) for j, c in enumerate(CLUSTER_FEATURES)]) for i, center in enumerate(final)],
        "cluster INT, " + ", ".join(f"{c} DOUBLE" for c in CLUSTER_FEATURES))
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("devices"), F.sum("distance").alias("inertia"))
    return {"assignments": assigned.drop("distance"), "centroids": centroids, "sizes": sizes}
