"""Trend, correlation, change-point, forecast and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.operators import fleet, forest, learners, quality, quantiles, trends
from plantpulse.plans.fixtures import ANCHOR, half_up, r6
from plantpulse.plans.registry import query

_LINE = """SELECT device_id, regr_slope(avg_temp_c, idx) AS b, regr_intercept(avg_temp_c, idx) AS a, count(*) AS n
FROM indexed GROUP BY device_id HAVING count(*) >= 3"""


@query("ml1_linear_trend", f"""
SELECT device_id, n, {half_up('b', 4)} AS slope,
  CASE WHEN b > 0.1 THEN '🔺 subiendo' WHEN b < -0.1 THEN '🔻 bajando' ELSE '➡️  estable' END AS tendencia,
  {half_up('a', 2)} AS temp_inicio, {half_up('a + b * (n - 1)', 2)} AS temp_final FROM ({_LINE})""")
def _(t):
    return trends.linear_trend(t.stats)


@query("ml2_pairwise_corr", f"""
SELECT a.device_id AS machine_a, b.device_id AS machine_b, count(*) AS n, {r6('corr(a.avg_temp_c, b.avg_temp_c)')} AS corr
FROM machine_stats a JOIN machine_stats b ON a.window_start = b.window_start AND a.device_id < b.device_id GROUP BY 1, 2""")
def _(t):
    return trends.pairwise_corr(t.stats)


@query("ml2_corr_with_device", f"""
SELECT a.device_id, count(*) AS n, {r6('corr(a.avg_temp_c, b.avg_temp_c)')} AS corr FROM machine_stats a JOIN machine_stats b
  ON a.window_start = b.window_start AND b.device_id = 'machine-002' AND a.device_id <> 'machine-002' GROUP BY 1""")
def _(t):
    return trends.corr_with(t.stats, "machine-002")


@query("top5_ml2_ranked_pairs", f"""
SELECT a.device_id AS machine_a, b.device_id AS machine_b, {half_up('corr(a.avg_temp_c, b.avg_temp_c)', 3)} AS corr
FROM machine_stats a JOIN machine_stats b ON a.window_start = b.window_start AND a.device_id < b.device_id GROUP BY 1, 2""")
def _(t):
    return trends.ranked_pairs(trends.pairwise_corr(t.stats))


@query("ml7_training_profile", f"""
SELECT count(avg_temp_c) AS samples, {r6('avg(avg_temp_c)')} AS mean, {r6('stddev_pop(avg_temp_c)')} AS std, {r6('min(avg_temp_c)')} AS min,
  {r6('max(avg_temp_c)')} AS max, {r6('quantile_cont(avg_temp_c, 0.05)')} AS p5, {r6('quantile_cont(avg_temp_c, 0.95)')} AS p95
FROM machine_stats""")
def _(t):
    return quantiles.profile(t.stats)


@query("ml9_alert_features", f"""
SELECT device_id, window_start, {r6('avg_temp_c')} AS avg_temp_c, CAST(hour(window_start) AS INTEGER) AS hour,
  CAST(minute(window_start) AS INTEGER) AS minute, {r6('avg(avg_temp_c) OVER w')} AS roll_mean,
  {r6('coalesce(stddev_samp(avg_temp_c) OVER w, 0)')} AS roll_std, {r6('max(avg_temp_c) OVER w')} AS roll_max,
  CAST(CASE WHEN avg_temp_c > 80 THEN 1 ELSE 0 END AS INTEGER) AS label FROM machine_stats
WINDOW w AS (PARTITION BY device_id ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def _(t):
    return learners.alert_features(t.stats)


@query("ml11_cusum", f"""
SELECT device_id, window_start, {r6('avg_temp_c')} AS avg_temp_c, is_break, {r6('up')} AS s_pos, {r6('down')} AS s_neg FROM cusum_rows""")
def _(t):
    return trends.cusum(t.stats)


@query("ml12_regimes", f"""
SELECT device_id, CAST(k + 1 AS BIGINT) AS regimen, min(window_start) AS desde, max(window_start) AS hasta, count(*) AS puntos,
  {half_up('avg(avg_temp_c)', 2)} AS media_c, {half_up('stddev_samp(avg_temp_c)', 2)} AS std_c
FROM (SELECT *, sum(CASE WHEN is_break THEN 1 ELSE 0 END) OVER (PARTITION BY device_id ORDER BY rn) AS k FROM cusum_rows)
GROUP BY device_id, k""")
def _(t):
    return trends.regimes(trends.cusum(t.stats))


_FORECAST = """SELECT device_id, step, last_ts + to_minutes(step) AS ts, my + b * (last_x + step - mx) AS yhat, 1.96::DOUBLE * res AS half
FROM (SELECT *, sqrt(greatest(0.0::DOUBLE, syy - b * sxy) / (n - 2)) AS res FROM (
  SELECT device_id, regr_slope(y, x) AS b, avg(x) AS mx, avg(y) AS my, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, count(y) AS n,
    max(x) AS last_x, max(window_start) AS last_ts
  FROM (SELECT device_id, window_start, avg_temp_c AS y, (epoch(window_start) - 1767225600) / 60.0::DOUBLE AS x FROM machine_stats)
  GROUP BY device_id) WHERE n >= 3), (SELECT unnest(range(1, 31))::INTEGER AS step)"""


@query("ml13_forecast", f"""
SELECT device_id, step, ts, {r6('yhat')} AS yhat, {r6('yhat - half')} AS yhat_lower, {r6('yhat + half')} AS yhat_upper, yhat > 80 AS alert
FROM ({_FORECAST})""")
def _(t):
    return trends.forecast(t.stats, 30)


@query("ml13_forecast_alerts", f"""
SELECT device_id, count(*) FILTER (WHERE yhat > 80) AS alertas, {r6('max_by(yhat, step)')} AS yhat,
  {r6('max_by(yhat - half, step)')} AS yhat_lower, {r6('max_by(yhat + half, step)')} AS yhat_upper FROM ({_FORECAST}) GROUP BY device_id""")
def _(t):
    return trends.forecast_alerts(trends.forecast(t.stats, 30))


# --- fitted models: no SQL form, tested by their properties -----------------------

def _forest(t):
    return forest.IsolationForestJob().fit(t.stats)


_STATUS = f"""SELECT true AS trained, 0.1::DOUBLE AS contamination, count(avg_temp_c)::DOUBLE AS samples, {r6('avg(avg_temp_c)')} AS mean,
  {r6('stddev_pop(avg_temp_c)')} AS std, {r6('min(avg_temp_c)')} AS min, {r6('max(avg_temp_c)')} AS max,
  {r6('quantile_cont(avg_temp_c, 0.05)')} AS p5, {r6('quantile_cont(avg_temp_c, 0.95)')} AS p95 FROM machine_stats"""


@query("ml3_api5_forest_training", _STATUS)
def _(t):
    return _forest(t).status(t.spark)


@query("ml4_ml5_forest_scores")
def _(t):
    return _forest(t).score(t.stats).select("device_id", "window_start", "score", "is_anomaly", "failure_prob", "interpretation")


@query("ml5_scored_readings", "SELECT device_id, count(*) AS lecturas FROM machine_stats WHERE avg_temp_c IS NOT NULL GROUP BY device_id")
def _(t):
    # every reading gets a score between -1 and 0, and the flag is the score below the threshold of the model
    model = _forest(t)
    scored = model.score(t.stats).where(F.col("score").between(-1, 0) & (F.col("is_anomaly") == (F.col("score") < model.offset)))
    return quality.anomaly_summary(scored).select("device_id", "lecturas")


@query("ml5_anomaly_report")
def _(t):
    return quality.anomaly_summary(_forest(t).score(t.stats))


@query("ml6_forest_sweep")
def _(t):
    return _forest(t).sweep(t.spark)


@query("ml8_forest_reload")
def _(t):
    path = t.folder("forest")
    _forest(t).save(path)
    return forest.ForestModel.load(t.spark, path).score(t.stats).select("device_id", "window_start", "score", "is_anomaly")


@query("ml9_alert_classifier")
def _(t):
    return learners.alert_classifier(t.stats)["scored"]


@query("ml9_scored_rows", f"""
SELECT device_id, window_start, {r6('avg_temp_c')} AS avg_temp_c, CAST(CASE WHEN avg_temp_c > 80 THEN 1 ELSE 0 END AS INTEGER) AS label FROM machine_stats""")
def _(t):
    return learners.alert_classifier(t.stats)["scored"].select("device_id", "window_start", "avg_temp_c", "label")


@query("ml9_classifier_metrics")
def _(t):
    return learners.alert_classifier(t.stats)["metrics"]


@query("ml10_clustered_features", f"""
SELECT device_id, {r6('avg(avg_temp_c)')} AS mean_c, {r6('coalesce(stddev_samp(avg_temp_c), 0)')} AS std_c, {r6('max(avg_temp_c)')} AS max_c,
  {r6('avg(CASE WHEN avg_temp_c > 80 THEN 1.0::DOUBLE ELSE 0 END)')} AS alert_rate, {r6('quantile_cont(avg_temp_c, 0.9)')} AS p90_c
FROM machine_stats GROUP BY device_id""")
def _(t):
    return learners.cluster_devices(t.stats)["assignments"].drop("cluster")


@query("ml10_device_clusters")
def _(t):
    return learners.cluster_devices(t.stats)["assignments"]


@query("api5_train_range", f"{_STATUS} WHERE window_start >= {ANCHOR} - INTERVAL 120 MINUTE")
def _(t):
    return _forest_of_range(t).status(t.spark)


def _forest_of_range(t):
    """Training rows of the last two hours, as the training call takes them by default."""
    return forest.IsolationForestJob(contamination=0.1).fit(fleet.metric_range(t.stats, 120))


@query("ml2_top_correlated", f"""
SELECT device_id, CAST(row_number() OVER (PARTITION BY device_id ORDER BY c DESC, other) AS INTEGER) AS rank, other, n, {r6('c')} AS corr
FROM (SELECT a.device_id, b.device_id AS other, count(*) AS n, corr(a.avg_temp_c, b.avg_temp_c) AS c
      FROM machine_stats a JOIN machine_stats b ON a.window_start = b.window_start AND a.device_id <> b.device_id GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY c DESC, other) <= 3""")
def _(t):
    return trends.top_correlated(t.stats, k=3)


@query("ml9_device_codes", """
SELECT device_id, CAST(row_number() OVER (ORDER BY device_id) - 1 AS DOUBLE) AS device_enc FROM (SELECT DISTINCT device_id FROM machine_stats)""")
def _(t):
    return learners.device_codes(t.stats)


@query("ml9_confusion")
def _(t):
    return learners.alert_classifier(t.stats)["confusion"]


@query("ml9_importances")
def _(t):
    return learners.alert_classifier(t.stats)["importances"]


@query("ml10_centroids")
def _(t):
    return learners.cluster_devices(t.stats)["centroids"]


# The least sum of squares over all ways to deal the few devices of the table to three clusters, and its sizes.
@query("ml10_best_partition", f"""SELECT * FROM (
WITH features AS (
  SELECT device_id, avg(avg_temp_c) AS mean_c, coalesce(stddev_samp(avg_temp_c), 0) AS std_c, max(avg_temp_c) AS max_c,
         avg(CASE WHEN avg_temp_c > 80 THEN 1.0::DOUBLE ELSE 0 END) AS alert_rate FROM machine_stats GROUP BY device_id),
scaled AS (
  SELECT row_number() OVER (ORDER BY device_id) - 1 AS i, unnest([
    (mean_c - avg(mean_c) OVER ()) / CASE WHEN stddev_pop(mean_c) OVER () > 0 THEN stddev_pop(mean_c) OVER () ELSE 1 END,
    (std_c - avg(std_c) OVER ()) / CASE WHEN stddev_pop(std_c) OVER () > 0 THEN stddev_pop(std_c) OVER () ELSE 1 END,
    (max_c - avg(max_c) OVER ()) / CASE WHEN stddev_pop(max_c) OVER () > 0 THEN stddev_pop(max_c) OVER () ELSE 1 END,
    (alert_rate - avg(alert_rate) OVER ()) / CASE WHEN stddev_pop(alert_rate) OVER () > 0 THEN stddev_pop(alert_rate) OVER () ELSE 1 END]) AS z,
    unnest([0, 1, 2, 3]) AS j FROM features),
ways AS (SELECT way, i, j, z, (way // CAST(pow(3, i) AS BIGINT)) % 3 AS c
         FROM scaled, (SELECT unnest(range(0, CAST(pow(3, (SELECT count(*) FROM features)) AS BIGINT))) AS way)),
sums AS (SELECT way, c, j, count(*) AS n, sum(z * z) - sum(z) * sum(z) / count(*) AS d FROM ways GROUP BY ALL),
costs AS (SELECT way, sum(d) AS d FROM sums GROUP BY way HAVING count(DISTINCT c) = least(3, (SELECT count(*) FROM features))),
best AS (SELECT way FROM costs ORDER BY d, way LIMIT 1)
SELECT array_to_string(list_sort(list(n)), ',') AS sizes, {r6('sum(d)')} AS inertia
FROM (SELECT c, any_value(n) AS n, sum(d) AS d FROM sums JOIN best USING (way) GROUP BY c))""")
def _(t):
    # with more starts than by default, all of which move in the same passes
    sizes = learners.cluster_devices(t.stats, n_init=32)["sizes"]
    return sizes.agg(F.array_join(F.array_sort(F.collect_list("devices")), ",").alias("sizes"), F.sum("inertia").alias("inertia"))


@query("ml6_sweep_from_leaves", "SELECT CAST(unnest(range(40, 101, 5)) AS DOUBLE) AS avg_temp_c, true AS agrees")
def _(t):
    # the score again, by joining each temperature with the leaves that hold it, against the model's step function
    model = _forest(t)
    curve = model.sweep(t.spark)
    depth = curve.join(F.broadcast(model.leaves), F.col("avg_temp_c").between(F.col("lo"), F.col("hi")) & (F.col("avg_temp_c") > F.col("lo")))
    found = depth.groupBy("avg_temp_c", "score").agg(F.avg("depth").alias("depth"), F.count_distinct("tree").alias("trees"))
    again = -F.pow(F.lit(2.0), -F.col("depth") / float(forest._average_path(model.sample)))
    return found.select("avg_temp_c", ((F.abs(again - F.col("score")) < 1e-9) & (F.col("trees") == 100)).alias("agrees"))


@query("ml8_reload_agrees", "SELECT device_id, count(*) AS lecturas FROM machine_stats WHERE avg_temp_c IS NOT NULL GROUP BY device_id")
def _(t):
    path = t.folder("forest")
    model = _forest(t)
    model.save(path)
    names = ["device_id", "window_start", "score", "is_anomaly", "interpretation"]
    back = forest.ForestModel.load(t.spark, path).score(t.stats).select(*names)
    both = model.score(t.stats).select(*names).intersectAll(back)
    return both.groupBy("device_id").agg(F.count(F.lit(1)).alias("lecturas"))


@query("api5_predict")
def _(t):
    return _forest(t).predict(t.spark, 95.0, "machine-001")
