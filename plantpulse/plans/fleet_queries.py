"""Window statistics, service queries, analytic windows, reshape and alert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.operators import fleet, quantiles, reshape, unify, windows
from plantpulse.plans.fixtures import ANCHOR, half_up, r6
from plantpulse.plans.registry import query

DEVICES = C.ROSTER + ("machine-006",)


def _range(minutes: int) -> str:
    return f"window_start >= {ANCHOR} - INTERVAL {minutes} MINUTE"


_STATS = f"device_id, window_start, window_end, {r6('avg_temp_c')} AS avg_temp_c, {r6('max_temp_c')} AS max_temp_c, count_readings, alert"


@query("agg1_window_stats", f"SELECT {_STATS} FROM machine_stats")
def _(t):
    return t.stats


@query("src6_metric_range", f"""
SELECT {_STATS} FROM machine_stats WHERE {_range(120)} AND device_id = 'machine-002'""")
def _(t):
    return fleet.metric_range(t.stats, 120, device_id="machine-002")


@query("flt1_non_null", "SELECT event_id FROM sensors_raw WHERE temperature IS NOT NULL AND device_id IS NOT NULL")
def _(t):
    return fleet.non_null(t.raw, "temperature", "device_id").select("event_id")


@query("flt2_relative_range", f"SELECT {_STATS} FROM machine_stats WHERE {_range(30)}")
def _(t):
    return fleet.metric_range(t.stats, 30)


@query("flt3_one_device", f"SELECT {_STATS} FROM machine_stats WHERE device_id = 'machine-003'")
def _(t):
    return t.stats.where(F.col("device_id") == "machine-003")


@query("flt4_over_threshold", f"SELECT {_STATS} FROM machine_stats WHERE avg_temp_c > 75")
def _(t):
    return fleet.over_threshold(t.stats, 75.0)


@query("flt5_in_alert", f"SELECT {_STATS} FROM machine_stats WHERE alert = 1")
def _(t):
    return fleet.in_alert(t.stats)


@query("flt6_drop_null_metric", """
SELECT device_id, ts, round(value, 6) AS value FROM metrics_long WHERE value IS NOT NULL AND field = 'avg_temp_c'""")
def _(t):
    return fleet.non_null(t.long, "value").where("field = 'avg_temp_c'").drop("field")


@query("agg2_device_stats", f"""
SELECT device_id, count(avg_temp_c) AS "count", {r6('avg(avg_temp_c)')} AS mean_c, {r6('min(avg_temp_c)')} AS min_c,
       {r6('max(avg_temp_c)')} AS max_c FROM machine_stats GROUP BY device_id""")
def _(t):
    return fleet.device_stats(t.stats)


@query("agg3_short_summary", f"""
SELECT device_id, {half_up('avg(avg_temp_c)', 2)} AS temp_media, {half_up('max(max_temp_c)', 2)} AS temp_max,
       CAST(sum(count_readings) AS BIGINT) AS lecturas, CAST(sum(alert) AS BIGINT) AS alertas FROM machine_stats GROUP BY device_id""")
def _(t):
    return fleet.device_short_summary(t.stats)


@query("agg4_device_profile", f"""
SELECT device_id, ventanas, {half_up('m', 2)} AS temp_media, {half_up('hi', 2)} AS temp_max, {half_up('lo', 2)} AS temp_min,
  {half_up('s', 2)} AS desv_std, p25, p75, alertas, lecturas_total,
  {half_up('alertas * CAST(100 AS DOUBLE) / ventanas', 1)} AS pct_alerta, {half_up('p75 - p25', 2)} AS iqr
FROM (SELECT device_id, count(avg_temp_c) AS ventanas, avg(avg_temp_c) AS m, max(max_temp_c) AS hi, min(avg_temp_c) AS lo,
        stddev_samp(avg_temp_c) AS s, {half_up('quantile_cont(avg_temp_c, 0.25)', 2)} AS p25,
        {half_up('quantile_cont(avg_temp_c, 0.75)', 2)} AS p75, CAST(sum(alert) AS BIGINT) AS alertas,
        CAST(sum(count_readings) AS BIGINT) AS lecturas_total FROM machine_stats GROUP BY device_id)""")
def _(t):
    return fleet.device_profile(t.stats)


@query("agg5_describe", f"""
SELECT device_id, count(temperature_c) AS "count", {r6('avg(temperature_c)')} AS mean, {r6('stddev_samp(temperature_c)')} AS std,
  {r6('min(temperature_c)')} AS min, {r6('max(temperature_c)')} AS max, {r6('quantile_cont(temperature_c, 0.25)')} AS p25,
  {r6('quantile_cont(temperature_c, 0.5)')} AS p50, {r6('quantile_cont(temperature_c, 0.75)')} AS p75
FROM sensors_clean GROUP BY device_id""")
def _(t):
    return quantiles.describe_by(t.clean, ["device_id"], "temperature_c")


@query("agg6_alert_summary", f"""
SELECT device_id, count(*) AS alertas, {r6('avg(avg_temp_c)')} AS temp_media, {r6('max(max_temp_c)')} AS temp_max_pico
FROM machine_stats WHERE alert = 1 GROUP BY device_id""")
def _(t):
    return fleet.alert_summary(t.stats)


@query("agg7_alert_counts", "SELECT device_id, count(*) AS alertas FROM machine_stats WHERE alert = 1 GROUP BY device_id")
def _(t):
    return fleet.alert_counts(t.stats)


@query("agg8_alerts_by_hour", """
SELECT CAST(hour(window_start) AS INTEGER) AS hour, device_id, count(*) AS alertas FROM machine_stats WHERE alert = 1 GROUP BY ALL""")
def _(t):
    return fleet.alerts_by_hour(t.stats)


@query("agg18_device_distribution", "SELECT device_id, count(*) AS n FROM sensors_clean GROUP BY device_id")
def _(t):
    return fleet.count_by(t.clean, "device_id")


@query("agg29_hottest_device", f"""
SELECT device_id, {r6('mean_c')} AS mean_c FROM (SELECT device_id, avg(avg_temp_c) AS mean_c FROM machine_stats GROUP BY device_id)
ORDER BY mean_c DESC LIMIT 1""")
def _(t):
    return fleet.hottest_device(t.stats)


@query("agg30_extent", """
SELECT count(*) AS filas, count(DISTINCT window_start) AS ventanas, count(DISTINCT device_id) AS maquinas,
       min(window_start) AS desde, max(window_start) AS hasta FROM machine_stats""")
def _(t):
    return fleet.extent(t.stats)


_LAST = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY window_start DESC) AS rn
FROM machine_stats WHERE {where}) WHERE rn = 1)"""


@query("agg32_panels", f"""
SELECT count(*) AS active, count(*) FILTER (WHERE alert = 1) AS in_alert, {r6('avg(avg_temp_c)')} AS mean_last,
       {r6('max(max_temp_c)')} AS max_last FROM {_LAST.format(where=_range(30))}""")
def _(t):
    return fleet.panels(t.stats, 30)


@query("agg33_rows_per_series", f"""
SELECT device_id, count(*) AS n FROM machine_stats WHERE {_range(1440)} GROUP BY device_id""")
def _(t):
    return fleet.count_by(fleet.metric_range(t.stats, 1440), "device_id")


@query("agg35_histogram", """
SELECT device_id, CAST(least(floor((avg_temp_c - lo) * CAST(30 AS DOUBLE) / (hi - lo)), 29) AS INTEGER) AS bin, count(*) AS n
FROM machine_stats, (SELECT min(avg_temp_c) AS lo, max(avg_temp_c) AS hi FROM machine_stats) GROUP BY ALL""")
def _(t):
    return quantiles.histogram(t.stats, "avg_temp_c", 30, "device_id")


_BOX = """SELECT device_id, q1, median, q3, q1 - 1.5::DOUBLE * (q3 - q1) AS low_fence, q3 + 1.5::DOUBLE * (q3 - q1) AS high_fence
FROM (SELECT device_id, quantile_cont(avg_temp_c, 0.25) AS q1, quantile_cont(avg_temp_c, 0.5) AS median,
      quantile_cont(avg_temp_c, 0.75) AS q3 FROM machine_stats GROUP BY device_id)"""


@query("agg36_box_summary", f"""
SELECT device_id, {r6('q1')} AS q1, {r6('median')} AS median, {r6('q3')} AS q3, {r6('low_fence')} AS low_fence,
       {r6('high_fence')} AS high_fence FROM ({_BOX})""")
def _(t):
    return quantiles.box_summary(t.stats, "avg_temp_c", "device_id")


@query("agg36_box_outliers", f"""
SELECT device_id, window_start, {r6('avg_temp_c')} AS avg_temp_c, avg_temp_c < low_fence OR avg_temp_c > high_fence AS is_outlier
FROM machine_stats JOIN ({_BOX}) USING (device_id)""")
def _(t):
    return quantiles.box_outliers(t.stats.select("device_id", "window_start", "avg_temp_c"), "avg_temp_c", "device_id")


@query("agg37_device_features", f"""
SELECT device_id, {r6('avg(avg_temp_c)')} AS mean_c, {r6('stddev_samp(avg_temp_c)')} AS std_c, {r6('max(avg_temp_c)')} AS max_c,
  {r6('min(avg_temp_c)')} AS min_c, {r6('avg(CASE WHEN avg_temp_c > 80 THEN 1.0::DOUBLE ELSE 0 END)')} AS alert_rate,
  {r6('quantile_cont(avg_temp_c, 0.9)')} AS p90_c FROM machine_stats GROUP BY device_id""")
def _(t):
    return fleet.device_features(t.stats)


@query("win1_latest", f"SELECT {_STATS} FROM {_LAST.format(where='true')}")
def _(t):
    return fleet.latest(t.stats)


@query("win1_latest_in_alert", f"SELECT {_STATS} FROM {_LAST.format(where=_range(60) + ' AND avg_temp_c > 80')}")
def _(t):
    return fleet.latest_in_alert(t.stats, 60)


_FRAME = "OVER (PARTITION BY device_id ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"


@query("win2_rolling_mean", f"SELECT device_id, window_start, {r6(f'avg(avg_temp_c) {_FRAME}')} AS roll_mean FROM machine_stats")
def _(t):
    return windows.rolling(t.stats, fns=("mean",)).select("device_id", "window_start", "roll_mean")


@query("win3_rolling_features", f"""
SELECT device_id, window_start, {r6(f'avg(avg_temp_c) {_FRAME}')} AS roll_mean,
  {r6(f'coalesce(stddev_samp(avg_temp_c) {_FRAME}, 0)')} AS roll_std, {r6(f'max(avg_temp_c) {_FRAME}')} AS roll_max FROM machine_stats""")
def _(t):
    return windows.rolling(t.stats).select("device_id", "window_start", "roll_mean", "roll_std", "roll_max")


@query("win4_bollinger", f"""
SELECT device_id, window_start, {r6('m')} AS roll_mean, {r6('m + 2 * s')} AS upper_band, {r6('m - 2 * s')} AS lower_band
FROM (SELECT device_id, window_start, avg(avg_temp_c) {_FRAME} AS m, coalesce(stddev_samp(avg_temp_c) {_FRAME}, 0) AS s FROM machine_stats)
WHERE device_id = (SELECT device_id FROM machine_stats GROUP BY device_id ORDER BY avg(avg_temp_c) DESC LIMIT 1)""")
def _(t):
    hottest = fleet.hottest_device(t.stats).select("device_id").scalar()
    return windows.bollinger(t.stats.where(F.col("device_id") == hottest)).select(
        "device_id", "window_start", "roll_mean", "upper_band", "lower_band")


_DEV = "SELECT device_id, avg(avg_temp_c) AS m, stddev_samp(avg_temp_c) AS s, count(*) AS n FROM machine_stats GROUP BY device_id"


@query("win5_zscore", f"""
SELECT device_id, window_start, {r6('(avg_temp_c - m) / s')} AS z_score, abs((avg_temp_c - m) / s) > 2 AS outlier
FROM machine_stats JOIN ({_DEV}) USING (device_id)""")
def _(t):
    return windows.zscore(t.stats).select("device_id", "window_start", "z_score", "outlier")


@query("win6_sigma_band", f"""
SELECT device_id, window_start, {r6('avg_temp_c - s')} AS band_low, {r6('avg_temp_c + s')} AS band_high
FROM machine_stats JOIN ({_DEV}) USING (device_id) WHERE n > 2""")
def _(t):
    return windows.sigma_band(t.stats).select("device_id", "window_start", "band_low", "band_high")


@query("win7_tail_20", f"""
SELECT {_STATS} FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY window_start DESC) AS rn FROM machine_stats)
WHERE rn <= 20""")
def _(t):
    return windows.tail_n(t.stats, 20)


@query("win8_ordinal", "SELECT device_id, window_start, idx FROM indexed")
def _(t):
    return windows.ordinal(t.stats).select("device_id", "window_start", "idx")


@query("win9_alert_intervals", f"""
SELECT device_id, window_start AS start, window_start + INTERVAL 1 MINUTE AS finish, {r6('avg_temp_c')} AS avg_temp_c
FROM machine_stats WHERE alert = 1""")
def _(t):
    return windows.alert_intervals(t.stats)


@query("jn2_compare_devices", f"""
SELECT window_start, {r6('a.v')} AS temp_a, {r6('b.v')} AS temp_b, {r6('a.v - b.v')} AS diff
FROM (SELECT window_start, avg_temp_c AS v FROM machine_stats WHERE device_id = 'machine-001') a
FULL JOIN (SELECT window_start, avg_temp_c AS v FROM machine_stats WHERE device_id = 'machine-002') b USING (window_start)""")
def _(t):
    return fleet.compare_devices(t.stats, "machine-001", "machine-002")


@query("jn3_rsh3_time_device_matrix", f"SELECT window_start, device_id, {r6('avg(avg_temp_c)')} AS avg_temp_c FROM machine_stats GROUP BY ALL")
def _(t):
    return reshape.time_device_means(t.stats)


_MATRIX = ", ".join(f"round(avg(avg_temp_c) FILTER (WHERE device_id = '{d}'), 6) AS \"{d}\"" for d in C.ROSTER)


@query("rsh3_pivot_named_devices", f"SELECT window_start, {_MATRIX} FROM machine_stats GROUP BY window_start")
def _(t):
    return reshape.pivot_devices(reshape.time_device_means(t.stats), list(C.ROSTER))


@query("rsh1_field_pivot", """
SELECT device_id, ts, round(max(value) FILTER (WHERE field = 'avg_temp_c'), 6) AS avg_temp_c,
  round(max(value) FILTER (WHERE field = 'max_temp_c'), 6) AS max_temp_c, max(value) FILTER (WHERE field = 'count_readings') AS count_readings,
  max(value) FILTER (WHERE field = 'alert') AS alert FROM metrics_long GROUP BY device_id, ts""")
def _(t):
    return reshape.pivot_fields(t.long)


@query("rsh4_coverage_matrix", f"""
SELECT device_id, count(*) FILTER (WHERE source = '{C.SOURCE_HOT}') AS "{C.SOURCE_HOT}",
       count(*) FILTER (WHERE source = '{C.SOURCE_COLD}') AS "{C.SOURCE_COLD}" FROM unified GROUP BY device_id""")
def _(t):
    return reshape.coverage_matrix(t.unified, (C.SOURCE_HOT, C.SOURCE_COLD))


_HISTORY = "FROM machine_stats WHERE device_id = 'machine-001' AND {r} ORDER BY window_start LIMIT {n}"


@query("top1_api2_machine_history", f"""
SELECT device_id, window_start AS ts, {half_up('avg_temp_c', 3)} AS avg_temp_c {_HISTORY.format(r=_range(1440), n=200)}""")
def _(t):
    return fleet.machine_history(t.stats, "machine-001", 1440, 200)


@query("top2_api3_alerts", f"""
SELECT device_id, window_start AS ts, {half_up('avg_temp_c', 2)} AS avg_temp_c FROM machine_stats WHERE avg_temp_c > 80 AND {_range(1440)}""")
def _(t):
    return fleet.alerts(t.stats, 1440)


@query("top3_latest_5000", f"""
SELECT event_id, device_id, {r6('temperature_c')} AS temperature_c FROM sensors_clean ORDER BY event_time DESC, event_id DESC LIMIT 5000""")
def _(t):
    return fleet.latest_n(t.clean, 5000, "event_time").select("event_id", "device_id", "temperature_c")


@query("top3_latest_of_union", f"""
SELECT device_id, {r6('value')} AS value, ts, source FROM unified ORDER BY unified.ts DESC, device_id, source, unified.value LIMIT 5000""")
def _(t):
    return unify.latest_of_both(t.unified)


@query("top4_device_top5", f"""
SELECT event_id, ts, {r6('c.temperature_c')} AS temperature_c FROM sensors_clean c WHERE device_id = 'machine-001'
AND c.temperature_c > 80 ORDER BY c.temperature_c DESC, event_id DESC LIMIT 5""")
def _(t):
    hot = t.clean.where("device_id = 'machine-001' AND temperature_c > 80")
    return fleet.latest_n(hot, 5, "temperature_c").select("event_id", "ts", "temperature_c")


@query("top5_most_alerts", """
SELECT device_id, count(*) AS alertas FROM machine_stats WHERE alert = 1 GROUP BY device_id ORDER BY alertas DESC, device_id LIMIT 3""")
def _(t):
    return fleet.alert_counts(t.stats).orderBy(F.col("alertas").desc(), "device_id").limit(3)


@query("top6_roster", "SELECT DISTINCT device_id FROM machine_stats")
def _(t):
    return fleet.roster(t.stats)


@query("api1_machines_status", f"""
SELECT device_id, {half_up('avg_temp_c', 2)} AS avg_temp_c, alert = 1 AS alert, window_start AS ts FROM {_LAST.format(where=_range(5))}""")
def _(t):
    return fleet.machines_status(t.stats, 5)


@query("api4_stats_report", f"""
SELECT device_id, count(*) AS "count", {half_up('avg(avg_temp_c)', 2)} AS mean_c, {half_up('min(avg_temp_c)', 2)} AS min_c,
       {half_up('max(avg_temp_c)', 2)} AS max_c FROM machine_stats WHERE {_range(60)} GROUP BY device_id""")
def _(t):
    return fleet.stats_report(t.stats, 60)


_ROSTER = " UNION ALL ".join(f"SELECT '{d}' AS device_id" for d in DEVICES)


@query("jn1_api6_machines_summary", f"""
SELECT device_id, {half_up('v', 2)} AS avg_temp_c,
  CASE WHEN v IS NULL THEN 'SIN DATOS' WHEN v > 80 THEN 'ALERT' ELSE 'OK' END AS status,
  CASE WHEN v > 80 THEN 'red' WHEN v > 70 THEN 'orange' ELSE 'green' END AS color
FROM ({_ROSTER}) r LEFT JOIN (SELECT device_id, avg_temp_c AS v FROM {_LAST.format(where=_range(10))}) USING (device_id)""")
def _(t):
    return fleet.machines_summary(t.stats, fleet.roster_table(t.spark, DEVICES), 10)
