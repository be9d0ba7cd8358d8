"""Ingest, validation, routing and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse import functions as fn
from plantpulse.operators import ingest, quality, reshape, routing, validate
from plantpulse.plans.fixtures import celsius, half_up, r6
from plantpulse.plans.registry import query
from plantpulse.sources import metrics, topics

CLOCK_MS = 1773187200000
_SHOWN = "concat('''', unit, '''')"
INGEST_REASON = f"""CASE WHEN device_id IS NULL OR trim(device_id) = '' THEN '{C.REASON_DEVICE}'
  WHEN temperature IS NULL THEN 'campo ''temperature'' ausente'
  WHEN unit IS NULL OR upper(unit) NOT IN ('C', 'F', 'K')
    THEN concat('{C.REASON_UNIT}', CASE WHEN unit IS NULL THEN '''''' ELSE {_SHOWN} END, '{C.INGEST_UNIT_SUFFIX}')
  WHEN ts IS NULL OR ts = '' THEN 'campo ''ts'' ausente' END"""


def _ingested(t):
    return ingest.ingest(t.messages, "sensors/telemetry", 1, F.lit(CLOCK_MS))


@query("src1_raw_topic_parse", f"""
SELECT event_id AS "offset", device_id, {r6('temperature')} AS temperature, unit, ts, _ingested_at FROM sensors_raw""")
def _(t):
    records = t.raw.select(F.col("event_id").alias("offset"),
                           F.to_json(F.struct("device_id", "temperature", "unit", "ts", "_ingested_at")).alias("value"))
    return topics.parse_topic(records).select("offset", "device_id", "temperature", "unit", "ts", "_ingested_at")


@query("src2_clean_topic_event_time",
       f"SELECT device_id, {r6('temperature_c')} AS temperature_c, unit_original, ts, _ingested_at, event_time FROM sensors_clean")
def _(t):
    records = t.clean.drop("event_id", "event_time").select(F.to_json(F.struct("*")).alias("value"))
    return topics.with_event_time(topics.clean_topic(records)).drop("_corrupt")


@query("src7_topic_sample", """
SELECT "offset", n_fields FROM (SELECT event_id AS "offset",
  CAST((device_id IS NOT NULL)::INT + (temperature IS NOT NULL)::INT + (unit IS NOT NULL)::INT + 1 AS INTEGER) AS n_fields
  FROM sensors_raw ORDER BY event_id LIMIT 500)""")
def _(t):
    return quality.topic_sample(t.messages, 500).select("offset", F.size(F.json_object_keys("value")).alias("n_fields"))


@query("src8_topic_extents", """
SELECT topic, "partition", min(event_id) AS low, max(event_id) + 1 AS high, max(event_id) + 1 - min(event_id) AS mensajes,
       count(*) AS retenidos
FROM (SELECT event_id, CASE WHEN valid THEN 'sensors_clean' ELSE 'sensors_invalid' END AS topic,
             CAST(event_id % 4 AS INTEGER) AS "partition" FROM sensors_routed) GROUP BY topic, "partition" """)
def _(t):
    rows = t.routed.select(F.when(F.col("valid"), "sensors_clean").otherwise("sensors_invalid").alias("topic"),
                           (F.col("event_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"))
    return quality.topic_extents(rows)


@query("val1_decode_json", f"SELECT count(*) AS n, count(*) FILTER (WHERE {INGEST_REASON} IS NOT NULL) AS rejected FROM sensors_raw")
def _(t):
    binary = t.messages.withColumn("value", F.col("value").cast("binary"))
    return ingest.ingest(binary, "sensors/telemetry", 1, F.lit(CLOCK_MS)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"))


@query("val2_ingest_reason", f'SELECT event_id AS "offset", {INGEST_REASON} AS reject_reason FROM sensors_raw')
def _(t):
    return _ingested(t).select("offset", "reject_reason")


@query("val3_enrichment", f"""
SELECT event_id AS "offset", upper(unit) AS unit, 'sensors/telemetry' AS _mqtt_topic, CAST(1 AS INTEGER) AS _mqtt_qos,
       CAST(1773187200000 AS BIGINT) AS _ingested_at FROM sensors_raw WHERE {INGEST_REASON} IS NULL""")
def _(t):
    return _ingested(t).where("reject_reason IS NULL").select("offset", "unit", "_mqtt_topic", "_mqtt_qos", "_ingested_at")


@query("val4_required_keys", """
SELECT event_id AS "offset", concat_ws(',', CASE WHEN device_id IS NULL THEN 'device_id' END,
  CASE WHEN temperature IS NULL THEN 'temperature' END, CASE WHEN unit IS NULL THEN 'unit' END) AS missing,
  device_id IS NOT NULL AND temperature IS NOT NULL AND unit IS NOT NULL AS accepted FROM sensors_raw""")
def _(t):
    return ingest.bridge_check(t.messages, "sensors/telemetry").select(
        "offset", F.array_join("missing", ",").alias("missing"), "accepted")


@query("val5_partition_key", 'SELECT event_id AS "offset", device_id AS key FROM sensors_raw')
def _(t):
    return t.messages.select("offset", ingest.partition_key("value").alias("key"))


def _with_hashes(t):
    """Raw rows with hash fields; some rows lack them."""
    signed = F.when(F.col("event_id") % 50 != 41, F.sha2(F.col("ts"), 256))
    return t.raw.withColumn("hash", signed).withColumn("prev_hash", signed)


RAW_ERROR = """CASE
  WHEN device_id IS NULL OR temperature IS NULL OR unit IS NULL OR event_id % 50 = 41 THEN concat('missing_fields:', concat_ws(',',
    CASE WHEN device_id IS NULL THEN 'device_id' END, CASE WHEN event_id % 50 = 41 THEN 'hash' END,
    CASE WHEN event_id % 50 = 41 THEN 'prev_hash' END, CASE WHEN temperature IS NULL THEN 'temperature' END,
    CASE WHEN unit IS NULL THEN 'unit' END))
  WHEN trim(device_id) = '' THEN 'empty_device_id'
  WHEN trim(ts) = '' THEN 'empty_ts'
  WHEN upper(trim(unit)) NOT IN ('C', 'F', 'K') THEN concat('invalid_unit:', upper(trim(unit)))
  WHEN temperature NOT BETWEEN CASE upper(trim(unit)) WHEN 'C' THEN -50.0 WHEN 'F' THEN -58.0 ELSE 223.15 END
    AND CASE upper(trim(unit)) WHEN 'C' THEN 200.0 WHEN 'F' THEN 392.0 ELSE 473.15 END
    THEN concat('temperature_out_of_range:', CAST(temperature AS VARCHAR), upper(trim(unit))) END"""


@query("val6_validate_raw", f"SELECT event_id, {RAW_ERROR} AS _validation_error FROM sensors_raw")
def _(t):
    return validate.validate(_with_hashes(t)).select("event_id", "_validation_error")


@query("val7_validate_clean", """
SELECT event_id, CASE WHEN ts IS NULL THEN 'missing_fields:ts'
  WHEN temperature_c NOT BETWEEN -50 AND 200 THEN concat('temperature_c_out_of_range:', CAST(temperature_c AS VARCHAR)) END
  AS _validation_error FROM sensors_clean""")
def _(t):
    return validate.validate(t.clean, "clean").select("event_id", "_validation_error")


@query("val8_filter_valid", f"""
SELECT event_id, {RAW_ERROR} IS NULL AS ok, coalesce({RAW_ERROR}, '') AS _validation_error FROM sensors_raw""")
def _(t):
    valid, invalid = validate.filter_valid(_with_hashes(t))
    return valid.select("event_id", F.lit(True).alias("ok"), F.lit("").alias("_validation_error")).unionByName(
        invalid.select("event_id", F.lit(False).alias("ok"), "_validation_error"))


@query("val9_valid_rows", f"SELECT event_id, device_id, {r6('temperature_c')} AS temperature_c, unit_original FROM sensors_clean")
def _(t):
    return routing.split(t.routed)[0].select("event_id", "device_id", "temperature_c", "unit_original")


@query("val10_rejected_rows", f"SELECT event_id, device_id, {r6('temperature')} AS temperature, unit, ts FROM sensors_invalid")
def _(t):
    return routing.split(t.routed)[1].select("event_id", "device_id", "temperature", "unit", "ts")


@query("val11_reject_reason", "SELECT event_id, reason, stage FROM sensors_invalid")
def _(t):
    return t.invalid.select("event_id", "reason", "stage")


_LIB = celsius("temperature", "unit", "NULL")


@query("val12_normalize_library", f"""
SELECT event_id, device_id, {half_up('c', 4)} AS temperature_c, unit AS unit_original, CAST(_ingested_at AS VARCHAR) AS _ingested_at,
       '' AS hash FROM (SELECT *, {_LIB} AS c FROM sensors_raw) WHERE device_id IS NOT NULL AND c BETWEEN -50 AND 200""")
def _(t):
    return routing.normalize_library(t.raw)[0].select(
        "event_id", "device_id", "temperature_c", "unit_original", "_ingested_at", "hash")


@query("val12_normalize_rejects", f"""
SELECT event_id, 'normalization_failed' AS reason FROM (SELECT *, {_LIB} AS c FROM sensors_raw)
WHERE NOT coalesce(device_id IS NOT NULL AND c BETWEEN -50 AND 200, false)""")
def _(t):
    return routing.normalize_library(t.raw)[1].select("event_id", "reason")


@query("val13_ingest_counters", f"""
SELECT count(*) AS received, count(*) FILTER (WHERE {INGEST_REASON} IS NULL) AS forwarded,
       count(*) FILTER (WHERE {INGEST_REASON} IS NOT NULL) AS invalid FROM sensors_raw""")
def _(t):
    return ingest.ingest_counters(_ingested(t))


@query("fn1_to_celsius", f"SELECT event_id, {r6(celsius('temperature', 'unit', 'temperature'))} AS c FROM sensors_raw")
def _(t):
    return t.raw.select("event_id", fn.to_celsius("temperature", "unit").alias("c"))


@query("fn2_to_celsius_strict", f"SELECT event_id, {r6(_LIB)} AS c FROM sensors_raw")
def _(t):
    return t.raw.select("event_id", fn.to_celsius("temperature", "unit", strict="null").alias("c"))


@query("fn3_from_celsius", """
SELECT event_id, round(CASE upper(trim(unit_original)) WHEN 'F' THEN temperature_c * CAST(9 AS DOUBLE) / CAST(5 AS DOUBLE) + CAST(32 AS DOUBLE)
  WHEN 'K' THEN temperature_c + CAST(273.15 AS DOUBLE) ELSE temperature_c END, 6) AS back FROM sensors_clean""")
def _(t):
    return t.clean.select("event_id", fn.from_celsius("temperature_c", "unit_original").alias("back"))


@query("fn4_event_time", "SELECT event_id, TRY_STRPTIME(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time FROM sensors_raw")
def _(t):
    return t.raw.select("event_id", fn.parse_ts("ts").alias("event_time"))


@query("fn5_alert_flag", "SELECT event_id, CAST(CASE WHEN temperature_c > 80 THEN 1 ELSE 0 END AS INTEGER) AS alert FROM sensors_clean")
def _(t):
    return t.clean.select("event_id", fn.alert_flag("temperature_c").alias("alert"))


@query("fn6_epoch_seconds", "SELECT event_id, CAST(epoch(event_time) AS BIGINT) AS seconds FROM sensors_clean")
def _(t):
    return t.clean.select("event_id", fn.epoch_seconds("event_time").alias("seconds"))


@query("fn7_text_builtins", """
SELECT event_id, upper(trim(unit)) AS code, concat(coalesce(unit, 'null'), '!') AS shown,
       coalesce(upper(trim(unit)) IN ('C', 'F', 'K'), false) AS known FROM sensors_raw""")
def _(t):
    return t.raw.select("event_id", fn.unit_code("unit").alias("code"),
                        F.concat(F.coalesce("unit", F.lit("null")), F.lit("!")).alias("shown"),
                        F.coalesce(fn.unit_code("unit").isin(*C.UNITS), F.lit(False)).alias("known"))


@query("fn8_canonical_json", "SELECT event_id, content AS canonical FROM unsigned_messages")
def _(t):
    # the message arrives with another key order and with unsigned fields; the signed text must come out
    shuffled = F.regexp_replace(F.regexp_replace("content", r', "unit": "C"\}$', "}"), r"^\{",
                                '{"unit":"C", "_mqtt_qos":1, "hash":"x", ')
    return t.unsigned.select("event_id", fn.canonical_json(shuffled).alias("canonical"))


@query("fn9_sha256", "SELECT event_id, sha256(content) AS digest FROM unsigned_messages")
def _(t):
    return t.unsigned.select("event_id", fn.message_hash("content", F.lit("")).alias("digest"))


@query("fn10_text_clip", """
SELECT event_id, concat(substr(sha256(ts), 1, 16), '…') AS short, substr(reason, 1, 20) AS head,
       coalesce(device_id, substr(reason, 1, 20)) AS who FROM sensors_invalid""")
def _(t):
    return t.invalid.select("event_id", fn.clip(F.sha2("ts", 256), 16).alias("short"), F.substring("reason", 1, 20).alias("head"),
                            F.coalesce("device_id", F.substring("reason", 1, 20)).alias("who"))


@query("fn11_hour_minute", """
SELECT event_id, CAST(hour(event_time) AS INTEGER) AS hour, CAST(minute(event_time) AS INTEGER) AS minute FROM sensors_clean""")
def _(t):
    return t.clean.select("event_id", F.hour("event_time").alias("hour"), F.minute("event_time").alias("minute"))


@query("fn12_partition_columns", """
SELECT event_id, year, month, day, hour, concat(year, '-', month, '-', day, ' ', hour, 'h') AS particion FROM lake_clean""")
def _(t):
    return t.lake.select("event_id", "year", "month", "day", "hour", fn.partition_label().alias("particion"))


@query("fn13_path_partitions", """
SELECT event_id, year, month, day, hour FROM (SELECT event_id,
  concat('clean/year=', year, '/month=', month, '/day=', day, '/hour=', hour, '/part.json') AS path, year, month, day, hour FROM lake_clean)""")
def _(t):
    path = F.concat(F.lit("clean/year="), "year", F.lit("/month="), "month", F.lit("/day="), "day", F.lit("/hour="), "hour",
                    F.lit("/part.json"))
    return t.lake.select("event_id", *[c.alias(n) for n, c in fn.partitions_of_path(path).items()])


@query("fn14_status_labels", """
SELECT device_id, window_start, CASE WHEN avg_temp_c > 80 THEN '🔴 ALERTA' ELSE '🟢 OK' END AS estado,
  CASE WHEN avg_temp_c > 80 THEN 'ALERT' ELSE 'OK' END AS status,
  CASE WHEN avg_temp_c > 80 THEN 'red' WHEN avg_temp_c > 70 THEN 'orange' ELSE 'green' END AS color,
  CASE WHEN avg_temp_c < 5 THEN 'BUENA' WHEN avg_temp_c < 15 THEN 'ACEPTABLE' ELSE 'REVISAR' END AS grade,
  CASE WHEN avg_temp_c >= 95 THEN 'green' WHEN avg_temp_c >= 80 THEN 'orange' ELSE 'red' END AS gauge,
  CASE WHEN avg_temp_c - 70 > 0.1 THEN '🔺 subiendo' WHEN avg_temp_c - 70 < -0.1 THEN '🔻 bajando' ELSE '➡️  estable' END AS trend
FROM machine_stats""")
def _(t):
    v = "avg_temp_c"
    return t.stats.select("device_id", "window_start", fn.alert_label(v).alias("estado"), fn.status_label(v).alias("status"),
                          fn.heat_color(v).alias("color"), fn.quality_grade(v).alias("grade"), fn.gauge_color(v).alias("gauge"),
                          fn.trend_label(F.col(v) - 70).alias("trend"))


_EXACT = "CAST(format('{{:.{0}f}}', {1}) AS DOUBLE)"


@query("fn15_rounding", f"""
SELECT event_id, {_EXACT.format(2, 'value')} AS r2, {_EXACT.format(1, 'value')} AS r1, {_EXACT.format(2, 'floor(value) + 0.125::DOUBLE')} AS tie,
  {_EXACT.format(2, 'floor(value) + 0.675::DOUBLE')} AS near_tie, value * 1e16::DOUBLE AS large FROM events""")
def _(t):
    v = F.col("value")
    return t.table("events").select(
        "event_id", fn.round_even(v, 2).alias("r2"), fn.round_even(v, 1).alias("r1"), fn.round_even(F.floor(v) + 0.125, 2).alias("tie"),
        fn.round_even(F.floor(v) + 0.675, 2).alias("near_tie"), fn.round_even(v * 1e16, 2).alias("large"))


@query("fn15_display_rounding", f"""
SELECT device_id, window_start, {half_up('avg_temp_c', 2)} AS r2, {half_up('avg_temp_c', 3)} AS r3, {half_up('avg_temp_c', 4)} AS r4
FROM machine_stats""")
def _(t):
    return t.stats.select("device_id", "window_start", *[fn.round_half_up("avg_temp_c", k).alias(f"r{k}") for k in (2, 3, 4)])


@query("fn16_age_seconds", """
SELECT event_id, CAST(epoch((SELECT max(event_time) FROM sensors_clean)) - epoch(event_time) AS BIGINT) AS age FROM sensors_clean""")
def _(t):
    newest = t.clean.agg(F.max("event_time")).scalar()
    return t.clean.select("event_id", fn.age_seconds("event_time", newest).alias("age"))


@query("fn17_series_key", """
SELECT concat(device_id, CASE source WHEN 'InfluxDB (hot)' THEN ' (hot)' ELSE ' (cold)' END) AS trace_key, count(*) AS n
FROM unified GROUP BY 1""")
def _(t):
    return t.unified.groupBy(fn.series_key("device_id", "source").alias("trace_key")).agg(F.count(F.lit(1)).alias("n"))


_PROB = "greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (-score - CAST(0.1 AS DOUBLE)) / CAST(0.4 AS DOUBLE)))"


@query("fn18_failure_probability", f"SELECT device_id, ts, {half_up(_PROB, 4)} AS failure_prob FROM scores")
def _(t):
    return t.scores.select("device_id", "ts", fn.round_half_up(fn.failure_prob("score"), 4).alias("failure_prob"))


@query("fn19_interpretation", """
SELECT device_id, ts, CASE WHEN NOT is_anomaly THEN concat('Temperatura normal (', format('{:.1f}', avg_temp_c), '°C, media=70.0°C)')
  WHEN avg_temp_c > 85 THEN concat('Temperatura excepcionalmente ALTA (', format('{:.1f}', avg_temp_c), '°C > p95=85.0°C)')
  WHEN avg_temp_c < 48 THEN concat('Temperatura excepcionalmente BAJA (', format('{:.1f}', avg_temp_c), '°C < p5=48.0°C)')
  ELSE concat('Comportamiento anómalo detectado (score=', format('{:.3f}', score), ')') END AS interpretation FROM scores""")
def _(t):
    profile = [F.lit(v) for v in (70.0, 48.0, 85.0)]
    return t.scores.select("device_id", "ts", fn.interpret("avg_temp_c", "is_anomaly", "score", *profile).alias("interpretation"))


@query("fn20_processing_time")
def _(t):
    return t.raw.select("event_id", fn.processing_time().alias("proc_time"))


@query("udf1_sql_functions", f"""
SELECT event_id, {r6(celsius('temperature', 'unit', 'temperature'))} AS c FROM sensors_raw""")
def _(t):
    fn.register_functions(t.spark)
    return t.raw.select("event_id", F.expr("to_celsius(temperature, unit)").alias("c"))


@query("snk1_routed_counts", "SELECT CASE WHEN valid THEN 'clean' ELSE 'invalid' END AS route, count(*) AS n FROM sensors_routed GROUP BY 1")
def _(t):
    path = t.folder("routed")
    metrics.write_routed(t.routed, path)
    return t.spark.read.json(path, schema="event_id BIGINT, route STRING").groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query("snk2_topic_records", """
SELECT device_id AS key, concat('{"device_id":"', device_id, '","unit_original":"', unit_original, '","ts":"', ts, '"}') AS value
FROM sensors_clean""")
def _(t):
    return topics.to_topic_records(t.clean.select("device_id", "unit_original", "ts"))


@query("snk4_machine_stats_lines", """
SELECT concat('machine_stats,device_id=', device_id, ' avg_temp_c=', format('{:.4f}', avg_temp_c), ',max_temp_c=',
  format('{:.4f}', max_temp_c), ',count=', count_readings, 'i,alert=', alert, 'i ', CAST(epoch(window_start) AS BIGINT)) AS value
FROM machine_stats""")
def _(t):
    return metrics.machine_stats_lines(t.stats)


@query("snk5_reading_lines", """
SELECT concat('sensor_reading,device_id=', device_id, ',unit_original=', replace(unit_original, ' ', '\\ '), ' temperature_c=',
  CAST(temperature_c AS VARCHAR), ',ingested_at=', _ingested_at, 'i ', CAST(epoch(event_time) AS BIGINT)) AS value FROM sensors_clean""")
def _(t):
    return metrics.reading_lines(t.clean)


@query("val3_forwarded", f"""
SELECT event_id, device_id AS key, concat('{{"meta": {{"unit": "c"}}, "device_id": "', device_id, '", "temperature": ', CAST(temperature AS VARCHAR),
  ', "unit": "', upper(unit), '", "ts": "', ts, '", "_mqtt_topic": "t", "_mqtt_qos": 1, "_ingested_at": 9}}') AS value
FROM sensors_raw WHERE device_id <> '' AND temperature IS NOT NULL AND upper(unit) IN ('C', 'F', 'K')""")
def _(t):
    text = F.concat(
        F.lit('{"meta": {"unit": "c"}, "device_id": "'), "device_id", F.lit('", "temperature": '), F.col("temperature").cast("string"),
        F.lit(', "unit": "x", "unit": "'), "unit", F.lit('", "ts": "'), "ts", F.lit('"}'))
    messages = t.raw.where("device_id IS NOT NULL AND temperature IS NOT NULL AND unit IS NOT NULL").select("event_id", text.alias("value"))
    return ingest.forwarded(ingest.ingest(messages, "t", 1, F.lit(9)), keep=("event_id",))


@query("snk1_topic_records", """
SELECT CASE WHEN valid THEN 'sensors_clean' ELSE 'sensors_invalid' END AS topic, coalesce(device_id, 'unknown') AS key,
  concat('{"event_id":', event_id, CASE WHEN device_id IS NULL THEN '' ELSE concat(',"device_id":"', device_id, '"') END, ',"ts":"', ts, '"',
         CASE WHEN reason IS NULL THEN '' ELSE concat(',"reason":"', reason, '"') END, '}') AS value FROM sensors_routed""")
def _(t):
    return topics.routed_records(t.routed, ["event_id", "device_id", "ts"], ["event_id", "device_id", "ts", "reason"])


@query("rsh2_wide_to_long", f"SELECT device_id, ts, field, {r6('value')} AS value FROM metrics_long")
def _(t):
    return reshape.to_long(t.stats)
