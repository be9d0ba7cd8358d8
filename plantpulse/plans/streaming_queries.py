"""Streams run to the end of their input; results are read from their sinks."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from plantpulse.operators.windows import window_stats
from plantpulse.plans.fixtures import r6
from plantpulse.plans.registry import query
from plantpulse.sources import lake, segments, topics
from plantpulse.streaming import late, pipelines, verifier


#: Files of one part of a staged topic, and files that a micro-batch reads.
FILES = 4


def _staged(t, df, label: str):
    """Message text as files, read back as a stream."""
    path = t.folder(label)
    df.write.text(path)
    return topics.read_topic(t.spark, path, streaming=True)


def _clean_stream(t, delayed: bool = False):
    """The clean rows as a stream with typed columns, in three micro-batches in order of time.

    With ``delayed``, some rows of the first two come with the last one.
    """
    path = t.folder("clean-topic")
    ends = t.clean.agg(F.min("event_id").alias("lo"), (F.max("event_id") + 1).alias("hi")).first()
    third = F.floor((F.col("event_id") - ends["lo"]) * 3 / (ends["hi"] - ends["lo"])) if ends["hi"] else F.lit(0)
    if delayed:
        third = F.when(F.col("event_id") % 97 == 5, 2).otherwise(third)
    for part in range(3):
        rows = t.clean.where(third == part).drop("event_id", "event_time").select(F.to_json(F.struct("*")).alias("value"))
        rows.repartition(FILES).write.mode("append").text(path)
    return topics.clean_topic(topics.read_topic(t.spark, path, streaming=True, max_files=FILES))


@query("str1_str2_stream_windows", f"""
SELECT device_id, window_start, window_end, {r6('avg_temp_c')} AS avg_temp_c, {r6('max_temp_c')} AS max_temp_c, count_readings, alert
FROM machine_stats WHERE window_end <= (SELECT max(event_time) FROM sensors_clean) - INTERVAL 10 SECOND""")
def _(t):
    out = t.folder("windows")
    pipelines.analytics_stream(_clean_stream(t), out, t.folder("ck")).awaitTermination()
    return t.spark.read.parquet(out).drop("batch")


@query("str4_stream_alerts", """
SELECT device_id, window_start, alert FROM machine_stats
WHERE alert = 1 AND window_end <= (SELECT max(event_time) FROM sensors_clean) - INTERVAL 10 SECOND""")
def _(t):
    out = t.folder("windows")
    pipelines.analytics_stream(_clean_stream(t), out, t.folder("ck")).awaitTermination()
    return t.spark.read.parquet(out).where("alert = 1").select("device_id", "window_start", "alert")


@query("str8_snk1_stream_routing", """
SELECT CASE WHEN valid THEN 'clean' ELSE 'invalid' END AS route, device_id, ts, reason FROM sensors_routed""")
def _(t):
    out = t.folder("routed")
    records = _staged(t, t.messages.select("value"), "raw-topic")
    pipelines.normalize_stream(records, out, t.folder("ck")).awaitTermination()
    return t.spark.read.schema("route STRING, device_id STRING, ts STRING, reason STRING").json(out).drop("batch")


@query("str11_restart_from_checkpoint", "SELECT valid, count(*) AS n FROM sensors_routed GROUP BY valid")
def _(t):
    source, out, checkpoint = t.folder("raw-topic"), t.folder("routed"), t.folder("ck")
    body = F.to_json(F.struct("device_id", "temperature", "unit", "ts")).alias("value")
    for part in (t.routed.where("valid"), t.routed.where("NOT valid")):
        # the second run sees both parts but reads only what is new
        part.select(body).write.mode("append").text(source)
        records = topics.read_topic(t.spark, source, streaming=True)
        pipelines.normalize_stream(records, out, checkpoint).awaitTermination()
    return t.spark.read.schema("valid BOOLEAN").json(out).groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


@query("src3_str7_raw_text_keys", "SELECT coalesce(device_id, 'unknown') AS key, count(*) AS n FROM sensors_raw GROUP BY 1")
def _(t):
    out = t.folder("raw-copy")
    records = _staged(t, t.messages.select("value"), "raw-topic")
    records.writeStream.format("parquet").option("path", out).option("checkpointLocation", t.folder("ck")).trigger(
        availableNow=True).start().awaitTermination()
    key = F.coalesce(F.get_json_object("value", "$.device_id"), F.lit("unknown"))
    return t.spark.read.parquet(out).groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query("str10_stream_points", """
SELECT concat('sensor_reading,device_id=', device_id, ',unit_original=', replace(unit_original, ' ', '\\ '), ' temperature_c=',
  CAST(temperature_c AS VARCHAR), ',ingested_at=', _ingested_at, 'i ', CAST(epoch(event_time) AS BIGINT)) AS value FROM sensors_clean""")
def _(t):
    out = t.folder("points")
    pipelines.point_stream(_clean_stream(t), out, t.folder("ck"), interval=None).awaitTermination()
    return t.spark.read.text(out).select("value")


@query("str9_snk6_stream_lake", """
SELECT device_id, unit_original, ts, _ingested_at, year, month, day, hour FROM lake_clean""")
def _(t):
    out = t.folder("lake")
    clean = topics.with_event_time(_clean_stream(t)).drop("_corrupt")
    lake.stream_lake(clean, out, t.folder("ck"), interval=None).awaitTermination()
    return lake.read_lake(t.spark, out).select("device_id", "unit_original", "ts", "_ingested_at", "year", "month", "day", "hour")


_SIGNED_SEQ = "CAST(get_json_object(value, '$._ingested_at') AS BIGINT)"


def _signed_stream(t):
    fields = F.concat(F.lit(', "prev_hash": "'), "prev_hash", F.lit('", "hash": "'), "hash",
                      F.lit('", "_ingested_at": '), F.col("event_id").cast("string"), F.lit("}"))
    text = F.concat(F.regexp_replace("content_seen", r"\}$", ""), fields).alias("value")
    return _staged(t, t.signed.select(text), "signed-topic")


@query("str5_str6_stream_verifier", """
SELECT device_id AS key, event_id AS seq, CASE WHEN ok THEN 'ok' ELSE 'dlq' END AS tag FROM verified_messages""")
def _(t):
    out = t.folder("tagged")
    verifier.verify_topic(_signed_stream(t), out, t.folder("ck"), _SIGNED_SEQ).awaitTermination()
    return t.spark.read.schema("key STRING, seq BIGINT, tag STRING").json(out).drop("batch")


@query("udf2_keyed_state_verifier", """
SELECT device_id AS key, event_id AS seq, CASE WHEN ok THEN 'ok' ELSE 'dlq' END AS tag FROM verified_messages""")
def _(t):
    verifier.use_state_store(t.spark)
    out = t.folder("tagged")
    pipelines.tagged_stream(verifier.verify_stream(_signed_stream(t), _SIGNED_SEQ), out, t.folder("ck")).awaitTermination()
    return t.spark.read.schema("key STRING, seq BIGINT, tag STRING").json(out).drop("batch")


@query("snk3_tagged_records", """
SELECT CASE WHEN ok THEN 'sensors_verified' ELSE 'sensors_invalid' END AS topic, device_id AS key, event_id AS seq FROM verified_messages""")
def _(t):
    out = t.folder("tagged")
    verifier.verify_topic(_signed_stream(t), out, t.folder("ck"), _SIGNED_SEQ).awaitTermination()
    tagged = t.spark.read.schema("key STRING, seq BIGINT, tag STRING, payload STRING").json(out)
    return topics.tagged_records(tagged).select("topic", "key", F.get_json_object("value", "$._ingested_at").cast("bigint").alias("seq"))


# The batch of a row, the watermark that earlier batches left, and whether the row's window had ended by then.
_LATE = """
WITH ends AS (SELECT min(event_id) AS lo, max(event_id) + 1 AS hi FROM sensors_clean),
placed AS (SELECT s.*, CASE WHEN event_id % 97 = 5 THEN 2 ELSE CAST(floor((event_id - lo) * 3 / (hi - lo)) AS BIGINT) END AS batch FROM sensors_clean s, ends),
marks AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 SECOND AS watermark
          FROM (SELECT batch, max(event_time) AS newest FROM placed GROUP BY batch)),
judged AS (SELECT p.*, coalesce(time_bucket(INTERVAL '1 minute', event_time) + INTERVAL 1 MINUTE <= watermark, false) AS late
           FROM placed p JOIN marks USING (batch))
"""


def _routed(t) -> str:
    out = t.folder("late")
    timed = topics.with_event_time(_clean_stream(t, delayed=True)).drop("_corrupt")
    late.route_late(timed, out, t.folder("ck")).awaitTermination()
    return out


def _late_sql(tail: str) -> str:
    return _LATE + tail


@query("str3_late_rows", "SELECT device_id, ts, late FROM (" + _late_sql("SELECT device_id, ts, late FROM judged") + ")")
def _(t):
    out = _routed(t)
    sides = [late.routed_rows(t.spark, out, side).select("device_id", "ts", F.lit(side == late.LATE).alias("late")) for side in (late.ON_TIME, late.LATE)]
    return sides[0].unionByName(sides[1])


@query("str3_late_counts", "SELECT * FROM (" + _late_sql("""
SELECT batch, count(*) AS offered, count(*) FILTER (late) AS late, CAST(0 AS BIGINT) AS untimed, count(*) FILTER (NOT late) AS on_time FROM judged GROUP BY batch""") + ")")
def _(t):
    return late.late_counts(t.spark, _routed(t))


@query("str3_counted_rows", "SELECT * FROM (" + _late_sql("""
SELECT device_id, time_bucket(INTERVAL '1 minute', event_time) AS window_start, count(*) AS count_readings FROM judged WHERE NOT late GROUP BY ALL""") + ")")
def _(t):
    return window_stats(late.routed_rows(t.spark, _routed(t), late.ON_TIME)).select("device_id", "window_start", "count_readings")


def _finished(t, stream, path: str, rows: int, seconds: int = 240) -> None:
    """Wait until the batches below ``path`` hold all rows: the last points of a stream are due some time after they came."""
    deadline = time.monotonic() + seconds
    try:
        while time.monotonic() < deadline and stream.isActive:
            time.sleep(1)
            if (t.spark.read.schema("n BIGINT").json(path).agg(F.sum("n")).first()[0] or 0) >= rows:
                return
    finally:
        stream.stop()


@query("str10_gathered_points", """
SELECT concat('sensor_reading,device_id=', device_id, ',unit_original=', replace(unit_original, ' ', '\\ '), ' temperature_c=',
  CAST(temperature_c AS VARCHAR), ',ingested_at=', _ingested_at, 'i ', CAST(epoch(event_time) AS BIGINT)) AS value, true AS bounded FROM sensors_clean""")
def _(t):
    verifier.use_state_store(t.spark)
    out = t.folder("points")
    t.spark.createDataFrame([], "n BIGINT").write.mode("overwrite").json(out)
    _finished(t, pipelines.gathered_stream(_clean_stream(t), out, t.folder("ck")), out, t.clean.count())
    batches = t.spark.read.schema("cause STRING, n BIGINT, lines ARRAY<STRING>").json(out)
    bounded = F.when(F.col("cause") == "full", F.col("n") == 50).otherwise(F.col("n") < 50) & (F.size("lines") == F.col("n"))
    return batches.select(F.explode("lines").alias("value"), bounded.alias("bounded"))


@query("udf3_failed_deliveries", """
SELECT value FROM (SELECT device_id, concat('machine_stats,device_id=', device_id) AS value FROM machine_stats
  WHERE window_end <= (SELECT max(event_time) FROM sensors_clean) - INTERVAL 10 SECOND) WHERE device_id = 'machine-003'""")
def _(t):
    def refuse(lines: list[str]) -> None:
        if any("machine-003" in line for line in lines):
            raise OSError("refused")

    failed = t.folder("failed")
    pipelines.delivery_stream(_clean_stream(t), refuse, failed, t.folder("ck"), batch=1).awaitTermination()
    return t.spark.read.schema("value STRING, error STRING").json(failed).where("error = 'OSError: refused'").select(F.substring_index("value", " ", 1).alias("value"))


@query("src7_segment_sample", """
SELECT "offset", n_fields FROM (SELECT row_number() OVER (ORDER BY event_id) - 1 AS "offset",
  CAST((device_id IS NOT NULL)::INT + (temperature IS NOT NULL)::INT + (unit IS NOT NULL)::INT + 1 AS INTEGER) AS n_fields
  FROM sensors_raw ORDER BY event_id LIMIT 500)""")
def _(t):
    path = t.folder("raw-topic")
    rows = t.messages.select(F.lit(None).cast("string").alias("key"), "value", "offset", F.lit(0).alias("p"))
    segments.append_segments(rows, path, ["offset"], partition="p", segment_rows=300)
    return segments.sample(t.spark, path, 500).select("offset", F.size(F.json_object_keys("value")).alias("n_fields"))


@query("src8_segment_extents", """
SELECT 'raw-topic' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", CAST(0 AS BIGINT) AS low, count(*) AS high, count(*) AS mensajes, count(*) AS retenidos
FROM sensors_raw GROUP BY 2""")
def _(t):
    path = t.folder("raw-topic")
    rows = t.messages.select(F.lit(None).cast("string").alias("key"), "value", "offset", (F.col("offset") % 4).alias("p"))
    segments.append_segments(rows, path, ["offset"], partition="p", segment_rows=1000)
    return segments.extents(t.spark, path, "raw-topic")


@query("str11_segment_restart", """
SELECT CAST(event_id % 4 AS INTEGER) AS "partition", row_number() OVER (PARTITION BY event_id % 4 ORDER BY NOT valid, event_id) - 1 AS "offset", valid, ts FROM sensors_routed""")
def _(t):
    source, out, checkpoint = t.folder("raw-topic"), t.folder("routed"), t.folder("ck")
    body = F.to_json(F.struct("device_id", "temperature", "unit", "ts", "valid")).alias("value")
    for part in (t.routed.where("valid"), t.routed.where("NOT valid")):
        # the second run begins at the offsets where the first one ended
        rows = part.select(F.lit(None).cast("string").alias("key"), body, "event_id", (F.col("event_id") % 4).alias("p"))
        segments.append_segments(rows, source, ["event_id"], partition="p")
        records = segments.read_segments(t.spark, source, streaming=True)
        records.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    got = t.spark.read.parquet(out)
    return got.select("partition", "offset", F.get_json_object("value", "$.valid").cast("boolean").alias("valid"), F.get_json_object("value", "$.ts").alias("ts"))


@query("snk6_compacted_lake", "SELECT device_id, unit_original, ts, _ingested_at, year, month, day, hour FROM lake_clean")
def _(t):
    out = t.folder("lake")
    for part in range(3):
        lake.write_lake(t.clean.where(F.col("event_id") % 3 == part).drop("event_id"), out)
    lake.compact_lake(t.spark, out)
    return lake.read_lake(t.spark, out).select("device_id", "unit_original", "ts", "_ingested_at", "year", "month", "day", "hour")
