"""Telemetry views derived from the given ``events`` table, in Spark and as SQL text.

The SQL is for the side-by-side check only; both sides read the same rows.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.functions import parse_ts
from plantpulse.operators import chain, reshape, routing, unify, windows
from plantpulse.session import cut, prepare, scratch
from plantpulse.sources import lake

# One message every two seconds in event order, with every fault class on its own residue.
_RAW = """
SELECT event_id,
  CASE WHEN event_id % 50 = 7 THEN NULL WHEN event_id % 50 = 13 THEN ''
       ELSE concat('machine-', lpad(CAST(user_id % 5 + 1 AS VARCHAR(10)), 3, '0')) END AS device_id,
  CASE WHEN event_id % 50 = 19 THEN NULL
       WHEN event_id % 50 = 23 THEN CAST(99999.0 AS DOUBLE)
       WHEN event_id % 50 = 29 THEN CAST(-500.0 AS DOUBLE)
       WHEN event_type IN ('view', 'error')
         THEN (CAST(45 AS DOUBLE) + value % CAST(50 AS DOUBLE)) * CAST(9 AS DOUBLE) / CAST(5 AS DOUBLE) + CAST(32 AS DOUBLE)
       WHEN event_type = 'purchase' THEN CAST(45 AS DOUBLE) + value % CAST(50 AS DOUBLE) + CAST(273.15 AS DOUBLE)
       ELSE CAST(45 AS DOUBLE) + value % CAST(50 AS DOUBLE) END AS temperature,
  CASE WHEN event_id % 50 = 31 THEN NULL WHEN event_id % 50 = 37 THEN 'RANKINE'
       WHEN event_type = 'view' THEN 'F' WHEN event_type = 'error' THEN ' f '
       WHEN event_type = 'purchase' THEN 'K' WHEN event_type = 'signup' THEN 'c'
       ELSE 'C' END AS unit,
  {ts} AS ts,
  1773187200000 + event_id * 2000 AS _ingested_at
FROM {events}
"""
_SIGN = """
SELECT event_id, device_id, ts,
  concat('{{"device_id": "', device_id, '", "temperature": ', CAST(value AS VARCHAR(30)), ', "ts": "', ts, '", "unit": "C"}}') AS content,
  concat('{{"device_id": "', device_id, '", "temperature": ',
         CAST(CASE WHEN event_id % 400 = 111 THEN value + CAST(1000 AS DOUBLE) ELSE value END AS VARCHAR(30)),
         ', "ts": "', ts, '", "unit": "C"}}') AS content_seen
FROM (SELECT event_id, value, concat('machine-', lpad(CAST(user_id + 1 AS VARCHAR(10)), 6, '0')) AS device_id, {ts} AS ts
      FROM {events}) e
"""
_SPARK_TS = ("date_format(timestamp_ntz'2026-03-11 00:00:00' + make_dt_interval(0, 0, 0, event_id * 2), "
             "\"yyyy-MM-dd'T'HH:mm:ss'Z'\")")
_DUCK_TS = "strftime(TIMESTAMP '2026-03-11 00:00:00' + to_seconds(event_id * 2), '%Y-%m-%dT%H:%M:%SZ')"


class Tables:
    """Lazy Spark frames of the fixture views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepare(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _sql(self, text: str) -> DataFrame:
        # the table is passed as a parameter, so no view is left behind
        return self.spark.sql(text.format(ts=_SPARK_TS, events="{events}"), events=self.table("events"))

    @cached_property
    def raw(self) -> DataFrame:
        # the derived row comes out of a generator, so it is computed once and later filters
        # see plain columns, as they would on a stored topic
        return self._sql(_RAW).select(F.inline(F.array(F.struct("*"))))

    @cached_property
    def messages(self) -> DataFrame:
        """The raw rows as JSON text with their offset."""
        body = F.struct("device_id", "temperature", "unit", "ts")
        return self.raw.select(F.col("event_id").alias("offset"), F.to_json(body).alias("value"))

    @cached_property
    def routed(self) -> DataFrame:
        return routing.route(self.raw)

    @cached_property
    def clean(self) -> DataFrame:
        return routing.clean_side(self.routed)

    @cached_property
    def invalid(self) -> DataFrame:
        return routing.invalid_side(self.routed)

    @cached_property
    def stats(self) -> DataFrame:
        return windows.window_stats(self.clean)

    @cached_property
    def long(self) -> DataFrame:
        return reshape.to_long(self.stats)

    @cached_property
    def lake(self) -> DataFrame:
        return lake.with_partitions(self.clean)

    @cached_property
    def unified(self) -> DataFrame:
        return unify.unify(self.stats, self.lake)

    @cached_property
    def scores(self) -> DataFrame:
        """Stand-in scores, so that score functions can be compared exactly."""
        score = -(F.lit(0.3) + F.abs(F.col("avg_temp_c") - 70.0) / 100.0)
        return self.stats.select("device_id", F.col("window_start").alias("ts"), "avg_temp_c", score.alias("score"),
                                 (score < -0.5).alias("is_anomaly"))

    @cached_property
    def unsigned(self) -> DataFrame:
        """Message contents per device; some rows carry content that was changed after signing."""
        return self._sql(_SIGN.replace("{{", "{{{{").replace("}}", "}}}}")).withColumn("event_time", parse_ts("ts"))

    @cached_property
    def signed(self) -> DataFrame:
        # the fold is the costly part and several jobs read it
        return cut(chain.sign_chain(self.unsigned), "signed")

    @cached_property
    def verified(self) -> DataFrame:
        return chain.verify_chain(self.signed, canonical="content_seen")

    def folder(self, label: str) -> str:
        return scratch(self.spark, label)


# --- the same views as SQL -------------------------------------------------------

def r6(expr: str) -> str:
    return f"round({expr}, 6)"


def half_up(expr: str, digits: int) -> str:
    scale = f"CAST({10**digits} AS DOUBLE)"
    return f"(floor(({expr}) * {scale} + CAST(0.5000001 AS DOUBLE)) / {scale})"


def celsius(t: str, unit: str, unknown: str) -> str:
    return (f"CASE WHEN {t} IS NULL OR {unit} IS NULL THEN NULL "
            f"WHEN upper(trim({unit})) = 'F' THEN ({t} - CAST(32 AS DOUBLE)) * CAST(5 AS DOUBLE) / CAST(9 AS DOUBLE) "
            f"WHEN upper(trim({unit})) = 'K' THEN {t} - CAST(273.15 AS DOUBLE) "
            f"WHEN upper(trim({unit})) = 'C' THEN {t} ELSE {unknown} END")


def _two(x: str) -> str:
    return f"coalesce(CAST(TRY_CAST({x} AS DECIMAL(10, 2)) AS VARCHAR), CAST({x} AS VARCHAR))"


ANCHOR = "(SELECT max(window_start) FROM machine_stats)"
VIEWS: dict[str, str] = {
    "sensors_raw": _RAW.format(ts=_DUCK_TS, events="events"),
    "sensors_routed": f"""
      SELECT *, CASE WHEN valid THEN NULL
        WHEN device_id IS NULL OR device_id = '' THEN '{C.REASON_DEVICE}'
        WHEN temperature IS NULL THEN '{C.REASON_TEMPERATURE}'
        WHEN unit IS NULL OR upper(trim(unit)) NOT IN ('C', 'F', 'K') THEN concat('{C.REASON_UNIT}', coalesce(unit, 'null'))
        WHEN temperature_c < -50 THEN concat('{C.REASON_LOW}', {_two('temperature_c')}, 'C')
        WHEN temperature_c > 1000 THEN concat('{C.REASON_HIGH}', {_two('temperature_c')}, 'C')
        ELSE '{C.REASON_UNKNOWN}' END AS reason
      FROM (SELECT *, coalesce(device_id <> '' AND temperature IS NOT NULL AND upper(trim(unit)) IN ('C', 'F', 'K')
                               AND temperature_c BETWEEN -50 AND 1000, false) AS valid
            FROM (SELECT *, {celsius('temperature', 'unit', 'temperature')} AS temperature_c FROM sensors_raw))""",
    "sensors_clean": """
      SELECT event_id, device_id, temperature_c, unit AS unit_original, ts, _ingested_at,
             TRY_STRPTIME(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time
      FROM sensors_routed WHERE valid""",
    "sensors_invalid": """
      SELECT event_id, device_id, temperature, unit, ts, _ingested_at, reason, 'normalizer' AS stage
      FROM sensors_routed WHERE NOT valid""",
    "machine_stats": """
      SELECT device_id, window_start, window_start + INTERVAL 1 MINUTE AS window_end, avg_temp_c, max_temp_c, count_readings,
             CAST(CASE WHEN avg_temp_c > 80 THEN 1 ELSE 0 END AS INTEGER) AS alert
      FROM (SELECT device_id, time_bucket(INTERVAL '1 minute', event_time) AS window_start, avg(temperature_c) AS avg_temp_c,
                   max(temperature_c) AS max_temp_c, count(*) AS count_readings
            FROM sensors_clean WHERE temperature_c IS NOT NULL GROUP BY ALL)""",
    "metrics_long": """
      SELECT device_id, window_start AS ts, 'avg_temp_c' AS field, avg_temp_c AS value FROM machine_stats
      UNION ALL SELECT device_id, window_start, 'max_temp_c', max_temp_c FROM machine_stats
      UNION ALL SELECT device_id, window_start, 'count_readings', CAST(count_readings AS DOUBLE) FROM machine_stats
      UNION ALL SELECT device_id, window_start, 'alert', CAST(alert AS DOUBLE) FROM machine_stats""",
    "lake_clean": """
      SELECT *, strftime(event_time, '%Y') AS year, strftime(event_time, '%m') AS month, strftime(event_time, '%d') AS day,
             strftime(event_time, '%H') AS hour FROM sensors_clean""",
    "unified": f"""
      SELECT device_id, avg_temp_c AS value, window_start AS ts, '{C.SOURCE_HOT}' AS source FROM machine_stats
      UNION ALL SELECT device_id, temperature_c, event_time, '{C.SOURCE_COLD}' FROM lake_clean
      WHERE temperature_c IS NOT NULL AND device_id IS NOT NULL""",
    "scores": """
      SELECT device_id, window_start AS ts, avg_temp_c, score, score < -0.5 AS is_anomaly
      FROM (SELECT *, -(CAST(0.3 AS DOUBLE) + abs(avg_temp_c - CAST(70 AS DOUBLE)) / CAST(100 AS DOUBLE)) AS score FROM machine_stats)""",
    "unsigned_messages": _SIGN.format(ts=_DUCK_TS, events="events"),
    "numbered_messages": "SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY event_id) AS rn FROM unsigned_messages",
    "signed_messages": f"""
      SELECT *, '{C.GENESIS_HASH}' AS prev_hash, sha256(concat(content, '{C.GENESIS_HASH}')) AS hash
      FROM numbered_messages WHERE rn = 1
      UNION ALL
      SELECT n.*, s.hash, sha256(concat(n.content, s.hash))
      FROM signed_messages s JOIN numbered_messages n ON n.device_id = s.device_id AND n.rn = s.rn + 1""",
    "verified_messages": f"""
      SELECT device_id, event_id, ts, rn, hash = sha256(concat(content_seen, prev_hash)) AS ok, '{C.GENESIS_HASH}' AS expected,
             CASE WHEN hash = sha256(concat(content_seen, prev_hash)) THEN hash ELSE '{C.GENESIS_HASH}' END AS state
      FROM signed_messages WHERE rn = 1
      UNION ALL
      SELECT s.device_id, s.event_id, s.ts, s.rn,
             s.prev_hash = v.state AND s.hash = sha256(concat(s.content_seen, s.prev_hash)), v.state,
             CASE WHEN s.prev_hash = v.state AND s.hash = sha256(concat(s.content_seen, s.prev_hash)) THEN s.hash ELSE v.state END
      FROM verified_messages v JOIN signed_messages s ON s.device_id = v.device_id AND s.rn = v.rn + 1""",
    "scaled": """
      SELECT device_id, window_start, avg_temp_c, (avg_temp_c - m) / CASE WHEN s > 0 THEN s ELSE 1 END AS z,
             row_number() OVER (PARTITION BY device_id ORDER BY window_start) AS rn
      FROM machine_stats JOIN (SELECT device_id, avg(avg_temp_c) AS m, stddev_pop(avg_temp_c) AS s, count(*) AS n
                               FROM machine_stats GROUP BY device_id) USING (device_id) WHERE n >= 10""",
    "cusum_rows": """
      SELECT device_id, window_start, avg_temp_c, rn, up > 4 OR down > 4 AS is_break, up, down
      FROM (SELECT *, greatest(CAST(0 AS DOUBLE), z - CAST(0.5 AS DOUBLE)) AS up,
                   greatest(CAST(0 AS DOUBLE), -z - CAST(0.5 AS DOUBLE)) AS down FROM scaled WHERE rn = 1)
      UNION ALL
      SELECT device_id, window_start, avg_temp_c, rn, up > 4 OR down > 4, up, down
      FROM (SELECT s.*, greatest(CAST(0 AS DOUBLE), CASE WHEN c.is_break THEN 0 ELSE c.up END + s.z - CAST(0.5 AS DOUBLE)) AS up,
                   greatest(CAST(0 AS DOUBLE), CASE WHEN c.is_break THEN 0 ELSE c.down END - s.z - CAST(0.5 AS DOUBLE)) AS down
            FROM cusum_rows c JOIN scaled s ON s.device_id = c.device_id AND s.rn = c.rn + 1)""",
    "indexed": """
      SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY window_start) - 1 AS idx FROM machine_stats""",
}


def with_views(sql: str) -> str:
    """Put the views a statement needs, directly or through other views, in front of it."""
    names = "|".join(VIEWS)
    wanted: list[str] = []

    def visit(text: str, inside: str | None = None) -> None:
        for name in re.findall(rf"\b({names})\b", text):
            if name != inside and name not in wanted:
                visit(VIEWS[name], name)
                if name not in wanted:
                    wanted.append(name)

    visit(sql)
    if not wanted:
        return sql
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in wanted) + "\n" + sql
