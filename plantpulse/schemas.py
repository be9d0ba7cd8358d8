"""Declared row types of the topics, the metric table and the lake."""

from pyspark.sql import types as T


_TYPES = {"STRING": T.StringType(), "DOUBLE": T.DoubleType(), "BIGINT": T.LongType(), "INT": T.IntegerType(),
          "TIMESTAMP": T.TimestampType()}


def _struct(spec: str) -> T.StructType:
    pairs = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# temperature stays text until try_cast, so "75.0" and 75.0 both parse
RAW_MESSAGE = _struct(
    "device_id STRING, temperature STRING, unit STRING, ts STRING, "
    "_ingested_at STRING, hash STRING, prev_hash STRING, _mqtt_topic STRING, _mqtt_qos STRING"
)
CLEAN_MESSAGE = _struct(
    "device_id STRING, temperature_c DOUBLE, unit_original STRING, ts STRING, _ingested_at BIGINT"
)
LAKE = _struct(
    "device_id STRING, temperature_c DOUBLE, unit_original STRING, ts STRING, _ingested_at BIGINT, "
    "year STRING, month STRING, day STRING, hour STRING"
)
MACHINE_STATS = _struct(
    "device_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, avg_temp_c DOUBLE, "
    "max_temp_c DOUBLE, count_readings BIGINT, alert INT"
)
METRIC_FIELDS = ("avg_temp_c", "max_temp_c", "count_readings", "alert")
