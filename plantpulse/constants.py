"""Fixed values of the telemetry contract.

Everything here is data that other systems already depend on (reason texts,
limits, field names), so it is stated literally and must not be reworded.
"""

# --- Fixed values: hash chain -------------------------------------------------
GENESIS_HASH = "0" * 64
UNSIGNED_FIELDS = ("hash", "prev_hash", "_ingested_at", "_mqtt_topic", "_mqtt_qos")

# --- Fixed values: units and limits -------------------------------------------
UNITS = ("C", "F", "K")
STREAM_MIN_C, STREAM_MAX_C = -50.0, 1000.0
LIBRARY_MIN_C, LIBRARY_MAX_C = -50.0, 200.0
RAW_LIMITS = {"C": (-50.0, 200.0), "F": (-58.0, 392.0), "K": (223.15, 473.15)}
ALERT_THRESHOLD_C = 80.0
WARM_THRESHOLD_C = 70.0

# --- Fixed values: required fields --------------------------------------------
REQUIRED_RAW = ("device_id", "temperature", "unit", "ts", "hash", "prev_hash")
REQUIRED_CLEAN = ("device_id", "temperature_c", "ts")
REQUIRED_BRIDGE = ("device_id", "temperature", "unit", "ts")

# --- Fixed values: reject reasons ---------------------------------------------
REASON_DEVICE = "device_id ausente o vacío"
REASON_TEMPERATURE = "temperature ausente o no numérico"
REASON_UNIT = "unidad no reconocida: "
REASON_LOW = "temperatura bajo mínimo: "
REASON_HIGH = "temperatura sobre máximo: "
REASON_UNKNOWN = "motivo desconocido"
INGEST_NOT_UTF8 = "Payload no es UTF-8"
INGEST_BAD_JSON = "JSON inválido"
INGEST_NOT_OBJECT = "El JSON no es un objeto"
INGEST_NO_TEMPERATURE = "campo 'temperature' ausente"
INGEST_NOT_NUMERIC = "temperature no es numérico: "
INGEST_UNIT_SUFFIX = " (esperado C, F o K)"
INGEST_NO_TS = "campo 'ts' ausente"
NORMALIZATION_FAILED = "normalization_failed"
CHAIN_BAD_JSON = "JSON inválido en hash verifier"
CHAIN_BAD_PREV = "hash_chain_broken: prev_hash no coincide con estado Flink"
CHAIN_BAD_HASH = "hash_chain_broken: hash incorrecto (posible manipulación)"

# --- Fixed values: labels -----------------------------------------------------
SOURCE_HOT = "InfluxDB (hot)"
SOURCE_COLD = "MinIO (cold)"
NO_DATA = "SIN DATOS"
ROSTER = ("machine-001", "machine-002", "machine-003", "machine-004", "machine-005")

# --- Fixed values: topics
TOPIC_CLEAN, TOPIC_INVALID, TOPIC_VERIFIED = "sensors_clean", "sensors_invalid", "sensors_verified"
UNKNOWN_DEVICE = "unknown"

# --- Fixed values: formats ----------------------------------------------------
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
WATERMARK_DELAY = "10 seconds"
WINDOW_LENGTH = "1 minute"
LAKE_FLUSH = "60 seconds"
POINT_FLUSH = "5 seconds"
POINT_BATCH, POINT_SECONDS = 50, 5.0

# Characters that Python's str.strip() removes (SQL TRIM removes blanks only).
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
