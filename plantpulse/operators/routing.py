"""Unit normalization with exactly-one routing to clean rows or dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.functions import parse_ts, round_half_up, to_celsius, unit_code


def _two_decimals(c: Column) -> Column:
    # a value too wide for DECIMAL(10,2) keeps its own text instead of nulling the reason
    return F.coalesce(c.try_cast("decimal(10,2)").cast("string"), c.cast("string"))


def route(df: DataFrame, min_c: float = C.STREAM_MIN_C, max_c: float = C.STREAM_MAX_C) -> DataFrame:
    """Add ``temperature_c``, ``valid`` and ``reason`` (NULL for valid rows).

    ``valid`` is computed once and never NULL, so every row goes to exactly one
    side. The conversion appears once as a column and is shared by all checks.
    """
    celsius = F.col("temperature_c")
    numeric = F.col("temperature").isNotNull() & ~F.isnan("temperature")
    known_unit = F.coalesce(unit_code("unit").isin(*C.UNITS), F.lit(False))
    named = F.coalesce(F.col("device_id") != "", F.lit(False))
    valid = named & numeric & known_unit & F.coalesce(celsius.between(min_c, max_c), F.lit(False))
    reason = (
        F.when(~named, C.REASON_DEVICE)
        .when(~F.coalesce(numeric, F.lit(False)), C.REASON_TEMPERATURE)
        .when(~known_unit, F.concat(F.lit(C.REASON_UNIT), F.coalesce(F.col("unit"), F.lit("null"))))
        .when(celsius < min_c, F.concat(F.lit(C.REASON_LOW), _two_decimals(celsius), F.lit("C")))
        .when(celsius > max_c, F.concat(F.lit(C.REASON_HIGH), _two_decimals(celsius), F.lit("C")))
        .otherwise(C.REASON_UNKNOWN)
    )
    return (
        df.withColumn("temperature_c", to_celsius("temperature", "unit"))
        .withColumn("valid", F.coalesce(valid, F.lit(False)))
        .withColumn("reason", F.when(~F.col("valid"), reason))
    )


def clean_side(routed: DataFrame) -> DataFrame:
    """Valid rows in the shape of the clean topic, plus the parsed event time."""
    carried = [c for c in routed.columns if c in ("event_id",)]
    return routed.where("valid").select(
        *carried, "device_id", "temperature_c", F.col("unit").alias("unit_original"), "ts", "_ingested_at",
        parse_ts("ts").alias("event_time"),
    )


def invalid_side(routed: DataFrame, stage: str = "normalizer") -> DataFrame:
    """Dead letters. ``stage`` tells the producers apart, since several write here."""
    carried = [c for c in routed.columns if c in ("event_id",)]
    return routed.where(~F.col("valid")).select(
        *carried, "device_id", "temperature", "unit", "ts", "_ingested_at", "reason", F.lit(stage).alias("stage")
    )


def split(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return clean_side(routed), invalid_side(routed)


def normalize_library(df: DataFrame, min_c: float = C.LIBRARY_MIN_C, max_c: float = C.LIBRARY_MAX_C,
                      digits: int = 4) -> tuple[DataFrame, DataFrame]:
    """Batch contract: unknown units rejected, tighter range, rounded value, hash fields carried."""
    celsius = to_celsius(F.col("temperature").try_cast("double"), "unit", strict="null")
    raw = F.to_json(F.struct(*[c for c in df.columns]))
    work = df.withColumn("_celsius", celsius).withColumn(
        "_ok",
        F.coalesce(F.col("device_id").isNotNull() & F.col("ts").isNotNull() & ~F.isnan("_celsius")
                   & F.col("_celsius").between(min_c, max_c), F.lit(False)),
    )

    def optional(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")

    carried = [c for c in df.columns if c in ("event_id",)]
    clean = work.where("_ok").select(
        *carried, "device_id", round_half_up("_celsius", digits).alias("temperature_c"),
        F.col("unit").alias("unit_original"), "ts",
        optional("_ingested_at").alias("_ingested_at"), optional("hash").alias("hash"),
        optional("prev_hash").alias("prev_hash"),
    )
    invalid = work.where(~F.col("_ok")).select(*carried, raw.alias("raw"), F.lit(C.NORMALIZATION_FAILED).alias("reason"))
    return clean, invalid
