"""Tolerant ingest of raw messages: decode, validate with a reason, enrich."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.functions import quoted, strip


def ingest(messages: DataFrame, source_topic: str, qos: int = 1, clock: Column | None = None,
           value: str = "value") -> DataFrame:
    """Parse raw bytes or text and attach ``reject_reason`` (NULL = accepted).

    Fields come from a VARIANT, which keeps the JSON type of every value; the
    checks need it (a numeric device_id is rejected, a numeric text temperature
    is not). All of it runs inside the JVM.
    """
    clock = F.unix_millis(F.current_timestamp()) if clock is None else clock
    text = F.col(value).cast("string")
    doc = F.when(F.is_valid_utf8(text), F.try_parse_json(text))
    # as a one-element explode: a filter on the reason can then not copy the parse into itself
    parsed = messages.withColumn("_utf8", F.is_valid_utf8(text)).select("*", F.explode(F.array(doc)).alias("_doc"))

    def kind(field: str) -> Column:
        return F.expr(f"schema_of_variant(try_variant_get(_doc, '$.{field}', 'variant'))")

    def string(field: str) -> Column:
        return F.try_variant_get("_doc", f"$.{field}", "string")

    parsed = parsed.withColumns({
        "device_id": string("device_id"),
        "_temperature": string("temperature"),
        "_unit": string("unit"),
        "ts": string("ts"),
        "hash": string("hash"),
        "prev_hash": string("prev_hash"),
    })
    # JSON types other than the device's are looked up only inside branches that need them
    plain = F.when(F.col("_temperature").isin("true", "false") & (kind("temperature") == "BOOLEAN"),
                   (F.col("_temperature") == "true").cast("double")).otherwise(strip("_temperature").try_cast("double"))
    parsed = parsed.withColumn("temperature", plain)
    number = F.col("temperature")
    unit_shown = (
        F.when(F.col("_unit").isNull(), F.when(kind("unit") == "VOID", "None").otherwise("''"))
        .when(kind("unit") == "STRING", quoted("_unit"))
        .otherwise(F.col("_unit"))
    )
    temperature_shown = F.when(kind("temperature") == "STRING", quoted("_temperature")).otherwise(F.col("_temperature"))
    temperature_absent = F.col("_temperature").isNull()
    reason = (
        F.when(~F.col("_utf8"), C.INGEST_NOT_UTF8)
        .when(F.col("_doc").isNull(), C.INGEST_BAD_JSON)
        .when(~F.startswith(strip(text), F.lit("{")), C.INGEST_NOT_OBJECT)
        .when(F.coalesce(strip("device_id"), F.lit("")) == "", C.REASON_DEVICE)
        .when(kind("device_id") != "STRING", C.REASON_DEVICE)
        .when(temperature_absent, C.INGEST_NO_TEMPERATURE)
        .when(number.isNull(), F.concat(F.lit(C.INGEST_NOT_NUMERIC), temperature_shown))
        .when(~F.coalesce(F.upper("_unit").isin(*C.UNITS), F.lit(False)),
              F.concat(F.lit(C.REASON_UNIT), F.coalesce(unit_shown, F.lit("None")), F.lit(C.INGEST_UNIT_SUFFIX)))
        .when(F.coalesce(F.col("ts"), F.lit("")) == "", C.INGEST_NO_TS)
    )
    keep = [c for c in messages.columns]
    return parsed.select(
        *keep,
        "device_id",
        "temperature",
        # upper-cased after signing, so a lower-case unit later fails the hash check
        F.upper("_unit").alias("unit"),
        "ts",
        "hash",
        "prev_hash",
        F.lit(source_topic).alias("_mqtt_topic"),
        F.lit(qos).cast("int").alias("_mqtt_qos"),
        clock.cast("bigint").alias("_ingested_at"),
        reason.alias("reject_reason"),
    )


def _enriched(added: pd.DataFrame) -> pd.Series:
    """Messages with their own unit upper-cased and the added fields last; nested and repeated keys as JSON has them."""
    out = []
    for row in added.itertuples(index=False):
        message = json.loads(row.text)
        message["unit"] = message["unit"].upper()
        message |= {"_mqtt_topic": row.topic, "_mqtt_qos": int(row.qos), "_ingested_at": int(row.at)}
        out.append(json.dumps(message, ensure_ascii=False))
    return pd.Series(out, dtype=object)


def forwarded(ingested: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Accepted messages as topic records: key = device_id, value = enriched JSON.

    Only the unit at the top level changes. Numbers are written back as they
    were read (75.0 stays 75.0), because the hash covers every field the sender wrote.
    """
    enriched = F.pandas_udf(_enriched, "string")
    fields = F.struct(F.col(value).cast("string").alias("text"), F.col("_mqtt_topic").alias("topic"), F.col("_mqtt_qos").alias("qos"), F.col("_ingested_at").alias("at"))
    return ingested.where(F.col("reject_reason").isNull()).select(*keep, F.col("device_id").alias("key"), enriched(fields).alias("value"))


def missing_fields(value: Column, required: tuple[str, ...] = C.REQUIRED_BRIDGE) -> Column:
    """Required keys that a raw JSON object lacks (NULL for text that is no object)."""
    wanted = F.array(*[F.lit(f) for f in required])
    return F.array_sort(F.array_except(wanted, F.json_object_keys(value)))


def bridge_check(messages: DataFrame, source_topic: str, clock: Column | None = None,
                 value: str = "value") -> DataFrame:
    """Second ingest form: a key-set check, ISO ingest time and the source topic."""
    clock = F.current_timestamp() if clock is None else clock
    return messages.withColumns({
        "missing": missing_fields(F.col(value).cast("string")),
        "_ingested_at": F.date_format(clock, C.EVENT_TIME_FORMAT),
        "_source_topic": F.lit(source_topic),
    }).withColumn("accepted", F.coalesce(F.size("missing") == 0, F.lit(False)))


def partition_key(value: Column | str, field: str = "device_id") -> Column:
    """Record key: the key field as text when the message has it."""
    return F.get_json_object(value, f"$.{field}")


def ingest_counters(ingested: DataFrame) -> DataFrame:
    rejected = F.col("reject_reason").isNotNull()
    return ingested.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(~rejected).alias("forwarded"),
        F.count_if(rejected).alias("invalid"),
    )


def observe_counters(ingested: DataFrame, name: str = "ingest") -> DataFrame:
    """The same counters as a side channel of a running batch or stream."""
    rejected = F.col("reject_reason").isNotNull()
    return ingested.observe(
        name,
        F.count(F.lit(1)).alias("received"),
        F.count_if(~rejected).alias("forwarded"),
        F.count_if(rejected).alias("invalid"),
    )
