"""Message topics: Kafka in production, text or JSON files with the same columns offline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantpulse import constants as C
from plantpulse.functions import parse_ts
from plantpulse.schemas import CLEAN_MESSAGE, RAW_MESSAGE


def kafka_options(servers: str, topic: str, starting: str = "earliest", max_offsets: int | None = 1_000_000) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_topic(spark: SparkSession, source: str | dict[str, str], streaming: bool = False,
               max_files: int | None = 100) -> DataFrame:
    """Raw records. ``source`` is a folder of text files or a dict of Kafka options.

    The per-trigger limits bound a micro-batch, also the first one over a long backlog.
    """
    reader = spark.readStream if streaming else spark.read
    if isinstance(source, dict):
        return reader.format("kafka").options(**source).load()
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.schema("value STRING").text(source)


def parse_topic(records: DataFrame, schema: T.StructType = RAW_MESSAGE) -> DataFrame:
    """Declared columns of the message text; a missing or badly typed field is NULL.

    Text that is no JSON object gives NULL in every field and is kept in ``_corrupt``.
    """
    text = F.col("value").cast("string")
    extra = [c for c in records.columns if c != "value"]
    # numbers are parsed as text first, so a numeric string is as good as a number
    loose = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parsed = records.select(*extra, text.alias("_raw"), F.from_json(text, loose).alias("m"))
    types = {f.name: f.dataType for f in schema.fields}

    def typed(name: str) -> Column:
        kind = types[name] if name != "temperature" else T.DoubleType()
        kind = T.LongType() if name == "_ingested_at" else kind
        column = F.col(f"m.{name}")
        return (column if kind == T.StringType() else column.try_cast(kind)).alias(name)

    keys = F.json_object_keys("_raw")
    return parsed.select(*extra, *[typed(n) for n in types], F.when(keys.isNull(), F.col("_raw")).alias("_corrupt"))


def clean_topic(records: DataFrame) -> DataFrame:
    return parse_topic(records, CLEAN_MESSAGE)


def with_event_time(df: DataFrame, ts_col: str = "ts", delay: str = C.WATERMARK_DELAY) -> DataFrame:
    """Event time column with a bounded-lateness watermark."""
    return df.withColumn("event_time", parse_ts(ts_col)).withWatermark("event_time", delay)


def to_topic_records(df: DataFrame, key: str = "device_id") -> DataFrame:
    """Key and JSON value columns of a keyed topic."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def routed_records(routed: DataFrame, clean: list[str], invalid: list[str]) -> DataFrame:
    """Both sides of a routed frame as records of their topics: topic, key, value; each message in exactly one."""
    value = F.when(F.col("valid"), F.to_json(F.struct(*clean))).otherwise(F.to_json(F.struct(*invalid)))
    topic = F.when(F.col("valid"), C.TOPIC_CLEAN).otherwise(C.TOPIC_INVALID)
    return routed.select(topic.alias("topic"), F.coalesce("device_id", F.lit(C.UNKNOWN_DEVICE)).alias("key"), value.alias("value"))


def tagged_records(tagged: DataFrame) -> DataFrame:
    """Verified messages and dead letters of the chain verifier as records of their topics."""
    topic = F.when(F.col("tag") == "ok", C.TOPIC_VERIFIED).otherwise(C.TOPIC_INVALID)
    return tagged.select(topic.alias("topic"), "key", F.col("payload").alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str | None = None, checkpoint: str | None = None):
    """Write records to Kafka: a streaming query when ``df`` streams, else a batch write.

    Without ``topic`` each record goes to the topic it names, so one job feeds several topics.
    """
    options = {"kafka.bootstrap.servers": servers} | ({"topic": topic} if topic else {})
    if df.isStreaming:
        return df.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
    return df.write.format("kafka").options(**options).save()
