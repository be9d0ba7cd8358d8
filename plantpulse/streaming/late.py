"""Late rows of a stream as rows of their own, instead of a silent drop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plantpulse.streaming.ledger import batch_folders

ON_TIME, LATE, UNTIMED = "on_time", "late", "untimed"
COUNTS = "offered BIGINT, late BIGINT, untimed BIGINT, watermark BIGINT"


def side_of(event_time: str, watermark: int | None, window_seconds: int) -> Column:
    """The side of a row: late when its window ended at or before the watermark (microseconds), so no later row opens it again."""
    micros = F.unix_micros(F.col(event_time).cast("timestamp"))
    length = window_seconds * 1_000_000
    end = (F.floor(micros / F.lit(length)) + 1) * F.lit(length)
    late = F.lit(False) if watermark is None else end <= F.lit(watermark)
    return F.when(micros.isNull(), UNTIMED).when(late, LATE).otherwise(ON_TIME)


def route_late(rows: DataFrame, path: str, checkpoint: str, event_time: str = "event_time", delay_seconds: int = 10,
               window_seconds: int = 60, interval: str | None = None) -> StreamingQuery:
    """Write each row of a stream to one side below ``path``: on time, late, or without an event time.

    A micro-batch is judged by the watermark that the batches before it left, the newest event time less ``delay_seconds``.
    Spark's own drop is one batch behind that, so windows over the on-time side (``on_time_stream``) drop nothing more, and
    what is late plus what is counted is all that was offered. Rows are counted while they are written (``observe``), and the counts with the new watermark are kept per batch, see ``late_counts``. A
    replayed batch starts from the watermark of the one before it and overwrites its own folders.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id - 1 in batch_folders(spark, f"{path}/counts"):
            before = spark.read.schema(COUNTS).json(f"{path}/counts/batch={batch_id - 1}").first()["watermark"]
        side = side_of(event_time, before, window_seconds)
        seen = Observation()
        routed = batch.withColumn("side", side).observe(
            seen, F.count(F.lit(1)).alias("offered"), F.count_if(F.col("side") == LATE).alias("late"),
            F.count_if(F.col("side") == UNTIMED).alias("untimed"), F.unix_micros(F.max(F.col(event_time).cast("timestamp"))).alias("newest"))
        routed.write.mode("overwrite").partitionBy("side").parquet(f"{path}/rows/batch={batch_id}")
        got = seen.get
        marks = [m for m in (before, None if got["newest"] is None else got["newest"] - delay_seconds * 1_000_000) if m is not None]
        counts = spark.createDataFrame([(got["offered"], got["late"], got["untimed"], max(marks, default=None))], COUNTS)
        counts.coalesce(1).write.mode("overwrite").json(f"{path}/counts/batch={batch_id}")

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each).trigger(**trigger).start()


def routed_rows(spark: SparkSession, path: str, side: str) -> DataFrame:
    """The rows of one side, of all batches."""
    return spark.read.parquet(f"{path}/rows").where(F.col("side") == side).drop("side", "batch")


def on_time_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """The rows on time as a stream, in the order of the batches that wrote them."""
    schema = routed_rows(spark, path, ON_TIME).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files)).parquet(f"{path}/rows/batch=*/side={ON_TIME}")


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """Per batch: rows offered, late, without time, and on time."""
    rows = spark.read.schema(COUNTS + ", batch BIGINT").json(f"{path}/counts")
    return rows.select("batch", "offered", "late", "untimed", (F.col("offered") - F.col("late") - F.col("untimed")).alias("on_time"))
