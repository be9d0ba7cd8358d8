"""Running streams: normalization, window analytics, point and lake sinks.

Every stream resumes from its checkpoint; a replayed micro-batch overwrites
its own folder, so the file sinks below hold each row once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plantpulse import constants as C
from plantpulse.operators.routing import route
from plantpulse.operators.windows import window_stats
from plantpulse.sources.metrics import failed_deliveries, machine_stats_lines, reading_lines, write_routed, write_tagged
from plantpulse.sources.topics import parse_topic, with_event_time
from plantpulse.streaming.flush import gathered_points


def _start(df: DataFrame, write: Callable[[DataFrame, str], None], path: str, checkpoint: str, interval: str | None,
           mode: str = "append") -> StreamingQuery:
    """Run ``write(batch, folder)`` per micro-batch, with one folder per batch id."""

    def each(batch: DataFrame, batch_id: int) -> None:
        write(batch, f"{path}/batch={batch_id}")

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each).trigger(**trigger).start()
    )


def normalize_stream(records: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Raw topic to clean and dead-letter folders, each message in exactly one."""
    return _start(route(parse_topic(records)), lambda b, p: write_routed(b, p, "overwrite"), path, checkpoint, interval)


def stats_stream(clean: DataFrame, delay: str = C.WATERMARK_DELAY, window: str = C.WINDOW_LENGTH,
                 threshold: float = C.ALERT_THRESHOLD_C) -> DataFrame:
    """Closed windows of a clean stream, each emitted once after the watermark passes its end."""
    return window_stats(with_event_time(clean, delay=delay), window, threshold)


def analytics_stream(clean: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Window statistics of a clean stream as parquet rows."""
    return _start(stats_stream(clean), lambda b, p: b.write.mode("overwrite").parquet(p), path, checkpoint, interval)


def metric_stream(clean: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Window statistics of a clean stream as line-protocol text."""
    return _start(stats_stream(clean), lambda b, p: machine_stats_lines(b).write.mode("overwrite").text(p), path, checkpoint,
                  interval)


def gathered_stream(clean: DataFrame, path: str, checkpoint: str, size: int = C.POINT_BATCH, seconds: float = C.POINT_SECONDS,
                    shards: int = 8, interval: str = "1 second") -> StreamingQuery:
    """Readings as batches of points that are full or due, as JSON rows; see ``gathered_points``."""
    timed = with_event_time(clean)
    return _start(gathered_points(timed, size, seconds, shards), lambda b, p: b.write.mode("overwrite").json(p), path, checkpoint, interval)


def delivery_stream(clean: DataFrame, send: Callable[[list[str]], None], failed: str, checkpoint: str,
                    interval: str | None = None, batch: int = 5000) -> StreamingQuery:
    """Window statistics sent by ``send`` as line-protocol text; lines it failed on are kept below ``failed`` with the error.

    A failed call is a row there, not a failed job. A replayed micro-batch sends its lines again.
    """
    return _start(stats_stream(clean), lambda b, p: failed_deliveries(machine_stats_lines(b), send, batch).write.mode("overwrite").json(p),
                  failed, checkpoint, interval)


def point_stream(clean: DataFrame, path: str, checkpoint: str, interval: str | None = C.POINT_FLUSH) -> StreamingQuery:
    """Readings as line-protocol text; batch size is set by the source's per-trigger limit."""
    timed = with_event_time(clean)
    return _start(timed, lambda b, p: reading_lines(b).write.mode("overwrite").text(p), path, checkpoint, interval)


def tagged_stream(tagged: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Verified and tampered messages in one folder per tag."""
    return _start(tagged, lambda b, p: write_tagged(b, p, "overwrite"), path, checkpoint, interval)
