"""Line-protocol metric sink and routed file sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.functions import epoch_seconds, escape_tag, fixed_decimals

DECIMAL, INTEGER, FLOAT = "decimal4", "integer", "float"


def _field(name: str, column: str, kind: str) -> Column:
    if kind == DECIMAL:
        text = fixed_decimals(column, 4)
    elif kind == INTEGER:
        text = F.concat(F.col(column).cast("bigint").cast("string"), F.lit("i"))
    else:
        text = F.col(column).cast("string")
    return F.concat(F.lit(f"{name}="), text)


def to_line_protocol(df: DataFrame, measurement: str, tags: list[str], fields: dict[str, tuple[str, str]],
                     time_col: str, keep: list[str] | None = None) -> DataFrame:
    """One text line per row, beside the columns ``keep``. ``fields``: name -> (column, kind). NULL fields are left out."""
    tag_text = F.concat_ws(",", F.lit(measurement), *[F.concat(F.lit(f"{t}="), escape_tag(t)) for t in tags])
    field_text = F.concat_ws(",", *[_field(n, c, kind) for n, (c, kind) in fields.items()])
    return df.select(*(keep or []), F.concat_ws(" ", tag_text, field_text, epoch_seconds(time_col).cast("string")).alias("value"))


def machine_stats_lines(stats: DataFrame) -> DataFrame:
    """The window start, in seconds, is the time of the point."""
    return to_line_protocol(stats, "machine_stats", ["device_id"], {
        "avg_temp_c": ("avg_temp_c", DECIMAL), "max_temp_c": ("max_temp_c", DECIMAL),
        "count": ("count_readings", INTEGER), "alert": ("alert", INTEGER)}, "window_start")


def reading_lines(clean: DataFrame, keep: list[str] | None = None) -> DataFrame:
    unit = clean.withColumn("unit_original", F.coalesce("unit_original", F.lit("C")))
    return to_line_protocol(unit, "sensor_reading", ["device_id", "unit_original"], {
        "temperature_c": ("temperature_c", FLOAT), "ingested_at": ("_ingested_at", INTEGER)}, "event_time", keep)


def post_lines(lines: DataFrame, send: Callable[[list[str]], None], batch: int = 5000) -> None:
    """Deliver lines from the executors, ``batch`` lines per call of ``send``."""

    def deliver(rows: Iterable) -> None:
        pending: list[str] = []
        for row in rows:
            pending.append(row["value"])
            if len(pending) >= batch:
                send(pending)
                pending = []
        if pending:
            send(pending)

    lines.foreachPartition(deliver)


def failed_deliveries(lines: DataFrame, send: Callable[[list[str]], None], batch: int = 5000) -> DataFrame:
    """Deliver lines as ``post_lines`` does, but go on after an error: the rows are the lines of failed calls and why."""

    def deliver(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame["value"].tolist()
            for at in range(0, len(values), batch):
                try:
                    send(values[at : at + batch])
                except Exception as error:  # noqa: BLE001  (whatever the client raises is a failed delivery)
                    yield pd.DataFrame({"value": values[at : at + batch], "error": f"{type(error).__name__}: {error}"})

    return lines.select("value").mapInPandas(deliver, "value STRING, error STRING")


def write_routed(routed: DataFrame, path: str, mode: str = "append") -> None:
    """Both sides of a routed frame in one pass: a folder per side below ``path``."""
    routed.withColumn("route", F.when(F.col("valid"), "clean").otherwise("invalid")).write.mode(mode).partitionBy(
        "route").json(path)


def write_tagged(df: DataFrame, path: str, mode: str = "append") -> None:
    """Rows by their ``tag`` (ok / dlq), one folder each, in one pass."""
    df.write.mode(mode).partitionBy("tag").json(path)
