"""Event time, lake partition and age columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plantpulse.constants import EVENT_TIME_FORMAT
from plantpulse.functions.temperature import _col

__all__ = [
    "parse_ts", "epoch_seconds", "partition_columns", "partition_label", "partitions_of_path",
    "age_seconds", "time_bucket", "processing_time",
]


def parse_ts(ts: Column | str) -> Column:
    """Event time of the literal-Z text form; NULL for anything else."""
    return F.try_to_timestamp(_col(ts), F.lit(EVENT_TIME_FORMAT))


def epoch_seconds(ts: Column | str) -> Column:
    return F.unix_seconds(_col(ts).cast("timestamp"))


def processing_time() -> Column:
    return F.current_timestamp()


def partition_columns(ts: Column | str) -> dict[str, Column]:
    """Zero-padded lake partition strings of an event time."""
    ts = _col(ts)
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


def partition_label() -> Column:
    """``2026-03-11 05h`` from the four partition columns."""
    pad = [F.lpad(F.col(c).cast("string"), 2, "0") for c in ("month", "day", "hour")]
    return F.concat(
        F.col("year").cast("string"), F.lit("-"), pad[0], F.lit("-"), pad[1], F.lit(" "), pad[2], F.lit("h")
    )


def partitions_of_path(path: Column | str) -> dict[str, Column]:
    """Partition values written in a hive-style path; empty text where absent."""
    return {p: F.regexp_extract(_col(path), rf"{p}=(\w+)", 1) for p in ("year", "month", "day", "hour")}


def age_seconds(ts: Column | str, anchor: Column) -> Column:
    return epoch_seconds(anchor) - epoch_seconds(ts)


def time_bucket(ts: Column | str, seconds: int) -> Column:
    """Number of the fixed-length time slice that holds ``ts``."""
    return F.floor(epoch_seconds(ts) / F.lit(seconds)).cast("bigint")
