"""Totals per key by a tree of runs, and back to the rows, without one task per hot key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF_RUNS = 256
FAN_IN = 16


def leaf_run(leaf_runs: int = LEAF_RUNS) -> Column:
    """The run an input partition belongs to. Any dealing gives the same totals."""
    return F.pmod(F.spark_partition_id(), F.lit(leaf_runs))


def merged_totals(
    rows: DataFrame, run: str, keys: list[str], totals: dict[str, tuple[Column, Callable[[str], Column]]],
    keep: Column | None = None, leaf_runs: int = LEAF_RUNS, fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per (run, keys) of ``rows`` with each key's totals over *all* runs.

    Upward, run p sends its rows, one per key, to run p div ``fan_in`` in each round, until one run is left; a
    key thus meets at most ``fan_in`` rows of the round before in one place, however many copies it has. Downward the
    totals go the same way back. ``totals`` maps a name to (aggregate over rows, aggregate over partial totals).
    ``keep`` drops keys on the way down by a condition on their totals; None keeps all.
    """
    level = rows.groupBy(run, *keys).agg(*[first.alias(n) for n, (first, _) in totals.items()])
    levels, width = [level], leaf_runs
    while width > 1:
        width = -(-width // fan_in)
        level = level.groupBy(F.floor(F.col(run) / fan_in).cast("int").alias(run), *keys).agg(*[again(n).alias(n) for n, (_, again) in totals.items()])
        levels.append(level)
    down = levels.pop()
    if keep is not None:
        down = down.filter(keep)
    while levels:
        child = levels.pop().select(run, *keys, F.floor(F.col(run) / fan_in).cast("int").alias("_parent"))
        down = child.join(down.withColumnRenamed(run, "_parent"), ["_parent", *keys]).drop("_parent")
    return down
