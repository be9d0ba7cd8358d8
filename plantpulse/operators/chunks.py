"""Ordered per-key computations split by time, so one hot key spans many tasks.

A plain window over (key) sorts a whole key in one task. Here the window runs
over (key, slice); what a slice needs from earlier slices (a few rows, a
count, a running sum) comes from a small per-slice table joined back.

A slice is named by two columns in key order: ``_slice``, its start in
microseconds, and ``_part``, which is 0 unless one timestamp had to be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.functions import time_bucket
from plantpulse.session import cut

DAY = 86_400
HOUR = 3_600
SLICE = ["_slice", "_part"]
MAX_ROWS = 250_000


def with_slice(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Slices of fixed length; enough where a key has a bounded number of rows per second."""
    start = time_bucket(ts, seconds) * F.lit(seconds * 1_000_000)
    return df.withColumns({"_slice": start, "_part": F.lit(0).cast("bigint")})


def bounded_slices(df: DataFrame, key: str, ts: str, seq: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """Slices of at most ``max_rows`` rows, whatever the distribution of keys and times.

    A key starts as one slice. Slices over the limit are cut into days, hours,
    minutes, seconds and at last into ranges of the unique ``seq`` at one
    timestamp (copies of one message share key and time). Each level that is
    needed runs one counting job; a table without hot keys needs only the first.
    """
    zero = F.lit(0).cast("bigint")
    sliced = df.withColumns({"_slice": zero, "_part": zero})
    finer = [(time_bucket(ts, n) * F.lit(n * 1_000_000), zero) for n in (DAY, HOUR, 60, 1)]
    finer.append((F.unix_micros(F.col(ts).cast("timestamp")), F.floor(F.col(seq) / F.lit(max_rows)).cast("bigint")))
    for start, part in finer:
        sizes = sliced.groupBy(key, *SLICE).agg(F.count(F.lit(1)).alias("_n"))
        # written first: the join below then knows its size and broadcasts it only if it is small
        heavy = cut(sizes.where(F.col("_n") > max_rows).select(key, "_slice", F.lit(True).alias("_heavy")), "heavy-slices")
        if heavy.isEmpty():
            break
        sliced = sliced.join(heavy, [key, "_slice"], "left").withColumns({
            "_slice": F.when(F.col("_heavy"), start).otherwise(F.col("_slice")),
            "_part": F.when(F.col("_heavy"), part).otherwise(F.col("_part")),
        }).drop("_heavy")
    return sliced


def with_halo(sliced: DataFrame, key: str, order: list[str], rows: int) -> DataFrame:
    """Rows of each slice plus the ``rows`` rows of the key that precede the slice.

    Run any frame of up to ``rows`` preceding rows over ``slice_window``, then
    drop the added rows with ``without_halo``.
    """
    columns = [F.col(c) for c in sliced.columns if c not in SLICE]
    newest = Window.partitionBy(key, *SLICE).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        sliced.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= rows)
        .groupBy(key, *SLICE)
        .agg(F.sort_array(F.collect_list(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                                                  F.struct(*columns).alias("row")))).alias("_tail"))
    )
    # every slice holds at least one row, so ``rows`` earlier slices always suffice
    earlier = Window.partitionBy(key).orderBy(*SLICE).rowsBetween(-rows, -1)
    halo = (
        tails.withColumn("_before", F.flatten(F.collect_list("_tail").over(earlier)))
        .select(*SLICE, F.explode(F.slice(F.reverse("_before"), 1, rows)).alias("_h"))
        .select("_h.row.*", *SLICE, F.lit(True).alias("_halo"))
    )
    return sliced.withColumn("_halo", F.lit(False)).unionByName(halo)


def slice_window(key: str, order: list[str]) -> Window:
    return Window.partitionBy(key, *SLICE).orderBy(*order)


def without_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col("_halo")).drop(*SLICE, "_halo")


def before(key: str) -> Window:
    """All earlier slices of a key, for tables with one row per slice."""
    return Window.partitionBy(key).orderBy(*SLICE).rowsBetween(Window.unboundedPreceding, -1)


def with_running(df: DataFrame, key: str, order: list[str], ts: str, value: Column, name: str,
                 seconds: int = DAY) -> DataFrame:
    """Running sum of ``value`` over the ordered rows of each key (inclusive)."""
    sliced = with_slice(df, ts, seconds).withColumn("_v", value)
    per_slice = sliced.groupBy(key, *SLICE).agg(F.sum("_v").alias("_n"))
    offsets = per_slice.select(key, *SLICE, F.coalesce(F.sum("_n").over(before(key)), F.lit(0)).alias("_before"))
    inside = slice_window(key, order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumn("_inside", F.sum("_v").over(inside))
        .join(offsets, [key, *SLICE])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop(*SLICE, "_v", "_inside", "_before")
    )


def ordinal(df: DataFrame, key: str, order: list[str], ts: str, name: str = "idx", seconds: int = DAY) -> DataFrame:
    """Position 0..n-1 of each row within its key."""
    counted = with_running(df, key, order, ts, F.lit(1).cast("bigint"), name, seconds)
    return counted.withColumn(name, F.col(name) - 1)
