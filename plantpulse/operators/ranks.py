"""Positions of rows in an order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.session import cut


def ranked(df: DataFrame, order: list[str], groups: list[str] | None = None, name: str = "rank") -> DataFrame:
    """``df`` with ``name``, its place from 0 by ``order``, within ``groups`` where they are given.

    Rows are dealt out by ranges of the order and numbered within their range. A table with one row per range (and
    group) tells how many rows lie in earlier ranges. Rows alike in groups and order spread over ranges too; which of
    them comes first is open.
    """
    groups = groups or []
    keys = [*groups, *order, "_tie"]
    placed = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = cut(placed.withColumns({"_range": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}), "ranked")
    parts = placed.groupBy("_range", *groups).agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*[F.col(g) for g in groups] or [F.lit(0)]).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")
    parts = parts.select("_range", shift.alias("_shift"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)])
    same = F.col("_range") == F.col("_own_range")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = placed.withColumnRenamed("_range", "_own_range").join(parts, same)
    return joined.withColumn(name, F.col("_i") + F.col("_shift")).select(*df.columns, name)
