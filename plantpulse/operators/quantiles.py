"""Exact linear-interpolated quantiles without gathering a group in one task.

``percentile`` keeps every distinct value of a group in one buffer. Here a
mergeable sketch gives two values around each wanted rank; everything below is
counted exactly, and only the few rows between them are looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The sketch is off by one in so many ranks at most.
ACCURACY = 10_000


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], accuracy: int = ACCURACY) -> DataFrame:
    """One row per group with the columns named in ``probs``; NULL and NaN values are ignored.

    Two passes: sketches, then counts and the rows between the brackets, about ``8 / accuracy`` of a group for each
    probability, whatever its values look like. Only sketches, counts and those rows are exchanged.
    """
    keyed = keys or ["_all"]
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(
        *([F.col(k) for k in keys] or [F.lit(1).alias("_all")]), F.col(value).cast("double").alias("_v"))
    margin = 4.0 / accuracy
    ends = [x for p in probs.values() for x in (max(0.0, p - margin), min(1.0, p + margin))]
    span = rows.groupBy(*keyed).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", ends, accuracy).alias("_cut"))
    met = _beside(rows, span, keys, ["_n", "_cut"])
    v, each = F.col("_v"), range(len(probs))
    lo, hi = [F.col("_cut")[2 * i] for i in each], [F.col("_cut")[2 * i + 1] for i in each]
    counts = met.groupBy(*keyed).agg(
        F.first("_n").alias("_n"), F.array(*[F.count_if(v < lo[i]) for i in each]).alias("_below"),
        # the neighbours of a bracket: interpolation may need the value next to it
        F.array(*[F.max(F.when(v < lo[i], v)) for i in each]).alias("_prev"),
        F.array(*[F.min(F.when(v > hi[i], v)) for i in each]).alias("_next"))
    between = F.array_compact(F.array(*[F.when((v >= lo[i]) & (v <= hi[i]), F.lit(i)) for i in each]))
    inside = met.select(*keyed, "_v", F.explode(between).alias("_i")).groupBy(*keyed, "_i", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(*keyed, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("_before", F.coalesce(F.sum("_c").over(upto), F.lit(0)))
    ranked = _beside(inside, counts, keys, ["_n", "_below", "_prev", "_next"]).withColumn("_start", F.get("_below", F.col("_i")) + F.col("_before"))

    out = []
    for i, (name, p) in enumerate(probs.items()):
        pos = F.lit(float(p)) * (F.col("_n") - 1)

        def at(rank: Column, beside: str, i: int = i) -> Column:
            here = (F.col("_i") == i) & (F.col("_start") <= rank) & (rank < F.col("_start") + F.col("_c"))
            found = F.coalesce(F.max(F.when(here, v)), F.first(F.col(beside)[i]))
            return F.when(found.isNull(), F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")).otherwise(found)

        low, high = at(F.floor(pos), "_prev"), at(F.ceil(pos), "_next")
        out.append((low + (high - low) * F.first(pos - F.floor(pos))).alias(name))
    got = ranked.groupBy(*keyed).agg(*out)
    return got if keys else got.drop("_all")


def _beside(rows: DataFrame, per_group: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows with columns of their group; without keys these are scalars, as a join on a constant gathers everything."""
    if keys:
        return rows.join(per_group, keys)
    whole = per_group.select(F.struct(*columns)).scalar()
    return rows.withColumn("_whole", whole).select("*", *[F.col(f"_whole.{c}").alias(c) for c in columns]).drop("_whole")


def describe_by(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """count, mean, std, min, quartiles, max per group."""
    moments = df.groupBy(*keys).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    return moments.join(exact_quantiles(df, keys, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}), keys, "left")


def box_summary(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles and 1.5 IQR fences per group."""
    boxes = exact_quantiles(df, [by], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return boxes.withColumns({"low_fence": F.col("q1") - 1.5 * iqr, "high_fence": F.col("q3") + 1.5 * iqr})


def box_outliers(df: DataFrame, value: str, by: str) -> DataFrame:
    """Rows with a flag for values beyond the fences of their group."""
    fences = box_summary(df, value, by).select(by, "low_fence", "high_fence")
    beyond = (F.col(value) < F.col("low_fence")) | (F.col(value) > F.col("high_fence"))
    return df.join(fences, by).withColumn("is_outlier", beyond).drop("low_fence", "high_fence")


def histogram(df: DataFrame, value: str, nbins: int, by: str) -> DataFrame:
    """Equal-width counts per group; the bins span the whole table's range."""
    ends = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = ends["lo"], ends["hi"]
    number = F.least(F.floor((F.col(value) - lo) * nbins / F.nullif(hi - lo, F.lit(0.0))), F.lit(nbins - 1))
    return (
        df.where(F.col(value).isNotNull()).withColumn("bin", F.coalesce(number, F.lit(0)).cast("int"))
        .groupBy(by, "bin").agg(F.count(F.lit(1)).alias("n"))
    )


def profile(df: DataFrame, value: str = "avg_temp_c") -> DataFrame:
    """Training-set profile: count, mean, population std, range, 5 % and 95 % points."""
    moments = df.agg(F.count(value).alias("samples"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
                     F.min(value).alias("min"), F.max(value).alias("max"))
    ends = exact_quantiles(df, [], value, {"p5": 0.05, "p95": 0.95})
    return moments.withColumn("_q", ends.select(F.struct("p5", "p95")).scalar()).select(
        "samples", "mean", "std", "min", "max", "_q.p5", "_q.p95")
