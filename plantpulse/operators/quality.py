"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.functions import quality_grade, round_half_up, to_celsius
from plantpulse.operators.fleet import top_n


def reject_reasons(dlq: DataFrame) -> DataFrame:
    return dlq.groupBy(F.coalesce("reason", F.lit("—")).alias("motivo")).agg(F.count(F.lit(1)).alias("n")
                                                                          ).orderBy(F.col("n").desc(), "motivo")


def rejects_by_device(dlq: DataFrame, raw: str | None = None) -> DataFrame:
    """Rejects per device; without a device the whole raw text stands in. Clip it for display only."""
    fallback = F.coalesce(F.col(raw), F.lit("?")) if raw else F.lit("?")
    return dlq.groupBy(F.coalesce(F.col("device_id"), fallback).alias("device_id")).agg(
        F.count(F.lit(1)).alias("rechazados")).orderBy(F.col("rechazados").desc(), "device_id")


def unit_distribution(df: DataFrame, unit: str = "unit") -> DataFrame:
    """Rows and share per unit. The total is summed over the few grouped rows."""
    counts = df.where(F.col(unit).isNotNull()).groupBy(F.col(unit).alias("unit")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", round_half_up(F.col("n") * 100.0 / total, 1))


def mean_by_unit(df: DataFrame) -> DataFrame:
    return df.where(F.col("unit").isNotNull()).groupBy("unit").agg(
        F.avg(to_celsius("temperature", "unit", strict="null")).alias("mean_c"))


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL count and shares per column: one pass, then one row per column."""
    counts = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot(["_total"], columns, "campo", "nulos")
    pct = round_half_up(F.try_divide(F.col("nulos") * 100.0, F.col("_total")), 2)
    return long.select("campo", "nulos", pct.alias("pct_nulos"), round_half_up(100.0 - pct, 2).alias("pct_completo"))


def valid_share(df: DataFrame, columns: list[str]) -> DataFrame:
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    total, valid = F.count(F.lit(1)), F.count_if(complete)
    return df.agg(total.alias("total"), valid.alias("validos"),
                  F.round(F.try_divide(valid * 100.0, total), 6).alias("pct_validos"))


def topic_extents(df: DataFrame, keys: tuple[str, ...] = ("topic", "partition"), offset: str = "offset") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(offset).alias("low"), (F.max(offset) + 1).alias("high"),
        (F.max(offset) + 1 - F.min(offset)).alias("mensajes"), F.count(F.lit(1)).alias("retenidos"))


def topic_sample(df: DataFrame, n: int, offset: str = "offset") -> DataFrame:
    """The first ``n`` messages by offset; undecodable ones among them are skipped."""
    sample = top_n(df, n, F.col(offset).asc())
    return sample.where(F.json_object_keys(F.col("value").cast("string")).isNotNull())


def quality_ratios(raw: DataFrame, clean: DataFrame, invalid: DataFrame, verified: DataFrame) -> DataFrame:
    """Topic totals and their shares of the raw topic."""
    total = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = raw.agg(F.count(F.lit(1)).alias("raw")).withColumns(
        {"clean": total(clean), "invalid": total(invalid), "verified": total(verified)})
    share = lambda c: F.round(F.try_divide(F.col(c) * 100.0, F.col("raw")), 6)
    return counts.withColumns({"pct_clean": share("clean"), "pct_invalid": share("invalid"),
                               "pct_verified": share("verified")}).withColumn("estado", quality_grade("pct_invalid"))


def estimated_integrity(verified: DataFrame, dlq: DataFrame) -> DataFrame:
    """Share of verified messages among verified and rejected ones."""
    counts = verified.agg(F.count(F.lit(1)).alias("verified")).withColumn(
        "dlq", dlq.agg(F.count(F.lit(1)).alias("n")).scalar())
    pct = F.try_divide(F.col("verified") * 100.0, F.col("verified") + F.col("dlq"))
    return counts.withColumn("integrity_pct", F.round(pct, 6))


def executive_summary(stats: DataFrame, raw: DataFrame, clean: DataFrame, invalid: DataFrame,
                      cold: DataFrame) -> DataFrame:
    """One row over all stores, each read once. The parts are scalar subqueries, not a product of tables."""
    total = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    # one row per device carries what the fleet's figures and the hottest device need
    mean = F.avg("avg_temp_c").alias("_mean")
    devices = stats.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("alert") == 1).alias("_a"), F.sum("avg_temp_c").alias("_sum"), F.count("avg_temp_c").alias("_t"), mean)
    # of equally hot devices the first name, as max_by takes the greatest of what it orders by
    hottest = F.min_by("device_id", F.struct(-F.col("_mean"), "device_id"))
    hot = devices.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("ventanas"), F.coalesce(F.sum("_a"), F.lit(0)).alias("ventanas_alerta"),
        F.round(F.try_divide(F.sum("_sum"), F.sum("_t")), 6).alias("temp_media_global"), hottest.alias("maquina_mas_caliente"))
    row = hot.withColumns({
        "raw": total(raw), "clean": total(clean), "invalid": total(invalid),
        # both counts of the cold side come out of one scan
        "_cold": cold.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count("temperature_c").alias("t"))).scalar(),
    }).withColumns({"cold": F.col("_cold.n"), "cold_con_temperatura": F.col("_cold.t")}).drop("_cold")
    pct = lambda a, b: F.round(F.try_divide(F.col(a) * 100.0, F.col(b)), 6)
    return row.withColumns({
        "pct_alerta": pct("ventanas_alerta", "ventanas"), "pct_aceptacion": pct("clean", "raw"),
        "pct_rechazo": pct("invalid", "raw"), "pct_completitud": pct("cold_con_temperatura", "cold"),
    }).withColumn("estado", quality_grade("pct_rechazo"))


def anomaly_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("device_id").agg(
        F.count("score").alias("lecturas"), F.count_if("is_anomaly").alias("anomalias"),
        round_half_up(F.avg("score"), 4).alias("score_medio"), F.round(F.avg("failure_prob"), 6).alias("prob_media"))
