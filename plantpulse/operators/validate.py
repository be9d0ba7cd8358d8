"""Library validators: reason codes per row, valid / invalid split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.functions import float_text, strip


def _missing(required: tuple[str, ...], keys: Column | None) -> Column:
    """Sorted list of absent fields. In a typed table absent and NULL are the same."""
    if keys is not None:
        absent = F.array_except(F.array(*[F.lit(f) for f in required]), keys)
    else:
        absent = F.array_compact(F.array(*[F.when(F.col(f).isNull(), f) for f in required]))
    return F.array_join(F.array_sort(absent), ",")


def raw_error(keys: Column | None = None) -> Column:
    missing = _missing(C.REQUIRED_RAW, keys)
    code = F.upper(strip("unit"))
    number = F.col("temperature").try_cast("double")
    low, high = (
        F.when(code == "C", C.RAW_LIMITS["C"][i]).when(code == "F", C.RAW_LIMITS["F"][i]).otherwise(C.RAW_LIMITS["K"][i])
        for i in (0, 1)
    )
    return (
        F.when(missing != "", F.concat(F.lit("missing_fields:"), missing))
        .when(strip(F.col("device_id").cast("string")) == "", "empty_device_id")
        .when(strip(F.col("ts").cast("string")) == "", "empty_ts")
        .when(~F.coalesce(code.isin(*C.UNITS), F.lit(False)),
              F.concat(F.lit("invalid_unit:"), F.coalesce(code, F.lit("NONE"))))
        .when(number.isNull(), "temperature_not_numeric")
        .when(F.isnan(number) | (number < low) | (number > high),
              F.concat(F.lit("temperature_out_of_range:"), float_text(number), code))
    )


def clean_error(keys: Column | None = None) -> Column:
    missing = _missing(C.REQUIRED_CLEAN, keys)
    number = F.col("temperature_c").try_cast("double")
    return (
        F.when(missing != "", F.concat(F.lit("missing_fields:"), missing))
        .when(number.isNull(), "temperature_c_not_numeric")
        .when(F.isnan(number) | (number < C.LIBRARY_MIN_C) | (number > C.LIBRARY_MAX_C),
              F.concat(F.lit("temperature_c_out_of_range:"), float_text(number)))
    )


def validate(df: DataFrame, schema: str = "raw", keys: Column | None = None) -> DataFrame:
    """Add ``_validation_error`` (NULL = valid). ``keys``: key list of the raw object, if known."""
    error = raw_error(keys) if schema == "raw" else clean_error(keys)
    return df.withColumn("_validation_error", error)


def filter_valid(df: DataFrame, schema: str = "raw") -> tuple[DataFrame, DataFrame]:
    checked = validate(df, schema)
    failed = F.col("_validation_error").isNotNull()
    return checked.where(~failed).drop("_validation_error"), checked.where(failed)


def validation_summary(checked: DataFrame) -> DataFrame:
    """One row: how many rows pass, and the share in percent."""
    failed = F.col("_validation_error").isNotNull()
    total = F.count(F.lit(1))
    ok = F.count_if(~failed)
    return checked.agg(total.alias("total"), ok.alias("n_ok"), F.count_if(failed).alias("n_invalid"),
                       F.round(F.try_divide(ok * 100.0, total), 6).alias("pct_ok"))


def compare_validation(checked: DataFrame, dlq: DataFrame) -> DataFrame:
    """Local validation next to the dead letters of the stream job, one row per source."""
    failed = F.col("_validation_error").isNotNull()
    local = checked.agg(F.count(F.lit(1)).alias("total"), F.count_if(failed).alias("rechazados"))
    remote = dlq.agg(F.count(F.lit(1)).alias("rechazados"))
    total = local.select("total")
    return local.select(
        F.lit("local").alias("fuente"),
        (F.col("total") - F.col("rechazados")).alias("validos"), "rechazados",
    ).unionByName(remote.select(
        F.lit("dlq").alias("fuente"),
        (total.scalar() - F.col("rechazados")).alias("validos"), "rechazados",
    ))
