"""Unit conversion and rounding columns."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

__all__ = ["unit_code", "to_celsius", "from_celsius", "round_half_up", "round_even", "register_functions"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unit_code(unit: Column | str) -> Column:
    return F.upper(F.trim(_col(unit)))


def to_celsius(t: Column | str, unit: Column | str, strict: str | None = None) -> Column:
    """Celsius value of ``t``; NULL when either input is NULL.

    ``strict=None`` passes an unknown unit through unchanged (stream contract),
    ``"null"`` yields NULL for it and ``"error"`` raises (library contract).
    """
    t, code = _col(t), unit_code(unit)
    converted = F.when(code == "F", (t - 32.0) * 5.0 / 9.0).when(code == "K", t - 273.15)
    if strict is None:
        return converted.when(code.isNotNull(), t)
    converted = converted.when(code == "C", t)
    if strict == "error":
        message = F.concat(F.lit("Unidad desconocida: "), _col(unit))
        return converted.when(code.isNotNull(), F.raise_error(message).cast("double"))
    return converted


def from_celsius(c: Column | str, unit: Column | str) -> Column:
    c, code = _col(c), unit_code(unit)
    return F.when(code == "F", c * 9.0 / 5.0 + 32.0).when(code == "K", c + 273.15).otherwise(c)


def round_half_up(x: Column | str, digits: int) -> Column:
    """Decimal rounding for display.

    The nudge makes a printed tie (x.xx5) go up no matter in which order its
    average was summed, so a result does not depend on the partitioning.
    Numbers without that many digits, NaN and infinities stay as they are.
    """
    x, scale = _col(x), float(10**digits)
    return F.when(F.abs(x) * scale < 1e15, F.floor(x * scale + F.lit(0.5 + 1e-7)).cast("double") / scale).otherwise(x)


def round_even(x: Column | str, digits: int) -> Column:
    """``round(x, digits)`` of the stored binary value: ties go to the even digit, 2.675 is below a tie.

    NaN, infinities and numbers without that many digits stay as they are.
    """
    x = _col(x)
    return F.when(F.abs(x) * float(10**digits) < 1e15, F.replace(F.format_number(x, digits), F.lit(","), F.lit("")).cast("double")).otherwise(x)


def register_functions(spark: SparkSession) -> None:
    """SQL names for the scalar functions. The SQL bodies are inlined by the optimizer."""
    from plantpulse.functions.text import canonical_json_udf

    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION to_celsius(t DOUBLE, unit STRING) RETURNS DOUBLE
           RETURN CASE WHEN t IS NULL OR unit IS NULL THEN NULL
                       WHEN upper(trim(unit)) = 'F' THEN (t - 32.0D) * 5.0D / 9.0D
                       WHEN upper(trim(unit)) = 'K' THEN t - 273.15D
                       ELSE t END"""
    )
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION from_celsius(c DOUBLE, unit STRING) RETURNS DOUBLE
           RETURN CASE WHEN upper(trim(unit)) = 'F' THEN c * 9.0D / 5.0D + 32.0D
                       WHEN upper(trim(unit)) = 'K' THEN c + 273.15D
                       ELSE c END"""
    )
    spark.udf.register("canonical_json", canonical_json_udf())
