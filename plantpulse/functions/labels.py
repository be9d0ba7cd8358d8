"""Status, grade and score columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plantpulse.constants import ALERT_THRESHOLD_C, NO_DATA, SOURCE_COLD, SOURCE_HOT, WARM_THRESHOLD_C
from plantpulse.functions.temperature import _col, round_half_up

__all__ = [
    "alert_flag", "alert_label", "status_label", "heat_color", "trend_label", "quality_grade",
    "gauge_color", "series_key", "failure_prob", "interpret",
]


def alert_flag(avg: Column | str, threshold: float = ALERT_THRESHOLD_C) -> Column:
    return F.when(_col(avg) > threshold, 1).otherwise(0)


# The label texts below are shown to users as they are.
def alert_label(value: Column | str, threshold: float = ALERT_THRESHOLD_C) -> Column:
    return F.when(_col(value) > threshold, "🔴 ALERTA").otherwise("🟢 OK")


def status_label(value: Column | str, threshold: float = ALERT_THRESHOLD_C) -> Column:
    value = _col(value)
    return F.when(value.isNull(), NO_DATA).when(value > threshold, "ALERT").otherwise("OK")


def heat_color(value: Column | str) -> Column:
    value = _col(value)
    return F.when(value > ALERT_THRESHOLD_C, "red").when(value > WARM_THRESHOLD_C, "orange").otherwise("green")


def trend_label(slope: Column | str) -> Column:
    slope = _col(slope)
    return F.when(slope > 0.1, "🔺 subiendo").when(slope < -0.1, "🔻 bajando").otherwise("➡️  estable")


def quality_grade(reject_pct: Column | str) -> Column:
    pct = _col(reject_pct)
    return F.when(pct < 5, "BUENA").when(pct < 15, "ACEPTABLE").when(pct.isNotNull(), "REVISAR")


def gauge_color(pct: Column | str) -> Column:
    pct = _col(pct)
    return F.when(pct >= 95, "green").when(pct >= 80, "orange").otherwise("red")


def series_key(device: Column | str, source: Column | str) -> Column:
    source = _col(source)
    suffix = F.when(source == SOURCE_HOT, " (hot)").when(source == SOURCE_COLD, " (cold)").otherwise("")
    return F.concat(_col(device), suffix)


def failure_prob(score: Column | str) -> Column:
    """Anomaly score mapped linearly to a probability and clamped to 0..1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (-_col(score) - 0.1) / 0.4))


def interpret(temp: Column | str, is_anomaly: Column | str, score: Column | str,
              mean: Column, p5: Column, p95: Column) -> Column:
    """Readable verdict for one scored temperature against the training profile."""
    temp = _col(temp)

    def one(x: Column, digits: int = 1) -> Column:
        return F.call_function("format_number", x, F.lit("0." + "0" * digits))

    high = F.concat(F.lit("Temperatura excepcionalmente ALTA ("), one(temp), F.lit("°C > p95="), one(p95), F.lit("°C)"))
    low = F.concat(F.lit("Temperatura excepcionalmente BAJA ("), one(temp), F.lit("°C < p5="), one(p5), F.lit("°C)"))
    odd = F.concat(F.lit("Comportamiento anómalo detectado (score="), one(_col(score), 3), F.lit(")"))
    normal = F.concat(F.lit("Temperatura normal ("), one(temp), F.lit("°C, media="), one(mean), F.lit("°C)"))
    return (
        F.when(~_col(is_anomaly), normal).when(temp > p95, high).when(temp < p5, low).otherwise(odd)
    )


def rounded_prob(score: Column | str) -> Column:
    return round_half_up(failure_prob(score), 4)
