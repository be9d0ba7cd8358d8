import hashlib
import json
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from plantpulse import functions as fn
from plantpulse.constants import GENESIS_HASH
from plantpulse.sources import metrics


@pytest.mark.parametrize("value, unit, expected", [
    (212.0, "F", 100.0), (32.0, "F", 0.0), (98.6, "F", 37.0), (373.15, "K", 100.0), (273.15, "K", 0.0),
    (176.0, "F", 80.0), (353.15, "K", 80.0), (75.0, "C", 75.0), (32.0, "f", 0.0), (32.0, " f ", 0.0),
])
def test_to_celsius(rows, value, unit, expected):
    got = rows([(value, unit)], "t DOUBLE, u STRING").select(fn.to_celsius("t", "u"), fn.to_celsius("t", "u", "null")).first()
    assert got[0] == pytest.approx(expected) and got[1] == pytest.approx(expected)


def test_unknown_unit_modes(rows):
    df = rows([(10.0, "R"), (10.0, None), (None, "C")], "t DOUBLE, u STRING")
    assert [r[0] for r in df.select(fn.to_celsius("t", "u")).collect()] == [10.0, None, None]
    assert [r[0] for r in df.select(fn.to_celsius("t", "u", "null")).collect()] == [None, None, None]
    with pytest.raises(PySparkException, match="Unidad desconocida"):
        df.where("u = 'R'").select(fn.to_celsius("t", "u", "error")).collect()


def test_round_trip_units(rows):
    df = rows([(t, u) for t in (-40.0, 0.0, 99.5) for u in "CFK"], "t DOUBLE, u STRING")
    back = df.select("t", fn.to_celsius(fn.from_celsius("t", "u"), "u").alias("b")).collect()
    assert all(r.b == pytest.approx(r.t) for r in back)


def test_sql_functions_are_inlined(spark, rows):
    fn.register_functions(spark)
    df = rows([(212.0, "F")], "t DOUBLE, u STRING").selectExpr("to_celsius(t, u) AS c", "from_celsius(t, 'K') AS k")
    assert df.first() == (100.0, pytest.approx(485.15))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan and "to_celsius" not in plan
    assert spark.sql("""SELECT canonical_json('{"b":1,"a":75.0,"hash":"x"}')""").first()[0] == '{"a": 75.0, "b": 1}'


@pytest.mark.parametrize("x", [0.0, 1.0, -500.0, 99999.0, 75.25, 1e7, 12345678.9, 1e15, 1e16, 1.5e20, -2e17, 0.001, 0.0005, 1e-5,
                               1.5e-7, math.inf, -math.inf, math.nan])
def test_float_text_matches_repr(rows, x):
    assert rows([(x,)], "x DOUBLE").select(fn.float_text("x")).first()[0] == repr(x)


@pytest.mark.parametrize("text", ["hot", "it's", 'a"b', "a'b\"c", "back\\slash", "tab\there", ""])
def test_quoted_matches_repr(rows, text):
    assert rows([(text,)], "s STRING").select(fn.quoted("s")).first()[0] == repr(text)


@pytest.mark.parametrize("text", ["  a ", "\t\n", "\u00a0x\u2003", "a b", ""])
def test_strip(rows, text):
    assert rows([(text,)], "s STRING").select(fn.strip("s")).first()[0] == text.strip()


def test_event_time(rows):
    df = rows([("2026-03-11T10:00:00Z",), ("2026-03-11T10:00:00.5Z",), ("bad",), (None,)], "ts STRING")
    got = [r[0] for r in df.select(F.date_format(fn.parse_ts("ts"), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2026-03-11 10:00:00", None, None, None]


def test_partition_label_and_path(rows):
    df = rows([(2026, 3, 1, 5)], "year INT, month INT, day INT, hour INT")
    assert df.select(fn.partition_label()).first()[0] == "2026-03-01 05h"
    path = rows([("s3a://b/clean/year=2026/month=03/day=01/hour=05/x.json",)], "p STRING")
    got = path.select(*[c.alias(n) for n, c in fn.partitions_of_path("p").items()]).first()
    assert got.asDict() == {"year": "2026", "month": "03", "day": "01", "hour": "05"}


@pytest.mark.parametrize("message", [
    {"device_id": "m1", "temperature": 75, "unit": "C"}, {"unit": "F", "temperature": 75.0, "device_id": "m1", "ñ": "é"},
    {"b": {"z": 1, "a": [1, 2.50]}, "a": None, "_mqtt_qos": 1, "hash": "h", "prev_hash": "p", "_ingested_at": 5},
])
def test_canonical_json_and_hash(rows, message):
    kept = {k: v for k, v in message.items() if k not in ("hash", "prev_hash", "_ingested_at", "_mqtt_topic", "_mqtt_qos")}
    text = json.dumps(kept, sort_keys=True)
    df = rows([(json.dumps(message, ensure_ascii=False),)], "raw STRING").select(fn.canonical_json("raw").alias("c"))
    assert df.first().c == text
    expected = hashlib.sha256((text + GENESIS_HASH).encode()).hexdigest()
    assert df.select(fn.message_hash("c", F.lit(GENESIS_HASH))).first()[0] == expected


def test_canonical_json_of_other_text(rows):
    df = rows([("[1]",), ("{bad",), (None,)], "raw STRING").select(fn.canonical_json("raw"))
    assert [r[0] for r in df.collect()] == [None, None, None]


def test_verify_message(rows):
    text, prev = '{"a": 1}', "0" * 64
    good = hashlib.sha256((text + prev).encode()).hexdigest()
    df = rows([(text, prev, good, prev), (text, "f" * 64, good, prev), (text, prev, "e" * 64, prev), (text, None, good, prev)],
              "c STRING, p STRING, h STRING, e STRING")
    got = [r[0] for r in df.select(fn.verify_message("c", "p", "h", "e")).collect()]
    assert [g.ok for g in got] == [True, False, False, False]
    assert got[1].reason == f"prev_hash_mismatch: declared={'f' * 16}… expected={'0' * 16}…"
    assert got[2].reason == f"hash_mismatch: declared={'e' * 16}… computed={good[:16]}…"
    assert got[3].reason == f"prev_hash_mismatch: declared=… expected={'0' * 16}…"


def test_line_protocol_escapes_and_rounds(rows):
    df = rows([("m 1,a=b", 1234.56785, 2, 1, 60)], "device_id STRING, avg_temp_c DOUBLE, count_readings BIGINT, alert INT, s BIGINT")
    df = df.withColumn("max_temp_c", F.col("avg_temp_c")).withColumn("window_start", F.timestamp_seconds("s"))
    expected = f"machine_stats,device_id=m\\ 1\\,a\\=b avg_temp_c={1234.56785:.4f},max_temp_c={1234.56785:.4f},count=2i,alert=1i 60"
    assert metrics.machine_stats_lines(df).first().value == expected


def test_score_labels(rows):
    df = rows([(-0.5, 95.0, True), (-0.1, 70.0, False), (-0.9, 10.0, True), (-0.5, 60.0, True)], "s DOUBLE, t DOUBLE, a BOOLEAN")
    profile = [F.lit(v) for v in (70.0, 50.0, 90.0)]
    got = df.select(fn.failure_prob("s").alias("p"), fn.interpret("t", "a", "s", *profile).alias("i")).collect()
    assert [r.p for r in got] == [1.0, 0.0, 1.0, 1.0]
    assert [r.i for r in got] == [
        "Temperatura excepcionalmente ALTA (95.0°C > p95=90.0°C)", "Temperatura normal (70.0°C, media=70.0°C)",
        "Temperatura excepcionalmente BAJA (10.0°C < p5=50.0°C)", "Comportamiento anómalo detectado (score=-0.500)"]


def test_round_even_is_the_rounding_of_the_stored_value(rows):
    values = [0.125, 0.375, 2.675, 1.115, 1.005, -0.125, 0.0, 1e18, -1e18, 123456.789, 1e-9, 99.995, 70.0]
    got = rows([(v,) for v in values], "x DOUBLE").select("x", fn.round_even("x", 2).alias("r")).collect()
    assert [r.r for r in got] == [round(v, 2) for v in values]
    odd = rows([(float("nan"),), (float("inf"),), (None,)], "x DOUBLE").select(fn.round_even("x", 2).alias("a"), fn.round_half_up("x", 2).alias("b")).collect()
    assert math.isnan(odd[0].a) and math.isnan(odd[0].b) and odd[1].a == odd[1].b == math.inf and odd[2].a is odd[2].b is None
    assert rows([(1e18,)], "x DOUBLE").select(fn.round_half_up("x", 4).alias("r")).first().r == 1e18
