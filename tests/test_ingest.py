import json
import math

import pytest
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.operators import ingest, quality, routing, validate
from plantpulse.sources import topics

BASE = {"device_id": "m1", "temperature": 75.0, "unit": "C", "ts": "2026-03-11T00:00:00Z"}


def changed(**kw):
    return json.dumps({k: v for k, v in {**BASE, **kw}.items() if v != "drop"}, ensure_ascii=False)


@pytest.mark.parametrize("text, reason", [
    (changed(), None),
    (changed(temperature="75.0"), None),
    (changed(temperature=" 75 "), None),
    (changed(unit="f"), None),
    (changed(temperature="hot"), "temperature no es numérico: 'hot'"),
    (changed(temperature=None), "campo 'temperature' ausente"),
    (changed(temperature="drop"), "campo 'temperature' ausente"),
    (changed(unit=" f "), "unidad no reconocida: ' f ' (esperado C, F o K)"),
    (changed(unit="RANKINE"), "unidad no reconocida: 'RANKINE' (esperado C, F o K)"),
    (changed(unit=None), "unidad no reconocida: None (esperado C, F o K)"),
    (changed(unit="drop"), "unidad no reconocida: '' (esperado C, F o K)"),
    (changed(device_id=""), C.REASON_DEVICE),
    (changed(device_id=" \t"), C.REASON_DEVICE),
    (changed(device_id=5), C.REASON_DEVICE),
    (changed(device_id="drop"), C.REASON_DEVICE),
    (changed(ts=""), "campo 'ts' ausente"),
    (changed(ts="drop"), "campo 'ts' ausente"),
    ("{device_id: bad, INVALID", C.INGEST_BAD_JSON),
    ("[1, 2]", C.INGEST_NOT_OBJECT),
    ('"str"', C.INGEST_NOT_OBJECT),
])
def test_ingest_reason(rows, text, reason):
    df = rows([(bytearray(text.encode()),)], "value BINARY")
    assert ingest.ingest(df, "t", 1, F.lit(7)).first().reject_reason == reason


def test_ingest_rejects_bad_utf8_and_counts(rows):
    df = rows([(bytearray(b"\xffA"),), (bytearray(changed(unit="k").encode()),)], "value BINARY")
    done = ingest.ingest(df, "sensors/x", 2, F.lit(7))
    got = {r.reject_reason: r for r in done.collect()}
    assert set(got) == {C.INGEST_NOT_UTF8, None}
    ok = got[None]
    assert (ok.unit, ok._mqtt_topic, ok._mqtt_qos, ok._ingested_at) == ("K", "sensors/x", 2, 7)
    assert ingest.ingest_counters(done).first().asDict() == {"received": 2, "forwarded": 1, "invalid": 1}


def test_forwarded_keeps_signed_text(rows):
    text = '{"temperature": 75.0, "extra": {"a": [1]}, "device_id": "m1", "unit": "f", "ts": "x"} '
    done = ingest.ingest(rows([(text,)], "value STRING"), "t", 1, F.lit(9))
    record = ingest.forwarded(done).first()
    assert record.key == "m1"
    assert json.loads(record.value) == {"temperature": 75.0, "extra": {"a": [1]}, "device_id": "m1", "unit": "F", "ts": "x",
                                        "_mqtt_topic": "t", "_mqtt_qos": 1, "_ingested_at": 9}
    assert '"temperature": 75.0' in record.value


def test_forwarded_changes_only_its_own_unit(rows):
    text = '{"device_id":"m","meta":{"unit":"c"},"temperature":70,"unit":"k","unit":"f","ts":"x","big":12345678901234567890}'
    done = ingest.ingest(rows([(text, 5)], "value STRING, n INT"), "t", 1, F.lit(9))
    record = ingest.forwarded(done, keep=("n",)).first()
    assert record.n == 5 and json.loads(record.value) == {
        "device_id": "m", "meta": {"unit": "c"}, "temperature": 70, "unit": "F", "ts": "x", "big": 12345678901234567890,
        "_mqtt_topic": "t", "_mqtt_qos": 1, "_ingested_at": 9}


def test_bridge_check(rows):
    df = rows([(json.dumps(BASE),), ('{"unit": 1}',), ("[1]",)], "value STRING")
    got = ingest.bridge_check(df, "t").collect()
    assert [r.missing for r in got] == [[], ["device_id", "temperature", "ts"], None]
    assert [r.accepted for r in got] == [True, False, False]


RAW = "device_id STRING, temperature STRING, unit STRING, ts STRING, hash STRING, prev_hash STRING"


@pytest.mark.parametrize("change, error", [
    ({}, None), ({"unit": "X"}, "invalid_unit:X"), ({"hash": None, "device_id": None}, "missing_fields:device_id,hash"),
    ({"device_id": " "}, "empty_device_id"), ({"ts": ""}, "empty_ts"), ({"temperature": "hot"}, "temperature_not_numeric"),
    ({"temperature": "99999"}, "temperature_out_of_range:99999.0C"), ({"temperature": "-50"}, None), ({"temperature": "200"}, None),
    ({"temperature": "-50.1"}, "temperature_out_of_range:-50.1C"), ({"temperature": "100", "unit": "k"}, "temperature_out_of_range:100.0K"),
    ({"temperature": "nan"}, "temperature_out_of_range:nanC"), ({"temperature": "392", "unit": " F "}, None),
])
def test_validate_raw(rows, change, error):
    good = {"device_id": "m1", "temperature": "75", "unit": "C", "ts": "x", "hash": "h", "prev_hash": "p"}
    df = rows([tuple({**good, **change}.values())], RAW)
    assert validate.validate(df).first()._validation_error == error
    valid, invalid = validate.filter_valid(df)
    assert (valid.count(), invalid.count()) == ((1, 0) if error is None else (0, 1))


def test_validate_by_keys_lets_null_pass(rows):
    df = rows([(None, "75", "C", "x", "h", "p")], RAW).withColumn("keys", F.array(*[F.lit(c) for c in C.REQUIRED_RAW]))
    assert validate.validate(df, keys=F.col("keys")).first()._validation_error is None


@pytest.mark.parametrize("t, error", [(250.0, "temperature_c_out_of_range:250.0"), (200.0, None), (None, "missing_fields:temperature_c"),
                                      (float("nan"), "temperature_c_out_of_range:nan")])
def test_validate_clean(rows, t, error):
    df = rows([("m", t, "x")], "device_id STRING, temperature_c DOUBLE, ts STRING")
    assert validate.validate(df, "clean").first()._validation_error == error


ROUTE = "device_id STRING, temperature DOUBLE, unit STRING, ts STRING, _ingested_at BIGINT"


@pytest.mark.parametrize("device, t, unit, reason", [
    ("m", 75.0, "C", None), (" ", 75.0, "C", None), ("m", 1000.0, "C", None), ("m", -50.0, "c", None), ("m", 212.0, " f ", None),
    (None, 75.0, "C", C.REASON_DEVICE), ("", 75.0, "C", C.REASON_DEVICE), ("m", None, "C", C.REASON_TEMPERATURE),
    ("m", math.nan, "C", C.REASON_TEMPERATURE), ("m", 75.0, None, "unidad no reconocida: null"),
    ("m", 75.0, "RANKINE", "unidad no reconocida: RANKINE"), ("m", 99999.0, "C", "temperatura sobre máximo: 99999.00C"),
    ("m", -500.0, "C", "temperatura bajo mínimo: -500.00C"), ("m", 1e12, "C", "temperatura sobre máximo: 1.0E12C"),
    (None, None, None, C.REASON_DEVICE),
])
def test_route(rows, device, t, unit, reason):
    routed = routing.route(rows([(device, t, unit, "2026-03-11T00:00:00Z", 1)], ROUTE))
    assert (routed.first().valid, routed.first().reason) == (reason is None, reason)
    clean, invalid = routing.split(routed)
    assert clean.count() + invalid.count() == 1


def test_normalize_library(rows):
    data = [("m", "176", "F", "x"), ("m", "353.15", "K", "x"), ("m", "201", "C", "x"), ("m", "-51", "C", "x"), (None, "1", "C", "x"),
            ("m", "hot", "C", "x"), ("m", "1", "X", "x"), ("m", None, "C", "x")]
    clean, invalid = routing.normalize_library(rows(data, "device_id STRING, temperature STRING, unit STRING, ts STRING"))
    assert [(r.temperature_c, r._ingested_at) for r in clean.collect()] == [(80.0, ""), (80.0, "")]
    assert {r.reason for r in invalid.collect()} == {"normalization_failed"} and invalid.count() == 6


def test_parse_topic_tolerates_anything(rows):
    texts = [changed(temperature="75.0"), changed(temperature=None, _ingested_at="2026-01-01"), "{bad", "[1]", '"s"', changed(temperature=1e3)]
    got = topics.parse_topic(rows([(t,) for t in texts], "value STRING")).collect()
    assert [r.temperature for r in got] == [75.0, None, None, None, None, 1000.0]
    assert [r.device_id for r in got] == ["m1", "m1", None, None, None, "m1"]
    assert [r._corrupt for r in got] == [None, None, "{bad", "[1]", '"s"', None]
    assert got[1]._ingested_at is None


def test_routed_and_tagged_records_name_their_topic(rows):
    routed = rows([("m1", 1.5, True, None), (None, None, False, "r")], "device_id STRING, t DOUBLE, valid BOOLEAN, reason STRING")
    got = [tuple(r) for r in topics.routed_records(routed, ["device_id", "t"], ["t", "reason"]).collect()]
    assert got == [("sensors_clean", "m1", '{"device_id":"m1","t":1.5}'), ("sensors_invalid", "unknown", '{"reason":"r"}')]
    tagged = rows([("m1", "ok", "{}"), ("m2", "dlq", "x")], "key STRING, tag STRING, payload STRING")
    assert [tuple(r) for r in topics.tagged_records(tagged).collect()] == [("sensors_verified", "m1", "{}"), ("sensors_invalid", "m2", "x")]


def test_topic_sample_skips_undecodable(rows):
    df = rows([(i, "{bad" if i == 1 else '{"a":1}') for i in range(10)], "offset BIGINT, value STRING")
    assert sorted(r.offset for r in quality.topic_sample(df, 3).collect()) == [0, 2]


def test_quality_ratios_of_empty_tables(rows):
    empty = rows([], "a INT")
    row = quality.quality_ratios(empty, empty, empty, empty).first()
    assert (row.raw, row.pct_clean, row.estado) == (0, None, None)


def test_kafka_records(rows):
    df = rows([("m1", 75.5)], "device_id STRING, temperature_c DOUBLE")
    assert topics.to_topic_records(df).first() == ("m1", '{"device_id":"m1","temperature_c":75.5}')
    assert topics.kafka_options("h:1", "t", max_offsets=5)["maxOffsetsPerTrigger"] == "5"
