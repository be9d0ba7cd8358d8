import json
import os

import pytest
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.operators import ingest
from plantpulse.sources import lake, metrics, topics
from plantpulse.streaming import pipelines, verifier
from tests.test_chain import signed

BASE = 1773187200


def stage(folder, name, lines, order):
    """One input file per micro-batch; file times fix the order."""
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(lines) + "\n", encoding="utf8")
    os.utime(path, (BASE + order, BASE + order))


def reading(offset, value, device="m1"):
    minutes, seconds = divmod(offset, 60)
    return json.dumps({"device_id": device, "temperature_c": value, "unit_original": "C",
                       "ts": f"2026-03-11T00:{minutes:02d}:{seconds:02d}Z", "_ingested_at": 1})


def clean_stream(spark, folder):
    return topics.clean_topic(topics.read_topic(spark, str(folder), streaming=True, max_files=1))


def windows_of(spark, path):
    rows = spark.read.parquet(path).collect()
    return {int(r.window_start.timestamp() - BASE) // 60: (round(r.avg_temp_c, 2), r.count_readings, r.alert) for r in rows}


def test_windows_are_emitted_once_closed(spark, tmp_path):
    src = tmp_path / "in"
    stage(src, "a.json", [reading(0, 1.0), reading(30, 3.0), reading(65, 5.0)], 1)
    stage(src, "b.json", [reading(50, 9.0), reading(75, 7.0)], 2)
    stage(src, "c.json", [reading(20, 100.0), reading(140, 2.0)], 3)
    pipelines.analytics_stream(clean_stream(spark, src), str(tmp_path / "o"), str(tmp_path / "k")).awaitTermination()
    # the late row of file c is judged by the watermark of the batch before it; the last window stays open
    assert windows_of(spark, str(tmp_path / "o")) == {0: (28.25, 4, 0), 1: (6.0, 2, 0)}


def test_late_rows_are_dropped_and_restart_continues(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "o"), str(tmp_path / "k")
    stage(src, "a.json", [reading(0, 90.0), reading(200, 10.0)], 1)
    stage(src, "b.json", [reading(210, 20.0)], 2)
    pipelines.analytics_stream(clean_stream(spark, src), out, ck).awaitTermination()
    assert windows_of(spark, out) == {0: (90.0, 1, 1)}
    stage(src, "c.json", [reading(10, 1.0), reading(400, 1.0)], 3)
    stage(src, "d.json", [reading(410, 1.0)], 4)
    pipelines.analytics_stream(clean_stream(spark, src), out, ck).awaitTermination()
    assert windows_of(spark, out) == {0: (90.0, 1, 1), 3: (15.0, 2, 0)}


def test_bad_event_time_stays_out_of_windows(spark, tmp_path):
    src = tmp_path / "in"
    bad = json.dumps({"device_id": "m1", "temperature_c": 5.0, "ts": "2026-03-11T00:00:01.5Z"})
    stage(src, "a.json", [reading(0, 1.0), bad, reading(500, 1.0)], 1)
    stage(src, "b.json", [reading(501, 1.0)], 2)
    pipelines.analytics_stream(clean_stream(spark, src), str(tmp_path / "o"), str(tmp_path / "k")).awaitTermination()
    assert windows_of(spark, str(tmp_path / "o")) == {0: (1.0, 1, 0)}


def test_metric_lines_stream(spark, tmp_path):
    src = tmp_path / "in"
    stage(src, "a.json", [reading(0, 90.0), reading(200, 10.0)], 1)
    stage(src, "b.json", [reading(210, 10.0)], 2)
    pipelines.metric_stream(clean_stream(spark, src), str(tmp_path / "o"), str(tmp_path / "k")).awaitTermination()
    assert [r.value for r in spark.read.text(str(tmp_path / "o")).collect()] == [
        f"machine_stats,device_id=m1 avg_temp_c=90.0000,max_temp_c=90.0000,count=1i,alert=1i {BASE}"]


def test_failed_deliveries_are_kept(spark, tmp_path):
    lines = spark.createDataFrame([(f"m,d=a v={i} {i}",) for i in range(20)], "value STRING").coalesce(1)
    sent = str(tmp_path / "sent")

    def send(values):
        if any("v=7 " in v for v in values):
            raise OSError("refused")
        with open(sent, "a") as out:
            out.writelines(f"{v}\n" for v in values)

    failed = metrics.failed_deliveries(lines, send, batch=4).collect()
    assert [r.value.split()[-1] for r in failed] == ["4", "5", "6", "7"] and {r.error for r in failed} == {"OSError: refused"}
    assert len(open(sent).readlines()) == 16


def test_every_message_is_routed_once(spark, tmp_path):
    src = tmp_path / "in"
    good = {"device_id": "m", "temperature": 75, "unit": "C", "ts": "2026-03-11T00:00:00Z", "_ingested_at": 1}
    texts = [json.dumps(good), "{broken", json.dumps({**good, "unit": "RANKINE"}), json.dumps({**good, "temperature": "99999"}),
             json.dumps({**good, "temperature": "212", "unit": "f"})]
    stage(src, "a.json", texts, 1)
    stage(src, "b.json", texts[:2], 2)
    records = topics.read_topic(spark, str(src), streaming=True, max_files=1)
    pipelines.normalize_stream(records, str(tmp_path / "o"), str(tmp_path / "k")).awaitTermination()
    rows = spark.read.json(str(tmp_path / "o"))
    assert rows.where("route = 'clean'").select("temperature_c").orderBy("temperature_c").collect() == [(75.0,), (75.0,), (100.0,)]
    assert sorted(r.reason for r in rows.where("route = 'invalid'").collect()) == sorted(
        [C.REASON_DEVICE] * 2 + ["unidad no reconocida: RANKINE", "temperatura sobre máximo: 99999.00C"])


def test_lake_and_point_streams(spark, tmp_path):
    src = tmp_path / "in"
    stage(src, "a.json", [reading(0, 1.0), reading(3000, 2.0)], 1)
    stage(src, "b.json", [reading(3599, 3.0)], 2)
    clean = topics.with_event_time(clean_stream(spark, src)).drop("_corrupt")
    lake.stream_lake(clean, str(tmp_path / "lake"), str(tmp_path / "k1"), interval=None).awaitTermination()
    assert lake.read_lake(spark, str(tmp_path / "lake"), "2026-03-11 00", "2026-03-11 00").count() == 3
    pipelines.point_stream(clean_stream(spark, src), str(tmp_path / "p"), str(tmp_path / "k2"), interval=None).awaitTermination()
    assert f"sensor_reading,device_id=m1,unit_original=C temperature_c=1.0,ingested_at=1i {BASE}" in [
        r.value for r in spark.read.text(str(tmp_path / "p")).collect()]


def message(m):
    device, seq, s, content, prev, h = m
    return json.dumps({"device_id": device, "body": content, "seq": seq, "prev_hash": prev, "hash": h})


def resign(messages):
    """Chains whose hash covers the whole message, as the stream verifies it."""
    import hashlib

    last, out = {}, []
    for device, seq, s, content, _, _ in messages:
        body = json.dumps({"device_id": device, "body": content, "seq": seq}, sort_keys=True)
        prev = last.get(device, C.GENESIS_HASH)
        last[device] = hashlib.sha256((body + prev).encode()).hexdigest()
        out.append([device, seq, s, content, prev, last[device]])
    return out


def test_verifier_keeps_state_over_batches_and_restarts(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "o"), str(tmp_path / "k")
    a, b = resign(signed("a", 9)), resign(signed("b", 6))
    b[3][3] = "changed"
    batches = [a[:3] + b[:2], a[3:6] + b[2:4], a[6:] + b[4:]]

    def run():
        records = topics.read_topic(spark, str(src), streaming=True, max_files=1)
        tagged = verifier.verify_stream(records, "CAST(get_json_object(value, '$.seq') AS BIGINT)")
        pipelines.tagged_stream(tagged, out, ck).awaitTermination()

    for i, rows in enumerate(batches[:2]):
        stage(src, f"{i}.json", [message(m) for m in reversed(rows)] + (["{broken", "[1]"] if i == 0 else []), i)
    run()
    stage(src, "2.json", [message(m) for m in batches[2]], 2)
    run()
    rows = spark.read.schema("key STRING, seq BIGINT, tag STRING, payload STRING").json(out).collect()
    tags = {(r.key, r.seq): r.tag for r in rows if r.key != "unknown"}
    assert all(tags["a", i] == "ok" for i in range(9))
    assert [tags["b", i] for i in range(6)] == ["ok", "ok", "ok", "dlq", "dlq", "dlq"]
    reasons = {(r.key, r.seq): json.loads(r.payload) for r in rows if r.tag == "dlq"}
    assert reasons["b", 3]["reason"] == C.CHAIN_BAD_HASH and len(reasons["b", 3]["expected_hash"]) == 64
    assert reasons["b", 4]["reason"] == C.CHAIN_BAD_PREV and reasons["b", 4]["expected_prev"] == b[2][5]
    assert sorted(json.loads(r.payload)["raw"] for r in rows if r.key == "unknown") == ["[1]", "{broken"]


@pytest.mark.parametrize("text, tag", [("{bad", "dlq"), (None, "dlq"), ('{"device_id": "m"}', "dlq"), ('"x"', "dlq")])
def test_check_never_raises(text, tag):
    got = verifier.check(text, C.GENESIS_HASH)
    assert got[0] == tag and got[2] == C.GENESIS_HASH


def test_dead_letters_keep_the_whole_text():
    text = "x" * 2000
    assert json.loads(verifier.check(text, C.GENESIS_HASH)[1])["raw"] == text


def test_null_records_reach_the_dead_letters(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([(1, None), (2, "{bad"), (3, None)], "offset LONG, value STRING").write.parquet(path)
    stream = spark.readStream.schema("offset LONG, value STRING").parquet(path)
    query = pipelines.tagged_stream(verifier.verify_stream(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination()
    rows = spark.read.schema("key STRING, seq LONG, tag STRING, payload STRING").json(str(tmp_path / "out")).collect()
    assert sorted((r.key, r.seq, r.tag) for r in rows) == [("unknown", n, "dlq") for n in (1, 2, 3)]


def test_missing_prev_means_genesis():
    import hashlib

    h = hashlib.sha256(('{"a": 1}' + C.GENESIS_HASH).encode()).hexdigest()
    assert verifier.check(json.dumps({"a": 1, "hash": h}), C.GENESIS_HASH) == ("ok", json.dumps({"a": 1, "hash": h}), h)


def test_observed_counters(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([('{"device_id":"m","temperature":1,"unit":"C","ts":"x"}',), ("{bad",)], "value STRING")
    seen = Observation("ingest")
    done = ingest.ingest(df, "t", 1, F.lit(1))
    rejected = F.col("reject_reason").isNotNull()
    done.observe(seen, F.count(F.lit(1)).alias("received"), F.count_if(rejected).alias("invalid")).collect()
    assert seen.get == {"received": 2, "invalid": 1}
    assert ingest.observe_counters(done).count() == 2
