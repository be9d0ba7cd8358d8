"""Late rows as a side output, batches of points by size and time, and state that a stream keeps in files."""

import json
import time

import pytest
from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse.operators.windows import window_stats
from plantpulse.sources import topics
from plantpulse.streaming import late, pipelines, verifier
from plantpulse.streaming.ledger import Ledger, batch_folders
from tests.test_streaming import clean_stream, message, reading, resign, stage
from tests.test_chain import signed


# --- late rows --------------------------------------------------------------

def route(spark, src, out, ck):
    timed = topics.with_event_time(clean_stream(spark, src)).drop("_corrupt")
    late.route_late(timed, out, ck).awaitTermination()


def values(spark, out, side):
    return sorted(r["temperature_c"] for r in late.routed_rows(spark, out, side).collect())


def test_late_rows_are_a_side_output(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "o"), str(tmp_path / "k")
    stage(src, "a.json", [reading(0, 1.0), reading(200, 2.0)], 1)
    stage(src, "b.json", [reading(10, 3.0), reading(130, 4.0), reading(185, 5.0)], 2)
    route(spark, src, out, ck)
    # the first batch left a watermark of 190 s: windows that ended by then are over, the one from 180 s on is not
    assert values(spark, out, late.LATE) == [3.0, 4.0] and values(spark, out, late.ON_TIME) == [1.0, 2.0, 5.0]
    stage(src, "c.json", [reading(150, 6.0), json.dumps({"device_id": "m1", "temperature_c": 7.0, "ts": "no time"}), reading(400, 8.0)], 3)
    route(spark, src, out, ck)  # a restart goes on with the watermark
    stage(src, "d.json", [reading(300, 9.0), reading(395, 10.0)], 4)
    route(spark, src, out, ck)
    assert values(spark, out, late.LATE) == [3.0, 4.0, 6.0, 9.0] and values(spark, out, late.UNTIMED) == [7.0]
    counts = [tuple(r) for r in late.late_counts(spark, out).orderBy("batch").collect()]
    assert counts == [(0, 2, 0, 0, 2), (1, 3, 2, 0, 1), (2, 3, 1, 1, 1), (3, 2, 1, 0, 1)]


def test_dropped_and_counted_are_all_that_was_offered(spark, tmp_path):
    """Windows streamed over the rows on time drop none of them, and the late ones are the rest."""
    src, out = tmp_path / "in", str(tmp_path / "o")
    offered = [[reading((i * 37) % 600 if i % 5 == 0 else b * 200 + i, float(i)) for i in range(30)] for b in range(4)] + [[reading(3000, 1.0)], [reading(3001, 1.0)]]
    for b, lines in enumerate(offered):
        stage(src, f"{b}.json", lines, b)
    route(spark, src, out, str(tmp_path / "k1"))
    timed = topics.with_event_time(late.on_time_stream(spark, out, max_files=1).drop("event_time"))
    pipelines._start(window_stats(timed), lambda b, p: b.write.mode("overwrite").parquet(p), str(tmp_path / "w"), str(tmp_path / "k2"), None).awaitTermination()
    counted = spark.read.parquet(str(tmp_path / "w")).agg(F.sum("count_readings")).first()[0]
    totals = late.late_counts(spark, out).agg(F.sum("offered").alias("offered"), F.sum("late").alias("late"), F.sum("on_time").alias("on_time")).first()
    assert totals["offered"] == sum(map(len, offered)) == totals["late"] + totals["on_time"] and totals["late"] > 0
    assert counted + 2 == totals["on_time"]  # the two newest rows' window is still open


def test_a_replayed_batch_gives_the_same_sides(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "o"), tmp_path / "k"
    stage(src, "a.json", [reading(300, 1.0)], 1)
    stage(src, "b.json", [reading(0, 2.0), reading(310, 3.0)], 2)
    route(spark, src, out, str(ck))
    for name in ("commits/1", "commits/.1.crc"):  # as if the second batch had failed after writing its rows
        (ck / name).unlink()
    route(spark, src, out, str(ck))
    assert values(spark, out, late.LATE) == [2.0] and values(spark, out, late.ON_TIME) == [1.0, 3.0]


# --- batches by size and time -----------------------------------------------

def test_points_are_given_out_when_full_or_due(spark, tmp_path):
    verifier.use_state_store(spark)
    src, out = tmp_path / "in", str(tmp_path / "o")
    stage(src, "a.json", [reading(i, float(i)) for i in range(23)], 1)
    query = pipelines.gathered_stream(clean_stream(spark, src), out, str(tmp_path / "k"), size=10, seconds=4, shards=1, interval="500 milliseconds")
    schema = "shard INT, cause STRING, n BIGINT, lines ARRAY<STRING>"

    def got():
        return sorted((r["cause"], r["n"]) for r in spark.read.schema(schema).json(out).collect())

    def wait(wanted):
        deadline = time.monotonic() + 90
        while time.monotonic() < deadline:
            if (tmp_path / "o").exists() and got() == wanted:
                return
            time.sleep(0.5)
        assert got() == wanted

    try:
        wait([("due", 3), ("full", 10), ("full", 10)])
        stage(src, "b.json", [reading(100 + i, float(i)) for i in range(10)], 2)
        wait([("due", 3), ("full", 10), ("full", 10), ("full", 10)])
        stage(src, "c.json", [reading(200, 1.0)], 3)
        wait([("due", 1), ("due", 3), ("full", 10), ("full", 10), ("full", 10)])
    finally:
        query.stop()
    lines = [line for r in spark.read.schema(schema).json(out).collect() for line in r["lines"]]
    assert len(lines) == len(set(lines)) == 34 and all(line.startswith("sensor_reading,device_id=m1") for line in lines)


# --- delivery ---------------------------------------------------------------

def test_failing_sends_of_a_stream_are_kept(spark, tmp_path):
    src, sent, failed = tmp_path / "in", str(tmp_path / "sent"), str(tmp_path / "failed")
    stage(src, "a.json", [reading(0, 90.0, "a"), reading(1, 50.0, "b"), reading(2, 60.0, "c"), reading(200, 1.0)], 1)
    stage(src, "b.json", [reading(210, 1.0)], 2)

    def send(values):
        if any("device_id=b" in v for v in values):
            raise ConnectionError("refused")
        with open(sent, "a") as out:
            out.writelines(f"{v}\n" for v in values)

    pipelines.delivery_stream(clean_stream(spark, src), send, failed, str(tmp_path / "k"), batch=1).awaitTermination()
    kept = spark.read.schema("value STRING, error STRING").json(failed).collect()
    assert [(r["value"].split()[0], r["error"]) for r in kept] == [("machine_stats,device_id=b", "ConnectionError: refused")]
    assert sorted(line.split()[0] for line in open(sent)) == ["machine_stats,device_id=a", "machine_stats,device_id=c"]


# --- chains over batches ----------------------------------------------------

def test_topic_verifier_tags_like_the_state_store(spark, tmp_path):
    verifier.use_state_store(spark)
    src = tmp_path / "in"
    a, b = resign(signed("a", 40)), resign(signed("b", 25))
    b[13][3] = "changed"
    odd = ["{broken", "[1]", json.dumps({"device_id": "a", "seq": 900, "prev_hash": 5, "hash": None}), json.dumps({"device_id": "c", "seq": 1})]
    for i in range(5):
        part = a[i * 8:i * 8 + 8] + b[i * 5:i * 5 + 5]
        stage(src, f"{i}.json", [message(m) for m in reversed(part)] + (odd if i == 2 else []), i)
    seq = "CAST(get_json_object(value, '$.seq') AS BIGINT)"

    def records():
        return topics.read_topic(spark, str(src), streaming=True, max_files=1)

    pipelines.tagged_stream(verifier.verify_stream(records(), seq), str(tmp_path / "o1"), str(tmp_path / "k1")).awaitTermination()
    verifier.verify_topic(records(), str(tmp_path / "o2"), str(tmp_path / "k2"), seq).awaitTermination()
    one, two = (spark.read.schema("key STRING, seq BIGINT, tag STRING, payload STRING").json(str(tmp_path / o)).where("key != 'unknown'") for o in ("o1", "o2"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) and two.count() == 67
    ok = {(r["key"], r["seq"]) for r in two.where("tag = 'ok'").collect()}
    assert ok == {("a", i) for i in range(40)} | {("b", i) for i in range(13)}
    letters = spark.read.schema("key STRING, tag STRING, payload STRING").json(str(tmp_path / "o2")).where("key = 'unknown'").collect()
    assert sorted(json.loads(r["payload"])["raw"] for r in letters) == ["[1]", "{broken"]
    assert {r["tag"] for r in letters} == {"dlq"}
    assert not list((tmp_path / "o2" / "_verdicts").glob("batch=*"))


def test_topic_verifier_replays_a_batch(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "o"), tmp_path / "k"
    a = resign(signed("a", 9))
    for i in range(3):
        stage(src, f"{i}.json", [message(m) for m in a[i * 3:i * 3 + 3]], i)

    def run():
        records = topics.read_topic(spark, str(src), streaming=True, max_files=1)
        verifier.verify_topic(records, out, str(ck), "CAST(get_json_object(value, '$.seq') AS BIGINT)").awaitTermination()

    run()
    for name in ("commits/2", "commits/.2.crc"):
        (ck / name).unlink()
    run()
    rows = spark.read.schema("key STRING, seq BIGINT, tag STRING").json(out).collect()
    assert sorted((r["seq"], r["tag"]) for r in rows) == [(i, "ok") for i in range(9)]


def test_one_device_passes_in_chunks(spark, rows):
    """A device far larger than an Arrow batch is judged in its order, with one hash carried from chunk to chunk."""
    messages = resign(signed("hot", 3000))
    data = [(i, message(m)) for i, m in enumerate(messages)]
    linked = verifier.linked_messages(rows(data, "offset BIGINT, value STRING").repartition(7))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = verifier.judged_batch(linked, None).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 3000 and all(r["reason"] is None for r in got)
    start = rows([("hot", messages[9][5])], "key STRING, hash STRING")
    later = verifier.judged_batch(verifier.linked_messages(rows(data[10:20], "offset BIGINT, value STRING")), start).collect()
    assert all(r["reason"] is None for r in later) and max(r["n"] for r in later) == 10


@pytest.mark.parametrize("text", [None, "{bad", "[1]", json.dumps({"prev_hash": None}), json.dumps({"prev_hash": C.GENESIS_HASH, "hash": 3})])
def test_links_of_odd_messages(text):
    readable, prev, declared, computed = verifier.links(text)
    assert isinstance(readable, bool) and all(isinstance(v, str) for v in (prev, declared, computed))
    assert verifier.judge(C.GENESIS_HASH, readable, prev, declared, computed)[0] is not None


def test_ledger_keeps_the_newest_row(spark, rows, tmp_path):
    book = Ledger(spark, str(tmp_path / "l"), "key", full_every=4)
    assert book.before(0) is None
    for i in range(14):
        book.write(i, rows([(f"k{i % 3}", i), ("all", i)], "key STRING, v INT"))
    assert {tuple(r) for r in book.before(14).collect()} == {("all", 13), ("k0", 12), ("k1", 13), ("k2", 11)}
    assert {tuple(r) for r in book.before(12).collect()} == {("all", 11), ("k0", 9), ("k1", 10), ("k2", 11)}
    assert min(batch_folders(spark, str(tmp_path / "l" / "changes"))) >= 7 and batch_folders(spark, str(tmp_path / "l" / "full"))
    book.write(13, rows([("all", 99)], "key STRING, v INT"))  # a replay overwrites its own rows only
    assert dict(map(tuple, book.before(14).collect())) == {"all": 99, "k0": 12, "k1": 10, "k2": 11}
