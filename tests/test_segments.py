"""Topics as folders of segments: offsets, extents, samples, batch and stream reading."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plantpulse.operators.ranks import ranked
from plantpulse.sources import segments

SCHEMA = "key STRING, value STRING, n BIGINT"


def names(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*.ndjson"))


@pytest.fixture
def topic(rows, tmp_path):
    path = str(tmp_path / "readings")

    def append(data, **options):
        segments.append_segments(rows(data, SCHEMA).repartition(3), path, ["n"], **options)
        return path

    return append


def test_ranks_are_places_in_the_order(rows):
    rng = random.Random(2)
    data = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([None, *range(40)]), i) for i in range(500)]
    frame = rows(data, "g STRING, v INT, id INT").repartition(4)
    whole = sorted(ranked(frame, ["v", "id"]).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in whole] == list(range(500))
    assert [(r["v"], r["id"]) for r in whole] == sorted(((v, i) for _, v, i in data), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    for g in ("a", "b", None, "hot"):
        part = sorted((r for r in ranked(frame, ["v", "id"], ["g"], "at").collect() if r["g"] == g), key=lambda r: r["at"])
        assert [r["at"] for r in part] == list(range(len(part)))
    assert ranked(rows([], "g STRING, v INT, id INT"), ["v"]).count() == 0
    same = ranked(rows([("x", 1, 1)] * 300, "g STRING, v INT, id INT").repartition(5), ["v"]).collect()
    assert sorted(r["rank"] for r in same) == list(range(300))


def test_offsets_go_on_without_a_gap(spark, topic):
    path = topic([(f"k{i % 5}", f"v{i}", i) for i in range(100)], partitions=2, segment_rows=7)
    topic([(f"k{i % 5}", f"w{i}", i) for i in range(30)], partitions=2, segment_rows=7)
    got = segments.read_segments(spark, path).collect()
    assert len(got) == 130 and {r["topic"] for r in got} == {"readings"}
    for p in {r["partition"] for r in got}:
        mine = sorted((r for r in got if r["partition"] == p), key=lambda r: r["offset"])
        assert [r["offset"] for r in mine] == list(range(len(mine)))
        # each append keeps its order
        assert [int(r["value"][1:]) for r in mine if r["value"][0] == "v"] == sorted(int(r["value"][1:]) for r in mine if r["value"][0] == "v")
    assert len({(r["key"], r["partition"]) for r in got}) == 5


def test_names_tell_the_extents(spark, topic):
    path = topic([("k", f"v{i}", i) for i in range(25)], partitions=1, segment_rows=10)
    assert names(path) == [f"partition=0/{a:020d}-{b:020d}.ndjson" for a, b in ((0, 10), (10, 20), (20, 25))]
    row = segments.extents(spark, path).first()
    assert row.asDict() == {"topic": "readings", "partition": 0, "low": 0, "high": 25, "mensajes": 25, "retenidos": 25}
    (Path(path) / "partition=0" / f"{0:020d}-{10:020d}.ndjson").unlink()  # the oldest segment goes by retention
    assert segments.extents(spark, path).first()["low"] == 10
    assert [r["offset"] for r in segments.sample(spark, path, 3).collect()] == [10, 11, 12]


def test_sample_reads_only_its_segments(spark, topic):
    path = topic([("k", f"v{i}", i) for i in range(50)], partitions=1, segment_rows=10)
    for file in names(path)[2:]:
        (Path(path) / file).write_text("broken")
    assert [r["value"] for r in segments.sample(spark, path, 12).orderBy("offset").collect()] == [f"v{i}" for i in range(12)]


def test_starting_and_ending_offsets(spark, topic):
    path = topic([("k", f"v{i}", i) for i in range(30)], partitions=1, segment_rows=8)
    some = segments.read_segments(spark, path, startingOffsets=json.dumps({"0": 5}), endingOffsets=json.dumps({"0": 20}))
    assert [r["offset"] for r in some.orderBy("offset").collect()] == list(range(5, 20))


def test_null_empty_and_odd_values(spark, topic):
    data = [(None, None, 0), ("", "", 1), ("ä", 'line\nbreak "x" {', 2), ("k", "\U0001f600" * 3000, 3), ("k", "{bad", 4)]
    path = topic(data, partitions=1)
    assert [(r["key"], r["value"]) for r in segments.read_segments(spark, path).orderBy("offset").collect()] == [d[:2] for d in data]
    topic([], partitions=1)
    assert segments.extents(spark, path).first()["high"] == 5


def test_a_stream_restarts_at_its_offsets(spark, topic, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    path = topic([(f"k{i}", f"v{i}", i) for i in range(40)], partitions=3, segment_rows=5)

    def run():
        stream = segments.read_segments(spark, path, streaming=True).select("partition", "offset", "value")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(out)

    assert run().count() == 40
    topic([(f"k{i}", f"w{i}", i) for i in range(20)], partitions=4, segment_rows=5)  # a fourth partition comes up
    after = run()
    assert after.count() == 60 and after.distinct().count() == 60
    assert after.where("value LIKE 'w%'").count() == 20 and run().count() == 60


def test_a_hot_key_is_numbered_by_many_tasks(spark, topic):
    path = topic([("hot" if i % 3 else f"k{i}", f"v{i}", i) for i in range(900)], partitions=2, segment_rows=50)
    sizes = segments.read_segments(spark, path).groupBy("partition").agg(F.count("*").alias("n"), F.max("offset").alias("last")).collect()
    assert all(r["n"] == r["last"] + 1 for r in sizes) and sum(r["n"] for r in sizes) == 900
