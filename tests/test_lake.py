import json

import pytest
from pyspark.sql import functions as F

from plantpulse.operators import routing, unify, windows
from plantpulse.sources import compaction, lake, metrics, topics

BASE = 1773187200


@pytest.fixture(scope="module")
def clean(spark):
    ids = spark.range(4000)
    return ids.select(
        F.concat(F.lit("m"), F.col("id") % 5).alias("device_id"), (F.col("id") % 60 + 30.5).alias("temperature_c"),
        F.lit("C").alias("unit_original"),
        F.date_format(F.timestamp_seconds(F.lit(BASE) + F.col("id") * 10), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        (F.lit(BASE * 1000) + F.col("id") * 10_000).alias("_ingested_at"),
        F.timestamp_seconds(F.lit(BASE) + F.col("id") * 10).alias("event_time"))


@pytest.fixture(scope="module")
def written(clean, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "clean")
    lake.write_lake(clean, path)
    return path


def test_round_trip_keeps_zero_padded_strings(spark, clean, written):
    back = lake.read_lake(spark, written)
    assert dict(back.dtypes)["hour"] == "string"
    assert {r.hour for r in back.select("hour").distinct().collect()} == {f"{h:02d}" for h in range(12)}
    assert back.select(*clean.columns[:-1]).exceptAll(clean.drop("event_time")).count() == 0 and back.count() == 4000


def test_hour_range_prunes_folders(spark, written):
    some = lake.read_lake(spark, written, "2026-03-11 02", "2026-03-11 03")
    assert some.count() == 720
    assert len(some.inputFiles()) <= 24
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "concat_ws" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert some.select(F.input_file_name().alias("f")).distinct().count() == 2


def test_rows_without_time_go_by_ingest_time(spark, tmp_path):
    df = spark.createDataFrame([("m", 1.0, "C", "bad", BASE * 1000, None)], "device_id STRING, temperature_c DOUBLE, unit_original STRING, "
                               "ts STRING, _ingested_at BIGINT, event_time TIMESTAMP")
    lake.write_lake(df, str(tmp_path / "l"))
    assert lake.read_lake(spark, str(tmp_path / "l")).first().day == "11"


def test_processing_time_partitions(spark, clean, tmp_path):
    lake.write_lake(clean.limit(3), str(tmp_path / "l"), partition_by="processing")
    year = spark.sql("SELECT date_format(current_timestamp(), 'yyyy')").first()[0]
    assert lake.read_lake(spark, str(tmp_path / "l")).first().year == year


def test_inventory_reads_no_content(spark, written):
    inventory = lake.lake_inventory(spark, written)
    assert "content" not in inventory.columns
    by_hour = {(r.day, r.hour): r.archivos for r in lake.lake_inventory_by_hour(inventory).collect()}
    assert len(by_hour) == 12 and all(n >= 1 for n in by_hour.values())
    totals = lake.inventory_totals(inventory).first()
    assert totals.archivos == sum(by_hour.values()) and totals.oldest <= totals.newest
    assert lake.newest_files(inventory, 5).count() == 5


def test_old_files_without_a_column_are_filtered(spark, written, tmp_path):
    folder = tmp_path / "l" / "year=2026" / "month=03" / "day=11" / "hour=00"
    folder.mkdir(parents=True)
    (folder / "old.json").write_text(json.dumps({"device_id": "m", "temp": 4}) + "\n" + json.dumps({"device_id": "m", "temperature_c": 4}))
    assert [r.temperature_c for r in lake.read_lake(spark, str(tmp_path / "l")).collect()] == [4.0]


def test_unify_with_one_side(spark, clean):
    stats = windows.window_stats(clean)
    cold = lake.with_partitions(clean)
    n_hot, n_cold = unify.unify(stats, None).count(), unify.unify(None, cold).count()
    assert n_cold == 4000 and unify.unify(stats, cold).count() == n_hot + n_cold
    assert unify.source_share(unify.unify(None, cold)).first().cold_pct == 100.0
    with pytest.raises(ValueError):
        unify.unify(None, None)


def test_unify_pushes_filters_to_both_sides(spark, written, clean):
    cold = lake.read_lake(spark, written)
    both = unify.unify(windows.window_stats(clean), cold).where("device_id = 'm1'")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(temperature_c), IsNotNull(device_id), EqualTo(device_id,m1)]" in plan


def test_routed_folders_and_csv(spark, tmp_path):
    raw = spark.createDataFrame([("m", 75.0, "C", "x", 1), ("m", None, "C", "x", 1), ("", 1.0, "C", "x", 1)],
                                "device_id STRING, temperature DOUBLE, unit STRING, ts STRING, _ingested_at BIGINT")
    metrics.write_routed(routing.route(raw), str(tmp_path / "r"))
    counts = {r.route: r["count"] for r in spark.read.json(str(tmp_path / "r")).groupBy("route").count().collect()}
    assert counts == {"clean": 1, "invalid": 2}
    (tmp_path / "q.csv").write_text("#datatype,string\n#group,false\n_time,device_id,_value\n2026-03-11T00:00:00Z,m1,71.5\n")
    assert lake.read_metric_csv(spark, str(tmp_path / "q.csv")).first().asDict() == {
        "_time": "2026-03-11T00:00:00Z", "device_id": "m1", "_value": "71.5"}


def test_post_lines_in_batches(spark, tmp_path):
    lines = spark.range(25).select(F.col("id").cast("string").alias("value")).repartition(2)
    folder = str(tmp_path)

    def send(batch):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}.txt", "w") as f:
            f.write("\n".join(batch))

    metrics.post_lines(lines, send, batch=4)
    texts = [p.read_text().split("\n") for p in tmp_path.glob("*.txt")]
    assert sorted(int(x) for t in texts for x in t) == list(range(25)) and max(map(len, texts)) == 4


def test_topic_round_trip_is_tolerant(spark, clean):
    records = topics.to_topic_records(clean.drop("event_time")).select("value")
    assert topics.clean_topic(records).drop("_corrupt").exceptAll(clean.drop("event_time")).count() == 0


# --- compaction ---------------------------------------------------------------

def parts(clean, path, n=4):
    for i in range(n):
        lake.write_lake(clean.where(F.pmod(F.xxhash64("ts"), F.lit(n)) == i).coalesce(1), path)


def lake_rows(spark, path):
    return sorted(map(tuple, lake.read_lake(spark, path).collect()))


def test_compaction_keeps_the_rows(spark, clean, tmp_path, monkeypatch):
    path = str(tmp_path / "l")
    parts(clean, path)
    before = lake_rows(spark, path)
    many = len(compaction.active_files(spark, path).plain)
    # a compaction that stops before its manifest changes nothing
    monkeypatch.setattr(compaction, "_publish", lambda *args: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        lake.compact_lake(spark, path)
    assert lake_rows(spark, path) == before and compaction.latest_version(spark, path) is None
    monkeypatch.undo()
    old = lake.read_lake(spark, path)  # a reader that began before
    assert lake.compact_lake(spark, path) == 1
    now = compaction.active_files(spark, path)
    assert now.plain == [] and many == 48 and sum(map(len, now.compacted.values())) == 12
    assert lake_rows(spark, path) == before == sorted(map(tuple, old.collect()))
    assert lake.compact_lake(spark, path) is None


def test_rows_added_after_a_compaction_are_read(spark, clean, tmp_path):
    path = str(tmp_path / "l")
    parts(clean.where("device_id != 'm1'"), path)
    lake.compact_lake(spark, path)
    parts(clean.where("device_id = 'm1'"), path, 2)
    want = sorted(map(tuple, lake.read_lake(spark, path).drop("x").collect()))
    assert len(want) == 4000
    assert lake.compact_lake(spark, path) == 2 and lake_rows(spark, path) == want
    some = lake.read_lake(spark, path, "2026-03-11 02", "2026-03-11 03")
    assert some.count() == 720 and some.select(F.input_file_name().alias("f")).distinct().count() == 2


def test_vacuum_deletes_what_nobody_reads(spark, clean, tmp_path):
    path = str(tmp_path / "l")
    parts(clean, path, 2)
    before = lake_rows(spark, path)
    lake.compact_lake(spark, path)
    assert compaction.vacuum(spark, path) == 0
    assert compaction.vacuum(spark, path, "0 seconds") == 24
    assert lake_rows(spark, path) == before and not list((tmp_path / "l" / "year=2026").rglob("*.json"))


def test_two_compactions_do_not_both_count(spark, clean, tmp_path):
    path = str(tmp_path / "l")
    parts(clean, path, 2)
    before = lake_rows(spark, path)
    lake.compact_lake(spark, path)
    with pytest.raises(RuntimeError):
        compaction._publish(spark, path, compaction.manifest(spark, path, 1), 1)
    assert lake_rows(spark, path) == before
