"""Topics as folders of NDJSON segments with real offsets: written by Spark, read in batch or as a stream.

A topic is ``<path>/partition=<p>/<first offset>-<end offset>.ndjson``; each line is a record ``{"k", "v", "t"}`` (key, value,
time in milliseconds) and its offset is the first one of its file plus its line number. Names alone tell what a topic holds.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from plantpulse.operators.ranks import ranked

FORMAT = "segmented_topic"
RECORDS = "topic STRING, partition INT, offset BIGINT, line STRING"
SEGMENT_ROWS = 100_000
#: Offsets and partitions are padded, so names sort like numbers.
_NAME = r"partition=(\d+)/(\d{20})-(\d{20})\.ndjson$"


@dataclass
class Segment(InputPartition):
    """Offsets ``low`` (inclusive) to ``high`` (exclusive) of one file that begins at ``first``."""

    file: str
    partition: int
    first: int
    low: int
    high: int


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


def _listed(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """(first, end, file) of each partition's segments in order. Unfinished files have other names."""
    store, root = _open(path)
    out: dict[int, list[tuple[int, int, str]]] = {}
    for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        folder, name = posixpath.split(info.path)
        p = posixpath.basename(folder)
        if name.endswith(".ndjson") and p.startswith("partition=") and not name.startswith("."):
            first, end = name.removesuffix(".ndjson").split("-")
            out.setdefault(int(p.removeprefix("partition=")), []).append((int(first), int(end), info.path))
    return {p: sorted(found) for p, found in out.items()}


def _planned(listed: dict[int, list[tuple[int, int, str]]], low: dict[int, int], high: dict[int, int]) -> list[Segment]:
    out = []
    for p, found in sorted(listed.items()):
        for first, end, file in found:
            a, b = max(first, low.get(p, first)), min(end, high.get(p, end))
            if a < b:
                out.append(Segment(file, p, first, a, b))
    return out


def _offsets(option: str | None) -> dict[int, int]:
    return {int(p): int(o) for p, o in json.loads(option).items()} if option else {}


class _Records:
    """Reading shared by batch and stream: a task streams one file and gives Arrow batches of its lines."""

    def __init__(self, options: dict[str, str]):
        self.path, self.rows = options["path"].rstrip("/"), int(options.get("batchRows", "10000"))
        self.topic = options.get("topic", posixpath.basename(self.path))

    def read(self, segment: Segment) -> Iterator[pa.RecordBatch]:
        store, _ = _open(self.path)
        lines: list[str] = []
        at = segment.first
        start = segment.low

        def batch() -> pa.RecordBatch:
            n = len(lines)
            return pa.record_batch(
                [pa.array([self.topic] * n, pa.string()), pa.array([segment.partition] * n, pa.int32()), pa.array(range(start, start + n), pa.int64()), pa.array(lines, pa.string())],
                names=["topic", "partition", "offset", "line"])

        with pa.PythonFile(store.open_input_stream(segment.file), mode="r") as source:
            rest = b""
            while at < segment.high:
                block = source.read(1 << 20)
                whole = (rest + block).split(b"\n")
                rest = whole.pop() if block else b""
                for line in whole:
                    if segment.low <= at < segment.high:
                        lines.append(line.decode("utf8"))
                        if len(lines) == self.rows:
                            yield batch()
                            start, lines = at + 1, []
                    at += 1
                if not block:
                    break
        if lines:
            yield batch()


class _BatchReader(_Records, DataSourceReader):
    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.low, self.high = _offsets(options.get("startingOffsets")), _offsets(options.get("endingOffsets"))

    def partitions(self) -> list[Segment]:
        return _planned(_listed(self.path), self.low, self.high)


class _StreamReader(_Records, DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.start = _offsets(options.get("startingOffsets"))

    def initialOffset(self) -> dict:
        return {str(p): max(found[0][0], self.start.get(p, 0)) for p, found in _listed(self.path).items()}

    def latestOffset(self) -> dict:
        return {str(p): found[-1][1] for p, found in _listed(self.path).items()}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        listed = _listed(self.path)
        # a partition that came up after the start is read from its first offset on
        known = {p: found for p, found in listed.items() if str(p) in end}
        return _planned(known, {int(p): o for p, o in start.items()}, {int(p): o for p, o in end.items()})


class SegmentedTopic(DataSource):
    """Options: ``path``, ``topic`` (the folder's name by default), ``startingOffsets`` and, in batch, ``endingOffsets`` as
    JSON ``{"partition": offset}``. The planning lists file names only; a stream's offsets are in its checkpoint."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)


def read_segments(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """Records of a topic: topic, partition, offset, key, value, timestamp."""
    spark.dataSource.register(SegmentedTopic)
    reader = (spark.readStream if streaming else spark.read).format(FORMAT).options(**options)
    records = reader.load(path)
    body = F.from_json("line", "k STRING, v STRING, t BIGINT")
    return records.withColumn("_r", body).select(
        "topic", "partition", "offset", F.col("_r.k").alias("key"), F.col("_r.v").alias("value"), F.timestamp_millis("_r.t").alias("timestamp"))


def _end_offsets(spark: SparkSession, path: str) -> dict[int, int]:
    return {p: found[-1][1] for p, found in _listed(path).items()}


def append_segments(df: DataFrame, path: str, order: list[str], partitions: int = 4, segment_rows: int = SEGMENT_ROWS,
                    partition: str | None = None) -> None:
    """Append records (key, value, optional timestamp) to a topic.

    A record goes to the partition of its key's hash, or to the one in column ``partition``. The offsets of a partition go on
    where it ends, in the order of ``order``, without a gap; a partition with a hot key is numbered and written by many tasks.
    A segment is written under another name first and renamed when it is whole; a repeated task writes the same file again.
    """
    ends = _end_offsets(df.sparkSession, path)
    number = F.col(partition) if partition else F.pmod(F.xxhash64(F.coalesce("key", F.lit(""))), F.lit(partitions))
    rows = df.withColumn("_p", number.cast("int"))
    begins = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in ends.items() for x in pair]), F.col("_p")), F.lit(0)) if ends else F.lit(0)
    placed = ranked(rows, order, ["_p"], "_at").withColumn("_segment", F.floor(F.col("_at") / segment_rows)).withColumn("_offset", begins + F.col("_at"))
    time = F.unix_millis(F.col("timestamp")) if "timestamp" in df.columns else F.lit(None).cast("bigint")
    line = F.to_json(F.struct(F.col("key").cast("string").alias("k"), F.col("value").cast("string").alias("v"), time.alias("t")))
    lines = placed.select("_p", "_segment", "_offset", line.alias("line"))

    def write(table: pa.Table) -> pa.Table:
        store, root = _open(path)
        table = table.sort_by("_offset")
        first, p = table.column("_offset")[0].as_py(), table.column("_p")[0].as_py()
        folder = f"{root}/partition={p}"
        name = f"{first:020d}-{first + table.num_rows:020d}.ndjson"
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/.{name}") as out:
            for batch in table.column("line").to_pylist():
                out.write(batch.encode("utf8") + b"\n")
        store.move(f"{folder}/.{name}", f"{folder}/{name}")
        return pa.table({"file": [f"{folder}/{name}"]})

    lines.groupBy("_p", "_segment").applyInArrow(write, "file STRING").write.format("noop").mode("overwrite").save()


def extents(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """Lowest and next offset of each partition and the messages kept, from file names; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ndjson").option("recursiveFileLookup", "true").load(path)
    part = lambda i: F.regexp_extract("path", _NAME, i).cast("bigint")
    named = files.select(part(1).cast("int").alias("partition"), part(2).alias("first"), part(3).alias("end"))
    name = topic or posixpath.basename(path.rstrip("/"))
    return named.groupBy(F.lit(name).alias("topic"), "partition").agg(
        F.min("first").alias("low"), F.max("end").alias("high"), (F.max("end") - F.min("first")).alias("mensajes"), F.sum(F.col("end") - F.col("first")).alias("retenidos"))


def sample(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` records of each partition; only segments that hold them are read."""
    first = {p: found[0][0] + n for p, found in _listed(path).items()}
    return read_segments(spark, path, endingOffsets=json.dumps(first))
