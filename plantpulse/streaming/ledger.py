"""A table of the newest row per key, kept beside a stream that works batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def batch_folders(spark: SparkSession, path: str) -> list[int]:
    """Ids of the ``batch=<id>`` folders below ``path`` whose write was finished."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(int(f.getPath().getParent().getName().removeprefix("batch=")) for f in found or [])


class Ledger:
    """State of a keyed stream as files: each micro-batch writes the rows of the keys it changed, and every ``full_every``-th
    one a whole table, so reading takes one whole table and few changes.

    A replayed micro-batch sees what the batches before it left and overwrites its own folder, so its result is the same.
    Folders that no replay can ask for any more are deleted.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, full_every: int = 16):
        self.spark, self.path, self.key, self.full_every = spark, path, key, full_every

    def _read(self, kind: str, ids: list[int]) -> DataFrame | None:
        if not ids:
            return None
        return self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(*[f"{self.path}/{kind}/batch={i}" for i in ids])

    def before(self, batch_id: int) -> DataFrame | None:
        """The newest row of each key that batches before ``batch_id`` wrote; None where there is none."""
        whole = [i for i in batch_folders(self.spark, f"{self.path}/full") if i < batch_id][-1:]
        since = [i for i in batch_folders(self.spark, f"{self.path}/changes") if (whole[0] if whole else -1) < i < batch_id]
        parts = [p for p in (self._read("full", whole), self._read("changes", since)) if p is not None]
        if not parts:
            return None
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        names = [c for c in rows.columns if c not in (self.key, "batch")]
        newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*names), "batch").alias("_r"))
        return newest.select(self.key, *[F.col("_r")[c].alias(c) for c in names])

    def write(self, batch_id: int, changes: DataFrame) -> None:
        """Keep the rows of the keys that this batch changed, one row per key."""
        changes.write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch_id}")
        if (batch_id + 1) % self.full_every:
            return
        whole = self.before(batch_id + 1)
        whole.write.mode("overwrite").parquet(f"{self.path}/full/batch={batch_id}")
        for kind in ("changes", "full"):
            for old in batch_folders(self.spark, f"{self.path}/{kind}"):
                if old < batch_id - self.full_every:
                    at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/batch={old}")
                    at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
