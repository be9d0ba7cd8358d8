"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# All of these are runtime settings, so they also apply to a session made elsewhere.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "plantpulse", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


_ROOTS: dict[str, str] = {}


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder the cluster names in spark.checkpoint.dir.

    Where that is unset, the warehouse is the shared folder. The session's part of it goes when the session
    ends; the caller's settings stay as they are.
    """
    application = spark.sparkContext.applicationId
    if application not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        if base.startswith("file:/") and not base.startswith("file://"):
            base = f"file://{base.removeprefix('file:')}"
        root = f"{base.rstrip('/')}/plantpulse-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _ROOTS[application] = root
    return f"{_ROOTS[application]}/{label}-{uuid.uuid4().hex}"


def cut(df, label: str):
    """Materialize ``df`` as a table in the shared folder and read it back.

    Used where several later jobs read the same intermediate rows: the files
    outlive lost executors, and every reader sees the same rows.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
