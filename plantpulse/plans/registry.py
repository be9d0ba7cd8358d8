"""Registration of queries next to their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.plans.fixtures import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Result types that read the same in both engines: plain timestamps, 6-digit doubles."""
    def one(name: str, kind: str):
        column = F.col(f"`{name}`")
        if kind == "timestamp":
            return column.cast("timestamp_ntz").alias(name)
        return F.round(column, 6).alias(name) if kind == "double" else column

    return df.select(*[one(n, k) for n, k in df.dtypes])


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with its SQL where there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(Tables(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register
