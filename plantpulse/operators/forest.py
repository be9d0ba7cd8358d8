"""Isolation forest over one temperature feature, trained and applied as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.functions import failure_prob, interpret, round_half_up
from plantpulse.operators.quantiles import exact_quantiles, profile
from plantpulse.session import cut

EULER = 0.5772156649015329
MIN_SAMPLES = 10
TREES = "tree INT, lo DOUBLE, hi DOUBLE, depth DOUBLE"


def _average_path(n):
    """Mean depth of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    inner = np.maximum(n, 3.0) - 1.0
    return np.where(n > 2, 2.0 * (np.log(inner) + EULER) - 2.0 * inner / (inner + 1.0), np.where(n == 2, 1.0, 0.0))


def _binomial(n: int, p: float) -> np.ndarray:
    """P(X < k) for k = 1 ... n of a binomial variable: a uniform number lies at or above as many of them as X says."""
    chance, below, out = (1 - p) ** n, 0.0, []
    for k in range(n):
        below += chance
        out.append(below if p < 1 else 0.0)
        chance *= (n - k) / (k + 1) * p / (1 - p) if p < 1 else 0.0
    return np.array(out)


def _grow(sample: np.ndarray, seed: int) -> list[tuple[float, float, float]]:
    """Random splits of one sample; leaves as (lo, hi, depth) intervals of the feature."""
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(2, len(sample)))))
    leaves, todo = [], [(np.sort(sample), -np.inf, np.inf, 0)]
    while todo:
        points, lo, hi, depth = todo.pop()
        if depth >= limit or len(points) <= 1 or points[0] == points[-1]:
            leaves.append((lo, hi, depth + float(_average_path(len(points)))))
            continue
        at = rng.uniform(points[0], points[-1])
        left = np.searchsorted(points, at, side="right")
        todo += [(points[:left], lo, at, depth + 1), (points[left:], at, hi, depth + 1)]
    return leaves


class IsolationForestJob:
    """Training settings. ``fit`` returns a ``ForestModel``."""

    def __init__(self, n_trees: int = 100, sample: int = 256, contamination: float = 0.1, seed: int = 42):
        if not 0.01 <= contamination <= 0.5:
            raise ValueError("contamination must lie in 0.01..0.5")
        self.n_trees, self.sample, self.contamination, self.seed = n_trees, sample, contamination, seed

    def fit(self, df: DataFrame, value: str = "avg_temp_c", key: tuple[str, ...] = ("device_id", "window_start")) -> ForestModel:
        rows = cut(df.where(F.col(value).isNotNull()).select(
            F.col(value).cast("double").alias("v"), F.xxhash64(*key, F.lit(self.seed)).alias("h")), "forest-rows")
        described = profile(rows, "v").first()
        if described["samples"] < MIN_SAMPLES:
            raise ValueError(f"at least {MIN_SAMPLES} samples are needed, got {described['samples']}")
        # Every row draws, by the hash of its key, how many trees it joins (binomial, so each tree gets
        # ``sample`` rows on average) and which ones: one pass, and one rule whatever the table's size.
        per_tree = min(self.sample, described["samples"])
        steps = F.array(*[F.lit(float(x)) for x in _binomial(self.n_trees, per_tree / described["samples"])])
        drawn = F.pmod("h", F.lit(1 << 40)) / float(1 << 40)
        joins = rows.withColumn("k", F.size(F.filter(steps, lambda x: x <= drawn))).where("k > 0")
        each = F.transform(F.sequence(F.lit(0), F.lit(self.n_trees - 1)), lambda i: F.struct(F.xxhash64("h", "v", i), i.alias("tree")))
        trees = joins.withColumn("tree", F.explode(F.slice(F.array_sort(each), F.lit(1), F.col("k"))["tree"]))
        seed = self.seed

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = int(pdf["tree"].iat[0])
            leaves = _grow(pdf["v"].to_numpy(), seed * 1000 + tree)
            return pd.DataFrame([(tree, *leaf) for leaf in leaves], columns=["tree", "lo", "hi", "depth"])

        leaves = trees.select("tree", "v").groupBy("tree").applyInPandas(grow, TREES)
        spark = df.sparkSession
        # about 2 * 256 leaves for each of the trees, whatever the input size
        table = spark.createDataFrame(leaves.toPandas(), TREES)
        model = ForestModel(table, described.asDict(), per_tree, self.contamination, None)
        scores = model._scored(rows, "v")
        model.offset = exact_quantiles(scores, [], "score", {"q": self.contamination}).first()["q"]
        return model


class ForestModel:
    """Leaves, training profile and score threshold."""

    def __init__(self, leaves: DataFrame, profile: dict, sample: int, contamination: float, offset: float | None):
        self.leaves, self.profile, self.sample = leaves, profile, sample
        self.contamination, self.offset = contamination, offset
        self._steps = None

    def _step_function(self) -> tuple[np.ndarray, np.ndarray]:
        """With one feature the whole forest is a step function: edges and score per step."""
        if self._steps is None:
            leaves = self.leaves.toPandas()
            edges = np.unique(leaves["lo"].to_numpy())
            edges = edges[np.isfinite(edges)]
            total = np.zeros(len(edges) + 1)
            for _, tree in leaves.groupby("tree"):
                tree = tree.sort_values("hi")
                # a split value belongs to the left leaf: intervals are (lo, hi]
                upper = np.append(edges, np.inf)
                total += tree["depth"].to_numpy()[np.searchsorted(tree["hi"].to_numpy(), upper, side="left")]
            mean_depth = total / leaves["tree"].nunique()
            self._steps = edges, -np.power(2.0, -mean_depth / float(_average_path(self.sample)))
        return self._steps

    def _scored(self, df: DataFrame, value: str) -> DataFrame:
        edges, scores = self._step_function()  # bounded by trees * sample, about 25,000 numbers
        shared = df.sparkSession.sparkContext.broadcast((edges, scores))

        @F.pandas_udf("double")
        def score(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
            at, level = shared.value
            for batch in values:
                x = batch.to_numpy(dtype=float)
                found = level[np.searchsorted(at, x, side="left")]
                yield pd.Series(np.where(np.isnan(x), np.nan, found))

        return df.withColumn("score", score(F.col(value)))

    def score(self, df: DataFrame, value: str = "avg_temp_c") -> DataFrame:
        """Add score, is_anomaly, failure_prob and the interpretation to every row."""
        p = {k: F.lit(float(v)) for k, v in self.profile.items() if v is not None}
        scored = self._scored(df, value).withColumn("score", F.nanvl("score", F.lit(None).cast("double")))
        return scored.withColumn("is_anomaly", F.col("score") < self.offset).withColumns({
            "failure_prob": round_half_up(failure_prob("score"), 4),
            "interpretation": interpret(value, "is_anomaly", "score", p["mean"], p["p5"], p["p95"]),
        })

    def predict(self, spark: SparkSession, value: float, device_id: str) -> DataFrame:
        """Score of one reading of a device: one row."""
        reading = spark.createDataFrame([(device_id, float(value))], "device_id STRING, temperature_c DOUBLE")
        return self.score(reading, "temperature_c")

    def sweep(self, spark: SparkSession, low: int = 40, high: int = 100, step: int = 5) -> DataFrame:
        """Response curve over a range of temperatures."""
        return self.score(spark.range(low, high + 1, step).select(F.col("id").cast("double").alias("avg_temp_c")))

    def status(self, spark: SparkSession) -> DataFrame:
        names = ["samples", "mean", "std", "min", "max", "p5", "p95"]
        row = [True, float(self.contamination), *[float(self.profile[n]) for n in names]]
        return spark.createDataFrame([tuple(row)], "trained BOOLEAN, contamination DOUBLE, " + ", ".join(f"{n} DOUBLE" for n in names))

    def save(self, path: str) -> None:
        spark = self.leaves.sparkSession
        self.leaves.coalesce(1).write.mode("overwrite").parquet(f"{path}/leaves")
        meta = [(k, float(v)) for k, v in self.profile.items()]
        meta += [("_sample", float(self.sample)), ("_contamination", float(self.contamination)), ("_offset", float(self.offset))]
        spark.createDataFrame(meta, "name STRING, value DOUBLE").coalesce(1).write.mode("overwrite").parquet(f"{path}/profile")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        meta = {r["name"]: r["value"] for r in spark.read.parquet(f"{path}/profile").collect()}
        own = {k: meta.pop(k) for k in ("_sample", "_contamination", "_offset")}
        return cls(spark.read.parquet(f"{path}/leaves"), meta, int(own["_sample"]), own["_contamination"], own["_offset"])
