"""Corpus pipeline: toxicity, line deduplication, near duplicates, benchmark decontamination, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.llm import toxicity
from plantpulse.llm.decontamination import decontaminate
from plantpulse.llm.jaccard_join import near_duplicates
from plantpulse.llm.line_dedup import line_dedup
from plantpulse.llm.packing import pack
from plantpulse.session import cut


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; others go. Empty and null texts stay."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_toxicity(docs.drop("toxicity"), model)
    return scored.filter(F.col("toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that one of a smaller identifier has; n_chars is counted anew."""
    kept = line_dedup(docs)
    return kept.select(*[F.length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, once.

    Texts without words have no shingles: of equal ones that aren't empty the smallest identifier stays. Empty and null
    texts are copies of nothing and stay. Of rows alike in identifier and text one stays, the smallest as JSON.
    """
    judged = cut(near_duplicates(docs).select("doc_id", "text_fp", "representative"), "judged")
    stays = judged.filter("representative").groupBy("doc_id", "text_fp").agg(F.count(F.lit(1)).alias("n"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    equal = stays.filter(F.col("text_fp") != F.xxhash64(F.lit(""))).groupBy("text_fp").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("ids"))
    copies = stays.join(equal.filter("ids > 1"), "text_fp").filter(~F.col("doc_id").eqNullSafe(F.col("first.doc_id")))
    keys = [F.col("doc_id").alias("_id"), F.col("text_fp").alias("_fp")]
    gone = cut(judged.filter(~F.col("representative")).select(*keys).union(copies.select(*keys)).distinct(), "gone")
    repeated = cut(stays.filter("n > 1").select(*keys), "repeated")

    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    fp = F.xxhash64(F.coalesce("doc.text", F.lit("")))
    same = F.col("doc.doc_id").eqNullSafe(F.col("_id")) & (fp == F.col("_fp"))
    rest = whole.join(gone.hint("shuffle_hash"), same, "left_anti")
    if repeated.isEmpty():
        return rest.select("doc.*")
    once = rest.join(repeated, same).groupBy("_id", "_fp").agg(F.min_by("doc", F.to_json("doc")).alias("doc")).select("doc")
    return rest.join(repeated, same, "left_anti").union(once).select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    judged = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return judged.filter(F.col("n_hit") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_documents),
]

#: Scores and tokens have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
