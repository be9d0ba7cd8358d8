"""Exact deduplication by a tree-merge of digest runs; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.runs import FAN_IN, LEAF_RUNS, leaf_run, merged_totals
from plantpulse.llm.text import ascii_lower
from plantpulse.session import cut


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", survivor: str = "smallest",
    normalise: Callable[[Column], Column] = ascii_lower, leaf_runs: int = LEAF_RUNS, fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document, dropped ones too: id, keep_id, group_size, kept, text_sha256.

    Every input partition makes a run of digests, one row for each digest with its smallest (or ``survivor="largest"``)
    identifier and number of rows. In each round run p passes its rows on to run p div ``fan_in``, where the runs of
    ``fan_in`` senders are merged, until one run is left; the survivors go back the same way. Texts are taken as equal
    when the SHA-256 and the length in bytes of the normalised text agree, which each merge verifies as both are keys.
    Only digests are exchanged, never texts, and a digest meets at most ``fan_in`` rows per round, however many copies
    it has.

    Null texts count as empty; empty texts are copies of each other. Rows without an identifier never survive against
    rows with one; in a group without any identifier all rows stay. Rows that repeat an identifier and a text are
    counted and share one fate. An empty table gives an empty result; other columns are not touched.
    """
    pick = F.min if survivor == "smallest" else F.max
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    keys = cut(docs.select(
        F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("sha"), F.octet_length(text).alias("octets"), leaf_run(leaf_runs).alias("run"),
    ), "dedup-digests")
    totals = {"keep_id": (pick("id"), pick), "group_size": (F.count(F.lit(1)), F.sum)}
    best = merged_totals(keys, "run", ["sha", "octets"], totals, leaf_runs=leaf_runs, fan_in=fan_in)
    return keys.join(best, ["run", "sha", "octets"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
