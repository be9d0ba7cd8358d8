"""Line deduplication across documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.runs import FAN_IN, LEAF_RUNS, leaf_run, merged_totals
from plantpulse.llm.text import ascii_lower
from plantpulse.session import cut

#: Stripped at both ends of a line: tab, line feed, vertical tab, form feed, carriage return, space.
BLANK = "\t\n\x0b\x0c\r "


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANK)))


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 10, max_documents: int = 1,
    leaf_runs: int = LEAF_RUNS, fan_in: int = FAN_IN,
) -> DataFrame:
    """``docs`` with the kept text in ``text_col`` and the new columns n_lines and n_dropped.

    Lines are exploded, normalised and hashed to 128 bits; of each hash the documents are counted. Lines of a key of at
    least ``min_length`` code points that more than ``max_documents`` documents hold go, but for those of the smallest
    identifier among them; every document is then put together from its other lines by position. Only hashes and
    positions are exchanged for the counts; hot lines are counted in a tree of runs (see runs.py). The texts move once,
    to meet the positions dropped from them.

    Null and empty texts are one empty line. Rows that repeat an identifier are one document. Rows without an identifier
    are one document that is larger than all others. A document that loses all lines stays, with an empty text. Extra
    columns are kept; n_lines and n_dropped replace columns of that name.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = [F.col(id_col).alias("_id"), F.xxhash64(text).alias("_fp")]
    lines = docs.select(*same, leaf_run(leaf_runs).alias("_run"), F.posexplode(F.split(text, "\n", -1)).alias("_pos", "_line"))
    keyed = lines.withColumn("_key", line_key(F.col("_line"))).filter(F.length("_key") >= min_length)
    hashed = cut(keyed.select("_id", "_fp", "_pos", "_run", F.xxhash64("_key").alias("_h"), F.xxhash64(F.lit(1), "_key").alias("_g")), "line-hashes")
    if max_documents == 1:
        # a key has two documents when its first and last one differ; null identifiers are one document, the last
        held = hashed
        totals = {"_first": (F.min("_id"), F.min), "_last": (F.max("_id"), F.max), "_none": (F.max(F.col("_id").isNull()), F.max)}
        many = (F.col("_first") < F.col("_last")) | (F.col("_none") & F.col("_first").isNotNull())
    else:
        # a document's rows belong to one run, so runs count each document once
        hashed = hashed.withColumn("_run", F.pmod(F.xxhash64("_id"), F.lit(leaf_runs)).cast("int"))
        held = hashed.select("_run", "_h", "_g", "_id").distinct()
        totals = {"_first": (F.min("_id"), F.min), "_n": (F.count(F.lit(1)), F.sum)}
        many = F.col("_n") > max_documents
    best = merged_totals(held, "_run", ["_h", "_g"], totals, many, leaf_runs, fan_in)
    gone = hashed.join(best, ["_run", "_h", "_g"]).filter(~F.col("_id").eqNullSafe(F.col("_first")))
    dropped = gone.groupBy("_id", "_fp").agg(F.collect_set("_pos").alias("_gone"))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"), *same)
    found = dropped.select(F.col("_id").alias("_of"), F.col("_fp").alias("_mark"), "_gone").hint("shuffle_hash")
    met = whole.join(found, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_fp") == F.col("_mark")), "left")
    text = F.coalesce(F.col(f"_doc.`{text_col}`"), F.lit(""))
    parts = F.split(text, "\n", -1)
    rest = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(F.transform(F.array_sort(rest), lambda i: F.get(parts, i)), "\n"))
    return met.select(
        *[kept.alias(c) if c == text_col else F.col(f"_doc.`{c}`") for c in names],
        F.size(parts).cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
