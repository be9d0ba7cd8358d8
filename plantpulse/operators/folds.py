"""Ordered state machines over a key's rows, run slice by slice in parallel.

A fold carries a state from row to row. To spread one hot key over many tasks
its rows are cut into time slices and every slice starts from a predicted
state. The prediction is then checked against what the slices really ended
with, and the fold is repaired from the first wrong slice on until the states
meet again. The result is therefore always that of the plain sequential fold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.operators.chunks import SLICE
from plantpulse.session import cut


def ordered(df: DataFrame, keys: list[str], order: list[str], fold: Callable, schema: str) -> DataFrame:
    """Stream each key group, sorted, through ``fold`` (an iterator of Arrow batches).

    Sorting is Spark's external sort, so neither the sort nor the fold holds a
    group in memory.
    """
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(fold, schema)


def stepper(step: Callable, group: list[str], inputs: list[str], keep: list[str], outputs: list[str],
            state: list[str]) -> Callable:
    """Batch function that applies ``step(state, *inputs) -> (outputs, state)`` row by row.

    Rows with ``_kind`` = 0 are markers that set the starting state of their group.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = None
        for batch in batches:
            kinds = batch["_kind"].tolist()
            starts = list(zip(*[batch[c].tolist() for c in state]))
            values = list(zip(*[batch[c].tolist() for c in inputs]))
            produced, rows = [], []
            for i, kind in enumerate(kinds):
                if kind == 0:
                    current = starts[i]
                    continue
                out, current = step(current, *values[i])
                produced.append((*out, *current))
                rows.append(i)
            kept = batch.iloc[rows][group + keep].reset_index(drop=True)
            made = pd.DataFrame(produced, columns=outputs + state)
            yield pd.concat([kept, made], axis=1)

    return run


def _with_markers(data: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows and start states together: these travel as marker rows, so there is no join and no split group."""
    both = data.withColumn("_kind", F.lit(1)).unionByName(starts.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    # a NULL would turn an integer column into floats on the way through pandas
    return both.na.fill(0, [f.name for f in both.schema.fields if f.dataType.typeName() == "long"])


def sliced(rows: DataFrame, entries: DataFrame, key: str, order: list[str], state: list[str], initial: list,
           fold: Callable, schema: str, label: str) -> DataFrame:
    """Fold all slices from their predicted ``entries`` and repair wrong predictions.

    ``rows`` has the slice columns; ``entries`` has key, slice and the state
    columns for every slice; the fold's output has key, slice, the order
    columns and the state after each row.

    A book with one row per slice holds the state it was started from and the one it ended with. While some slice was
    not started from where the one before ended, the fold is done again from each wrong slice whose predecessor is not
    wrong, for one slice in the first round and for twice as many in each further one, up to the next such slice; all
    these at once. Slices beyond are not touched. So a fold that forgets its start reads few slices twice, and one that
    never does ends after log2(slices) rounds that read each slice about twice in all.
    """
    at = [key, *SLICE]
    folded = cut(ordered(_with_markers(rows, entries), at, ["_kind", *order], fold, schema), label)
    ends = F.max_by(F.struct(*state), F.struct(*order)).alias("_exit")
    book = folded.groupBy(*at).agg(ends).join(entries.select(*at, F.struct(*state).alias("_used")), at).withColumn("_round", F.lit(0))
    path = Window.partitionBy(key).orderBy(*SLICE)
    start = F.struct(*[F.lit(v).alias(c) for c, v in zip(state, initial)])
    rounds, reach = [folded], 1
    while True:
        judged = book.withColumns({"_needed": F.coalesce(F.lag("_exit").over(path), start), "_n": F.row_number().over(path)})
        judged = cut(judged.withColumn("_wrong", ~F.col("_used").eqNullSafe(F.col("_needed"))), f"{label}-book")
        if judged.where("_wrong").isEmpty():
            break
        first = F.col("_wrong") & ~F.coalesce(F.lag("_wrong").over(path), F.lit(False))
        heads = judged.withColumn("_first", first).withColumn("_head", F.max(F.when(F.col("_first"), F.col("_n"))).over(path.rowsBetween(Window.unboundedPreceding, 0)))
        todo = cut(heads.where(F.col("_n") - F.col("_head") < reach).select(*at, "_n", "_head", "_needed"), f"{label}-todo")
        markers = todo.where("_n = _head").select(*at, "_head", *[F.col("_needed")[c].alias(c) for c in state])
        again = ordered(_with_markers(rows.join(todo.select(*at, "_head"), at), markers), [key, "_head"], ["_kind", *SLICE, *order], fold, schema)
        rounds.append(cut(again, f"{label}-again"))
        # within a repaired stretch each slice was started from where the one before ended
        stretch = Window.partitionBy(key, "_head").orderBy(*SLICE)
        fresh = rounds[-1].groupBy(*at).agg(ends).join(todo, at)
        fresh = fresh.select(*at, F.struct(F.col("_exit"), F.coalesce(F.lag("_exit").over(stretch), "_needed").alias("_used"), F.lit(len(rounds) - 1).alias("_round")).alias("_new"))
        merged = judged.join(fresh, at, "left")
        book = merged.select(*at, *[F.when(F.col("_new").isNull(), F.col(c)).otherwise(F.col("_new")[c]).alias(c) for c in ("_exit", "_used", "_round")])
        reach *= 2
    if len(rounds) == 1:
        return folded
    out = rounds[0].withColumn("_round", F.lit(0))
    for i, more in enumerate(rounds[1:], 1):
        out = out.unionByName(more.withColumn("_round", F.lit(i)))
    return out.join(judged.select(*at, "_round"), [*at, "_round"], "left_semi").drop("_round")
