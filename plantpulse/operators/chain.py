"""Hash-chain signing, verification and integrity reports."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.constants import GENESIS_HASH
from plantpulse.functions import clip, message_hash, round_half_up
from plantpulse.operators import chunks, folds
from plantpulse.operators.chunks import SLICE
from plantpulse.session import cut


def sign_chain(df: DataFrame, content: str = "content", key: str = "device_id", order: tuple[str, ...] = ("event_id",),
               initial: str = GENESIS_HASH) -> DataFrame:
    """Add ``prev_hash`` and ``hash`` to ordered messages.

    Every hash needs the one before it, so a device is signed by one task; the
    rows stream through it and only the last hash is held.
    """
    names = df.columns

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        device, last = None, initial
        for batch in batches:
            before, after = [], []
            for name, text in zip(batch[key].tolist(), batch[content].tolist()):
                if name != device:
                    device, last = name, initial
                before.append(last)
                last = hashlib.sha256((text + last).encode()).hexdigest()
                after.append(last)
            yield batch.assign(prev_hash=before, hash=after)[[*names, "prev_hash", "hash"]]

    schema = df.select(*names, F.lit("").alias("prev_hash"), F.lit("").alias("hash")).schema
    return folds.ordered(df, [key], list(order), sign, schema)


def linkage(df: DataFrame, key: str = "device_id", ts: str = "event_time", seq: str = "event_id",
            initial: str = GENESIS_HASH, max_rows: int = chunks.MAX_ROWS) -> DataFrame:
    """Whether each declared prev_hash equals the hash declared one row earlier."""
    extended = chunks.with_halo(chunks.bounded_slices(df, key, ts, seq, max_rows=max_rows), key, [ts, seq], 1)
    previous = F.coalesce(F.lag("hash").over(chunks.slice_window(key, [ts, seq])), F.lit(initial))
    return chunks.without_halo(extended.withColumn("linked", F.col("prev_hash") == previous))


def _numbered(rows: DataFrame) -> DataFrame:
    """``_pos`` from 1 within (device, slice) and ``_at`` = (slice, part, position), an order of a device's rows."""
    order = Window.partitionBy("device_id", *SLICE).orderBy("_ts", "_seq", "_declared", "_prev", "_computed")
    return rows.withColumn("_pos", F.row_number().over(order)).withColumn("_at", F.struct(*SLICE, "_pos"))


def _followers(own: DataFrame) -> DataFrame:
    """``own`` with ``_next``: the place of the first later message that names this one's hash as its previous.

    Messages meet by hash within a slice; for the rest a table with one row per hash and slice is searched. So copies of
    one message, however many, meet only within their slice.
    """
    keys = ["device_id", "_link"]
    sides = F.array(F.struct(F.col("_declared").alias("_link"), F.lit(True).alias("_asks")),
                    F.struct(F.col("_prev").alias("_link"), F.lit(False).alias("_asks")))
    met = own.select("device_id", *SLICE, "_at", F.inline(sides)).withColumn("_child", F.when(~F.col("_asks"), F.col("_at")))
    # newest first, so that the last child seen is the nearest later one
    later = Window.partitionBy(*keys, *SLICE).orderBy(F.col("_at").desc(), F.col("_asks").desc()).rowsBetween(Window.unboundedPreceding, -1)
    inside = met.withColumn("_near", F.last("_child", ignorenulls=True).over(later)).where("_asks")
    firsts = met.groupBy(*keys, *SLICE).agg(F.min("_child").alias("_child"))
    beyond = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in SLICE]).rowsBetween(Window.unboundedPreceding, -1)
    far = firsts.withColumn("_far", F.last("_child", ignorenulls=True).over(beyond)).where("_far IS NOT NULL").drop("_child")
    linked = inside.join(far, [*keys, *SLICE], "left")
    return linked.select("device_id", *SLICE, "_at", F.coalesce("_near", "_far").alias("_next"))


def _runs(own: DataFrame, initial: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their run, runs): stretches of a slice in which each message's follower is the next one.

    A message starts a run if the one before doesn't lead to it, or another one does, or a chain may start with it.
    A run is thus entered at its head only; ``_next`` of a run is that of its last message.
    """
    linked = cut(_followers(own), "chain-followers")
    window = Window.partitionBy("device_id", *SLICE).orderBy("_at")
    stepped = linked.withColumns({"_before": F.lag("_at").over(window), "_led": F.lag("_next").over(window), "_after": F.lead("_at").over(window)})
    starts = own.where(F.col("_prev") == initial).groupBy("device_id").agg(F.min("_at").alias("_at")).withColumn("_start", F.lit(True))
    jumps = stepped.where("_next IS NOT NULL AND NOT _next <=> _after").select("device_id", F.col("_next").alias("_at"))
    entered = jumps.unionByName(starts.select("device_id", "_at")).distinct().withColumn("_entered", F.lit(True))
    heads = stepped.join(entered, ["device_id", "_at"], "left").withColumn("_head", F.when(F.col("_entered") | ~F.col("_led").eqNullSafe(F.col("_at")), F.col("_at")))
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    members = cut(heads.select("device_id", "_at", "_next", F.last("_head", ignorenulls=True).over(upto).alias("_run")), "chain-members")
    runs = members.groupBy("device_id", "_run").agg(F.max_by("_next", "_at").alias("_next"))
    return members, cut(runs.join(starts.withColumnRenamed("_at", "_run"), ["device_id", "_run"], "left"), "chain-runs")


def _accepted_runs(runs: DataFrame) -> DataFrame:
    """The runs each device's chain passes through, by pointer jumping.

    Marks begin at the first run. In round k every marked run also marks the one 2 ** k runs on, and all pointers
    are then doubled, so a chain over n runs is followed in log2(n) rounds, all devices at once.
    """
    marked = runs.where("_start").select("device_id", "_run")
    pointers = runs.where("_next IS NOT NULL").select("device_id", "_run", "_next")
    while True:
        fresh = cut(marked.join(pointers, ["device_id", "_run"]).select("device_id", F.col("_next").alias("_run")), "chain-marked")
        if fresh.isEmpty():
            return marked
        marked = marked.unionByName(fresh)
        onward = pointers.select("device_id", F.col("_run").alias("_next"), F.col("_next").alias("_beyond"))
        pointers = cut(pointers.join(onward, ["device_id", "_next"]).select("device_id", "_run", F.col("_beyond").alias("_next")), "chain-pointers")


def verify_chain(df: DataFrame, initial: str = GENESIS_HASH, missing_prev: str = "", canonical: str = "content",
                 ts: str = "event_time", seq: str = "event_id", max_rows: int = chunks.MAX_ROWS) -> DataFrame:
    """Sequential chain verification of every device, one result row per message.

    A message is accepted when its hash is right and it names the hash of the message accepted before it. The
    follower of an accepted message is thus the first later one with a right hash that names it, which is a
    property of the messages and not of the walk: followers are found by joins, stretches of followers are
    contracted to runs, and the runs on the way from the first message are found by pointer jumping. No device is
    walked row by row, and no slice holds more than ``max_rows`` messages.
    """
    prev = F.coalesce(F.col("prev_hash"), F.lit(missing_prev))
    declared = F.coalesce(F.col("hash"), F.lit(""))
    # messages without a usable time come first
    at = F.coalesce(F.col(ts).cast("timestamp"), F.timestamp_seconds(F.lit(0)))
    rows = df.select(
        "device_id", at.alias("_when"), F.unix_micros(at).alias("_ts"),
        F.col(seq).cast("bigint").alias("_seq"), prev.alias("_prev"), declared.alias("_declared"),
        message_hash(canonical, prev).alias("_computed"),
    ).withColumn("_own_ok", F.coalesce(F.col("_declared") == F.col("_computed"), F.lit(False)))
    sliced = chunks.bounded_slices(rows, "device_id", "_when", "_seq", max_rows).drop("_when")
    # read by the jobs below; the written rows also survive lost executors
    rows = cut(_numbered(sliced), "chain-rows")

    members, runs = _runs(rows.where("_own_ok"), initial)
    accepted = members.join(_accepted_runs(runs), ["device_id", "_run"]).select("device_id", "_at", F.lit(True).alias("_ok"))
    judged = rows.join(accepted, ["device_id", "_at"], "left").withColumn("ok", F.coalesce("_ok", F.lit(False)))
    judged = cut(judged.drop("_ok", "_own_ok", "_at"), "chain-judged")

    valid = F.when(F.col("ok"), F.col("_declared"))
    slices = judged.groupBy("device_id", *SLICE).agg(F.count(F.lit(1)).alias("_n"), F.max_by(valid, F.when(F.col("ok"), F.col("_pos"))).alias("_end"))
    before = chunks.before("device_id")
    entries = slices.select(
        "device_id", *SLICE, F.coalesce(F.last("_end", ignorenulls=True).over(before), F.lit(initial)).alias("_state"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("device_id", *SLICE).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    checked = judged.withColumn("_last", F.last(valid, ignorenulls=True).over(inside)).join(entries, ["device_id", *SLICE])
    checked = checked.withColumn("_expected", F.coalesce("_last", "_state"))
    reason = (
        F.when(F.col("_prev") != F.col("_expected"),
               F.concat(F.lit("prev_hash_mismatch: declared="), clip("_prev", 16), F.lit(" expected="), clip("_expected", 16)))
        .when(~F.col("ok"),
              F.concat(F.lit("hash_mismatch: declared="), clip("_declared", 16), F.lit(" computed="), clip("_computed", 16)))
        .otherwise("")
    )
    return checked.select((F.col("_first") + F.col("_pos") - 1).cast("bigint").alias("idx"), "device_id", F.timestamp_micros("_ts").alias("ts"),
                          F.col("_seq").alias("seq"), "ok", reason.alias("reason"))


def integrity_report(results: DataFrame, key: str = "device_id") -> DataFrame:
    """Totals per device. The failing positions are rows of their own: ``broken_at``."""
    total, valid = F.count(F.lit(1)), F.count_if("ok")
    return results.groupBy(key).agg(
        total.alias("total"), valid.alias("valid"), F.count_if(~F.col("ok")).alias("invalid"),
        round_half_up(valid * 100.0 / total, 2).alias("integrity_pct"),
        F.min(F.when(~F.col("ok"), F.col("idx"))).alias("first_broken_at"))


def broken_at(results: DataFrame, key: str = "device_id") -> DataFrame:
    """All failing positions, one row each (a list per device would not fit a hot device)."""
    return results.where(~F.col("ok")).select(key, "idx")


def global_integrity(report: DataFrame) -> DataFrame:
    """Fleet totals; 0 percent for an empty fleet."""
    total, valid = F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("valid"), F.lit(0))
    pct = F.coalesce(F.try_divide(valid * 100.0, total), F.lit(0.0))
    return report.agg(total.alias("total"), valid.alias("valid"), (total - valid).alias("invalid"),
                      round_half_up(pct, 2).alias("integrity_pct"))
