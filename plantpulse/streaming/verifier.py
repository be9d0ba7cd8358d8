"""Keyed streaming hash-chain verification."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from plantpulse.constants import CHAIN_BAD_HASH, CHAIN_BAD_JSON, CHAIN_BAD_PREV, GENESIS_HASH, UNSIGNED_FIELDS
from plantpulse.operators import folds
from plantpulse.sources.metrics import write_tagged
from plantpulse.streaming.ledger import Ledger

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A message reduced to what its chain needs: the hash it names as previous, its own, and the one its content gives.
LINKS = "key STRING, seq BIGINT, value STRING, readable BOOLEAN, prev STRING, declared STRING, computed STRING"
#: A message with the verdict: no reason if it is in order, and the hash it should have had.
VERDICTS = "key STRING, seq BIGINT, value STRING, reason STRING, expected STRING"


def links(text: str | None) -> tuple[bool, str, str, str]:
    """(readable, prev, declared, computed) of one raw message. Hashes that are no text equal no hash."""
    try:
        message = json.loads(text)
    except (TypeError, ValueError):
        message = None
    if not isinstance(message, dict):
        return False, "", "", ""
    prev, declared = message.get("prev_hash", GENESIS_HASH), message.get("hash", "")
    if not isinstance(prev, str):
        return True, "", "", ""
    signed = json.dumps({k: v for k, v in message.items() if k not in UNSIGNED_FIELDS}, sort_keys=True)
    return True, prev, declared if isinstance(declared, str) else "", hashlib.sha256((signed + prev).encode()).hexdigest()


def judge(last: str, readable: bool, prev: str, declared: str, computed: str) -> tuple[str | None, str | None, str]:
    """(reason, expected hash, last valid hash afterwards) of one message, given the last valid hash before it."""
    if not readable:
        return CHAIN_BAD_JSON, None, last
    if prev != last:
        return CHAIN_BAD_PREV, last, last
    if declared != computed:
        return CHAIN_BAD_HASH, computed, last
    return None, None, declared


def payload(text: str | None, reason: str | None, expected: str | None) -> str | None:
    """The message itself, or its dead letter."""
    if reason is None:
        return text
    if reason == CHAIN_BAD_JSON:
        return json.dumps({"raw": text, "reason": reason})
    named = {CHAIN_BAD_PREV: "expected_prev", CHAIN_BAD_HASH: "expected_hash"}[reason]
    return json.dumps({**json.loads(text), "reason": reason, named: expected})


def check(text: str | None, last: str) -> tuple[str, str | None, str]:
    """(tag, payload, last valid hash afterwards) of one raw message; a null record is a dead letter."""
    reason, expected, after = judge(last, *links(text))
    return "ok" if reason is None else "dlq", payload(text, reason, expected), after


def _texts(column: pd.Series) -> list[str | None]:
    return [v if isinstance(v, str) else None for v in column.tolist()]


def linked_messages(records: DataFrame, seq: str | None = None) -> DataFrame:
    """Raw records parsed and hashed where they are read, before any shuffle; see ``LINKS``.

    ``seq`` orders the messages of a device (the topic offset; for other sources any growing column or SQL expression).
    """
    text = F.col("value").cast("string")
    keyed = records.select(
        F.coalesce(F.get_json_object(text, "$.device_id"), F.lit("unknown")).alias("key"),
        (F.expr(seq) if seq else F.col("offset")).cast("bigint").alias("seq"), text.alias("value"))

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = pd.DataFrame([links(v) for v in _texts(frame["value"])], columns=["readable", "prev", "declared", "computed"], index=frame.index)
            yield pd.concat([frame, found], axis=1)

    return keyed.mapInPandas(parse, LINKS)


def tagged(verdicts: DataFrame) -> DataFrame:
    """key, seq, tag, payload of judged messages; dead letters are written out after the state has been left."""

    @F.pandas_udf("string")
    def letters(text: pd.Series, reason: pd.Series, expected: pd.Series) -> pd.Series:
        return pd.Series([payload(*v) for v in zip(_texts(text), _texts(reason), _texts(expected))])

    return verdicts.select("key", "seq", F.when(F.col("reason").isNull(), "ok").otherwise("dlq").alias("tag"), letters("value", "reason", "expected").alias("payload"))


class ChainVerifier(StatefulProcessor):
    """Keeps the last valid hash of one device; messages come parsed and hashed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last_valid_hash", "hash STRING")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        stored = self._last.get()
        last = stored[0] if stored is not None else GENESIS_HASH
        # one micro-batch of one device in no order; ``verify_topic`` takes devices of any size
        arrived = pd.concat(list(rows)).sort_values("seq", kind="stable")
        verdicts = []
        for values in zip(*[arrived[c].tolist() for c in ("readable", "prev", "declared", "computed")]):
            reason, expected, last = judge(last, *values)
            verdicts.append((reason, expected))
        self._last.update((last,))
        reasons, expected = zip(*verdicts)
        yield pd.DataFrame({"key": key[0], "seq": arrived["seq"].to_numpy(), "value": _texts(arrived["value"]), "reason": reasons, "expected": expected})

    def close(self) -> None:
        pass


def verify_stream(records: DataFrame, seq: str | None = None) -> DataFrame:
    """Tag every raw message ``ok`` or ``dlq``. Rows: key, seq, tag, payload.

    The last valid hash of a device is in Spark's state store (RocksDB, see ``use_state_store``). The messages of one
    device in one micro-batch are sorted in memory; the source's per-trigger limit bounds them.
    """
    return tagged(linked_messages(records, seq).groupBy("key").transformWithStateInPandas(
        statefulProcessor=ChainVerifier(), outputStructType=VERDICTS, outputMode="Append", timeMode="None"))


def judged_batch(linked: DataFrame, last: DataFrame | None) -> DataFrame:
    """Verdicts of a batch of linked messages, with ``hash``, the last valid hash after each, and ``n``, its place in its device.

    ``last`` has the hash (key, hash) each device starts from. Messages are sorted by Spark, which spills, and pass in that
    order through a fold that holds one hash; so a device of any size takes one chunk of memory.
    """
    marked = linked.withColumn("_kind", F.lit(1))
    if last is not None:
        known = last.join(linked.select("key").distinct(), "key", "left_semi")
        marked = marked.unionByName(known.select("key", F.col("hash").alias("prev"), F.lit(0).alias("_kind")), allowMissingColumns=True)
    marked = marked.na.fill(0, ["seq"]).na.fill(False, ["readable"])

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        device, last_hash, n = None, GENESIS_HASH, 0
        for frame in frames:
            out = []
            values = zip(*[frame[c].tolist() for c in ("key", "_kind", "seq", "value", "readable", "prev", "declared", "computed")])
            for key, kind, seq, value, *rest in values:
                if key != device:
                    device, last_hash, n = key, GENESIS_HASH, 0
                if kind == 0:
                    last_hash = rest[1]
                    continue
                reason, expected, last_hash = judge(last_hash, *rest)
                n += 1
                out.append((key, seq, value if isinstance(value, str) else None, reason, expected, last_hash, n))
            yield pd.DataFrame(out, columns=["key", "seq", "value", "reason", "expected", "hash", "n"])

    return folds.ordered(marked, ["key"], ["_kind", "seq"], walk, VERDICTS + ", hash STRING, n BIGINT")


def verify_topic(records: DataFrame, path: str, checkpoint: str, seq: str | None = None, interval: str | None = None) -> StreamingQuery:
    """Write every raw message of a stream to ``tag=ok`` or ``tag=dlq`` below ``path``, one folder per micro-batch.

    The tags are those of ``verify_stream``. The last valid hashes lie in ``path``/_hashes as a ``Ledger``, of which a
    micro-batch reads the devices it has messages of. Each message is parsed and hashed before the shuffle, and a device
    is consumed in the order of ``seq`` chunk by chunk, so neither a device nor a first micro-batch over a long backlog
    has to fit in memory.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        hashes = Ledger(batch.sparkSession, f"{path}/_hashes", "key")
        verdicts = judged_batch(linked_messages(batch, seq), hashes.before(batch_id))
        folder = f"{path}/_verdicts/batch={batch_id}"
        verdicts.write.mode("overwrite").parquet(folder)
        written = batch.sparkSession.read.parquet(folder)
        write_tagged(tagged(written), f"{path}/batch={batch_id}", "overwrite")
        hashes.write(batch_id, written.groupBy("key").agg(F.max_by("hash", "n").alias("hash")))
        at = batch.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(batch.sparkSession._jsc.hadoopConfiguration()).delete(at, True)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each).trigger(**trigger).start()


def use_state_store(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
