"""Hash-chain queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse import constants as C
from plantpulse import functions as fn
from plantpulse.operators import chain, quality
from plantpulse.plans.fixtures import half_up
from plantpulse.plans.registry import query
from plantpulse.sources import metrics


@query("hc1_message_hash", f"SELECT event_id, sha256(concat(content_seen, '{C.GENESIS_HASH}')) AS digest FROM unsigned_messages")
def _(t):
    return t.unsigned.select("event_id", fn.message_hash(fn.canonical_json("content_seen"), F.lit(C.GENESIS_HASH)).alias("digest"))


@query("hc5_sign_chain", "SELECT event_id, device_id, prev_hash, hash FROM signed_messages")
def _(t):
    return chain.sign_chain(t.unsigned).select("event_id", "device_id", "prev_hash", "hash")


_REASON = """CASE WHEN v.ok THEN ''
  WHEN s.prev_hash <> v.expected THEN concat('prev_hash_mismatch: declared=', substr(s.prev_hash, 1, 16), '… expected=', substr(v.expected, 1, 16), '…')
  ELSE concat('hash_mismatch: declared=', substr(s.hash, 1, 16), '… computed=', substr(sha256(concat(s.content_seen, s.prev_hash)), 1, 16), '…') END"""


@query("hc2_verify_chain", f"""
SELECT s.rn - 1 AS idx, s.device_id, s.event_id AS seq, v.ok, {_REASON} AS reason
FROM verified_messages v JOIN signed_messages s USING (device_id, rn)""")
def _(t):
    return t.verified.select("idx", "device_id", "seq", "ok", "reason")


@query("hc3_verify_message", """
SELECT event_id, prev_hash = expected AND hash = computed AS ok, CASE
    WHEN prev_hash <> expected THEN concat('prev_hash_mismatch: declared=', substr(prev_hash, 1, 16), '… expected=', substr(expected, 1, 16), '…')
    WHEN hash <> computed THEN concat('hash_mismatch: declared=', substr(hash, 1, 16), '… computed=', substr(computed, 1, 16), '…') ELSE '' END AS reason
FROM (SELECT *, sha256(concat(content_seen, prev_hash)) AS computed,
             CASE WHEN event_id % 7 = 3 THEN sha256(CAST(event_id AS VARCHAR)) ELSE prev_hash END AS expected FROM signed_messages)""")
def _(t):
    # every seventh message is held against another hash than the one it names
    expected = F.when(F.col("event_id") % 7 == 3, F.sha2(F.col("event_id").cast("string"), 256)).otherwise(F.col("prev_hash"))
    rows = t.signed.withColumn("expected", expected)
    return rows.select("event_id", fn.verify_message("content_seen", "prev_hash", "hash", "expected").alias("r")).select("event_id", "r.ok", "r.reason")


@query("win10_linkage", f"""
SELECT event_id, prev_hash = coalesce(lag(hash) OVER (PARTITION BY device_id ORDER BY event_id), '{C.GENESIS_HASH}') AS linked
FROM signed_messages""")
def _(t):
    return chain.linkage(t.signed.select("device_id", "event_id", "event_time", "prev_hash", "hash")).select("event_id", "linked")


_REPORT = f"""SELECT device_id, count(*) AS total, count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS invalid,
  {half_up('count(*) FILTER (WHERE ok) * CAST(100 AS DOUBLE) / count(*)', 2)} AS integrity_pct,
  min(rn - 1) FILTER (WHERE NOT ok) AS first_broken_at FROM verified_messages GROUP BY device_id"""


@query("agg24_hc4_integrity_report", _REPORT)
def _(t):
    return chain.integrity_report(t.verified)


@query("agg24_broken_at", "SELECT device_id, rn - 1 AS idx FROM verified_messages WHERE NOT ok")
def _(t):
    return chain.broken_at(t.verified)


@query("agg25_global_integrity", f"""
SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS invalid,
  {half_up('count(*) FILTER (WHERE ok) * CAST(100 AS DOUBLE) / count(*)', 2)} AS integrity_pct FROM verified_messages""")
def _(t):
    return chain.global_integrity(chain.integrity_report(t.verified))


_TAGGED = "CASE WHEN ok THEN 'ok' ELSE 'dlq' END"


def _tagged(t):
    return t.verified.withColumn("tag", F.when(F.col("ok"), "ok").otherwise("dlq"))


@query("snk3_tagged_sinks", f"SELECT {_TAGGED} AS tag, reason = '' AS clean, count(*) AS n FROM (SELECT v.ok, {_REASON} AS reason "
       "FROM verified_messages v JOIN signed_messages s USING (device_id, rn)) GROUP BY ALL")
def _(t):
    path = t.folder("tagged")
    metrics.write_tagged(_tagged(t).select("tag", "device_id", "reason"), path)
    back = t.spark.read.schema("device_id STRING, reason STRING, tag STRING").json(path)
    return back.groupBy("tag", (F.col("reason") == "").alias("clean")).agg(F.count(F.lit(1)).alias("n"))


@query("flt7_tag_filter", "SELECT device_id, event_id AS seq FROM verified_messages WHERE NOT ok")
def _(t):
    return _tagged(t).where("tag = 'dlq'").select("device_id", "seq")


@query("agg25_estimated_integrity", """
SELECT count(*) FILTER (WHERE ok) AS verified, count(*) FILTER (WHERE NOT ok) AS dlq,
  round(count(*) FILTER (WHERE ok) * CAST(100 AS DOUBLE) / count(*), 6) AS integrity_pct FROM verified_messages""")
def _(t):
    return quality.estimated_integrity(t.verified.where("ok"), t.verified.where("NOT ok"))
