import hashlib
import random

import pytest
from pyspark.sql import functions as F

from plantpulse.constants import GENESIS_HASH
from plantpulse.operators import chain, chunks

SCHEMA = "device_id STRING, event_id BIGINT, s BIGINT, content STRING, prev_hash STRING, hash STRING"


def digest(content, prev):
    return hashlib.sha256((content + prev).encode()).hexdigest()


def signed(device, n, start=0, gap=60, prev=GENESIS_HASH, tag=""):
    out = []
    for i in range(n):
        content = f'{{"d": "{device}{tag}", "i": {i}}}'
        h = digest(content, prev)
        out.append([device, start + i, (start + i) * gap, content, prev, h])
        prev = h
    return out


def sequential(messages, initial=GENESIS_HASH):
    """Plain per-device walk in (time, sequence) order: the behaviour to match."""
    expected, state, position = {}, {}, {}
    for device, seq, s, content, prev, h in sorted(messages, key=lambda m: (m[0], m[2], m[1])):
        last, idx = state.get(device, initial), position.get(device, 0)
        prev_text, h_text = prev or "", h or ""
        ok = prev_text == last and h_text == digest(content, prev_text)
        reason = ""
        if prev_text != last:
            reason = f"prev_hash_mismatch: declared={prev_text[:16]}… expected={last[:16]}…"
        elif not ok:
            reason = f"hash_mismatch: declared={h_text[:16]}… computed={digest(content, prev_text)[:16]}…"
        expected[(device, seq)] = (idx, ok, reason)
        state[device], position[device] = (h if ok else last), idx + 1
    return expected


@pytest.fixture
def verify(spark):
    def run(messages, **kw):
        df = spark.createDataFrame([tuple(m) for m in messages], SCHEMA).repartition(5)
        df = df.withColumn("event_time", F.timestamp_seconds(F.lit(1773187200) + F.col("s")))
        return chain.verify_chain(df, **kw)

    return run


def as_dict(results):
    return {(r.device_id, r.seq): (r.idx, r.ok, r.reason) for r in results.collect()}


def check(verify, messages, **kw):
    kw.setdefault("max_rows", 15)
    got = as_dict(verify(messages, **kw))
    assert got == sequential(messages, **{k: v for k, v in kw.items() if k == "initial"})
    return [got[k][1] for k in sorted(got)]


def test_valid_chain_over_many_slices(verify):
    assert all(check(verify, signed("m", 300, gap=120)))


def test_tampered_message_breaks_the_rest(verify):
    messages = signed("m", 5)
    messages[2][3] = "changed"
    assert check(verify, messages) == [True, True, False, False, False]


def test_initial_hash_missing_fields_and_empty(verify, spark):
    messages = signed("m", 3, prev="a" * 64)
    assert check(verify, messages, initial="a" * 64) == [True] * 3
    assert check(verify, messages) == [False] * 3
    gone = [["m", 0, 0, "x", None, None]]
    assert check(verify, gone) == [False]
    assert verify([["m", 0, 0, "x", None, digest("x", GENESIS_HASH)]], missing_prev=GENESIS_HASH).first().ok
    assert verify([], ).count() == 0


def test_copies_forks_restarts(verify):
    base = signed("dup", 40, gap=300)
    # every message sent twice, the copy some time later
    copies = [[d, 1000 + q, s + 450, c, p, h] for d, q, s, c, p, h in base]
    # two senders under one name, and one that restarts its chain
    fork = signed("two", 30, gap=300) + [[d, 500 + q, s + 7, c, p, h] for d, q, s, c, p, h in signed("two", 30, gap=300, tag="b")]
    restart = signed("re", 20, gap=300) + signed("re", 20, start=20, gap=300)
    tampered = signed("t", 50, gap=200)
    tampered[25][3] = "changed"
    # the device resumes from the last accepted message
    resumed = tampered + signed("t", 20, start=60, gap=200, prev=tampered[24][5], tag="r")
    check(verify, base + copies + fork + restart + resumed)


def test_copy_that_came_before_its_parent(verify):
    # the first copy arrives too early to count, a later copy is the one accepted
    base = signed("m", 30, gap=600)
    early = [["m", 900, base[10][2] - 30, *base[20][3:]]]
    ok = check(verify, base + early)
    assert sum(ok) == 30


def test_random_mixes(verify):
    rng = random.Random(7)
    messages = []
    for d in range(6):
        rows = signed(f"m{d}", rng.randint(1, 60), gap=rng.choice([1, 100, 900]))
        for row in list(rows):
            roll = rng.random()
            if roll < 0.05:
                row[3] = "changed"
            elif roll < 0.15:
                rows.append([row[0], 5000 + row[1], row[2] + rng.randint(-1500, 1500), *row[3:]])
            elif roll < 0.18:
                rows.remove(row)
        messages += rows
    check(verify, messages)


def test_hot_device_is_split(verify, spark):
    messages = signed("hot", 2000, gap=30) + signed("cold", 10)
    df = spark.createDataFrame([tuple(m) for m in messages], SCHEMA).withColumn(
        "event_time", F.timestamp_seconds(F.lit(1773187200) + F.col("s")))
    slices = chunks.bounded_slices(df, "device_id", "event_time", "event_id", 150).groupBy("device_id", *chunks.SLICE).count()
    counts = slices.groupBy("device_id").agg(F.count("count").alias("n"), F.max("count").alias("largest")).collect()
    assert {r.device_id: (r.n > 10, r.largest <= 150) for r in counts} == {"hot": (True, True), "cold": (False, True)}
    assert all(check(verify, messages, max_rows=150))
    assert all(r.ok for r in verify(messages).collect())


def test_sign_then_verify(spark):
    df = spark.range(50).select(F.col("id").alias("event_id"), F.concat(F.lit("m"), F.col("id") % 3).alias("device_id"),
                                F.col("id").cast("string").alias("content"),
                                F.timestamp_seconds(F.lit(1773187200) + F.col("id") * 400).alias("event_time"))
    out = chain.sign_chain(df)
    by_device = {}
    for r in sorted(out.collect(), key=lambda r: r.event_id):
        prev = by_device.get(r.device_id, GENESIS_HASH)
        assert (r.prev_hash, r.hash) == (prev, digest(r.content, prev))
        by_device[r.device_id] = r.hash
    assert chain.verify_chain(out).where("ok").count() == 50
    assert chain.linkage(out).where("linked").count() == 50


@pytest.mark.parametrize("pattern, pct, first", [("TTTT", 100.0, None), ("TFTF", 50.0, 1), ("FF", 0.0, 0), ("T", 100.0, None), ("TTF", 66.67, 2)])
def test_integrity_report(rows, pattern, pct, first):
    df = rows([("m", i, c == "T") for i, c in enumerate(pattern)], "device_id STRING, idx BIGINT, ok BOOLEAN")
    report = chain.integrity_report(df).first()
    assert (report.total, report.valid, report.integrity_pct, report.first_broken_at) == (len(pattern), pattern.count("T"), pct, first)
    assert sorted(r.idx for r in chain.broken_at(df).collect()) == [i for i, c in enumerate(pattern) if c == "F"]


def test_integrity_of_nothing(rows):
    df = rows([], "device_id STRING, idx BIGINT, ok BOOLEAN")
    assert chain.global_integrity(chain.integrity_report(df)).first().asDict() == {
        "total": 0, "valid": 0, "invalid": 0, "integrity_pct": 0.0}


def test_slices_stay_bounded_under_copies(verify, spark):
    """A third of all rows are copies of one message at one time; no slice may exceed the limit."""
    messages = signed("hot", 200, gap=10) + signed("cold", 100, gap=10)
    messages += [[d, 10_000 + i, s, c, p, h] for i in range(150) for d, q, s, c, p, h in [messages[50]]]
    df = spark.createDataFrame([tuple(m) for m in messages], SCHEMA).withColumn(
        "event_time", F.timestamp_seconds(F.lit(1773187200) + F.col("s")))
    sizes = chunks.bounded_slices(df, "device_id", "event_time", "event_id", max_rows=40).groupBy("device_id", *chunks.SLICE).count()
    assert sizes.agg(F.max("count"), F.sum("count")).first() == (40, 450)
    check(verify, messages, max_rows=40)
    full, small = (chain.linkage(df, max_rows=m).select("device_id", "event_id", "linked") for m in (10**6, 40))
    assert small.exceptAll(full).count() == 0 and small.count() == 450


def test_devices_are_not_walked(verify):
    """The plan has neither Python workers nor a window over a whole device's messages."""
    plan = verify(signed("m", 20))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan


def test_pointers_double(spark, monkeypatch):
    """A chain over many slices is followed in as many rounds as its length has binary digits."""
    rounds = []
    original = chain.cut
    monkeypatch.setattr(chain, "cut", lambda df, label: rounds.append(label) or original(df, label))
    runs = spark.createDataFrame([("m", i, i + 1 if i < 99 else None, True if i == 0 else None) for i in range(100)] + [("n", 0, None, True), ("o", 5, 6, None), ("o", 6, None, None)],
                                 "device_id STRING, _run BIGINT, _next BIGINT, _start BOOLEAN")
    got = {tuple(r) for r in chain._accepted_runs(runs).collect()}
    assert got == {("m", i) for i in range(100)} | {("n", 0)}
    assert rounds.count("chain-marked") == 8


def test_null_device_order_ties_and_copies_at_one_time(verify):
    base = signed("m", 20, gap=60)
    same = [[*m] for m in base for _ in range(3)]
    for i, m in enumerate(same):
        m[1] = i
    check(verify, same + [["x", 0, 0, None, None, None]])
