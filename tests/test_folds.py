"""Sliced folds against the plain sequential fold."""

import random

import pytest
from pyspark.sql import functions as F

from plantpulse.operators import folds, trends
from plantpulse.operators.chunks import SLICE


def decay(state, z):
    """Forgets its start whenever z is low."""
    value = max(0.0, state[0] + z)
    return (value,), (value,)


def total(state, z):
    """Never forgets."""
    return (state[0] + z,), (state[0] + z,)


def sequential(rows, step):
    out, state = {}, {}
    for device, _, _, ts, z in sorted(rows):
        (out[device, ts],), state[device] = step(state.get(device, (0.0,)), z)
    return out


@pytest.fixture
def run(rows, monkeypatch):
    """Result of a sliced fold, and the number of rows of every table it wrote."""

    def fold_all(data, step, predicted):
        written = []
        original = folds.cut

        def counted(df, label):
            out = original(df, label)
            written.append((label, out.count()))
            return out

        monkeypatch.setattr(folds, "cut", counted)
        frame = rows(data, "device_id STRING, _slice BIGINT, _part BIGINT, _ts BIGINT, z DOUBLE").repartition(3)
        slices = sorted({r[:3] for r in data})
        entries = rows([(*s, float(predicted(s))) for s in slices], "device_id STRING, _slice BIGINT, _part BIGINT, _state DOUBLE")
        fold = folds.stepper(step, ["device_id", *SLICE], ["z"], ["_ts"], ["out"], ["_state"])
        schema = "device_id STRING, _slice BIGINT, _part BIGINT, _ts BIGINT, out DOUBLE, _state DOUBLE"
        done = folds.sliced(frame, entries, "device_id", ["_ts"], ["_state"], [0.0], fold, schema, "t")
        return {(r["device_id"], r["_ts"]): r["out"] for r in done.collect()}, written, done

    return fold_all


def series(device, slices, per, value):
    return [(device, s, 0, s * per + i, float(value(s, i))) for s in range(slices) for i in range(per)]


def ends(data, step):
    """The state at the start of each slice."""
    out, state = {}, {}
    for device, s, p, _, z in sorted(data):
        out.setdefault((device, s, p), state.get(device, (0.0,))[0])
        state[device] = step(state.get(device, (0.0,)), z)[1]
    return out


def test_right_predictions_read_nothing_twice(run):
    data = series("a", 20, 5, lambda s, i: 1)
    true = ends(data, total)
    got, written, _ = run(data, total, lambda s: true[s])
    assert got == sequential(data, total) and [n for n, _ in written] == ["t", "t-book"]


def test_one_wrong_slice_reads_only_that_until_the_states_meet(run):
    data = series("a", 40, 5, lambda s, i: -50 if i == 2 else 3) + series("b", 40, 5, lambda s, i: 1)
    true = ends(data, decay)
    got, written, _ = run(data, decay, lambda s: 999.0 if s[:2] == ("a", 7) else true[s])
    assert got == sequential(data, decay)
    # slice 7 is folded again, and then the two slices after it whose start is still open
    assert 5 <= sum(n for label, n in written if label == "t-again") <= 15


def test_a_fold_that_never_forgets_ends_in_log_rounds(run):
    data = series("a", 64, 3, lambda s, i: s + i) + series("b", 5, 3, lambda s, i: 1)
    got, written, done = run(data, total, lambda s: -1.0)
    assert got == sequential(data, total)
    assert sum(label == "t-again" for label, _ in written) <= 8
    assert done.count() == len(data)


def test_slices_before_the_wrong_one_stay(run):
    data = series("a", 30, 4, lambda s, i: 1)
    true = ends(data, total)
    got, written, _ = run(data, total, lambda s: true[s] + (s[1] >= 25))
    assert got == sequential(data, total)
    assert sum(n for label, n in written if label == "t-again") <= 4 * 5 * 2


def test_random_predictions(run):
    rng = random.Random(3)
    data = [(f"d{d}", s, p, s * 100 + p * 10 + i, rng.uniform(-3, 3)) for d in range(4) for s in range(12) for p in range(2) for i in range(rng.randint(1, 4))]
    got, _, _ = run(data, decay, lambda s: rng.choice([0.0, 5.0]))
    want = sequential(data, decay)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_cusum_with_every_start_predicted_wrong(spark, monkeypatch):
    rng = random.Random(1)
    base = spark.createDataFrame([(f"m{d}", 1773187200 + 3600 * i, rng.gauss(70, 5)) for d in range(3) for i in range(200)], "device_id STRING, s BIGINT, avg_temp_c DOUBLE")
    stats = base.select("device_id", F.timestamp_seconds("s").alias("window_start"), "avg_temp_c")
    want = sorted(map(tuple, trends.cusum(stats, slice_seconds=10**9).collect()))
    original = folds.sliced

    def spoiled(rows, entries, *rest):
        return original(rows, entries.withColumn("_up", F.lit(3.0)), *rest)

    monkeypatch.setattr(folds, "sliced", spoiled)
    assert sorted(map(tuple, trends.cusum(stats, slice_seconds=4 * 3600).collect())) == want
