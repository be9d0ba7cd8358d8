"""Personal data and secrets against plain Python."""

import math
import random
import time

import pytest

from plantpulse.llm import pii, secrets
from plantpulse.llm.text import overlapping, running_sum
from pyspark.sql import functions as F
from tests.llm import brute

DOCS = "doc_id long, text string, base string, spans int, _row int"


def test_running_sum(spark, rows):
    data = [(list(range(n)),) for n in (0, 1, 511, 512, 513, 2000)]
    got = rows(data, "x array<int>").select("x", running_sum(F.col("x")).alias("s")).collect()
    assert all(r.s == [sum(r.x[: i + 1]) for i in range(len(r.x))] for r in got)


def noise(rng, parts, n):
    return "".join(rng.choice(parts) for _ in range(n))


PII_PARTS = ["a", "Z", "9", "1", "@", ".", "-", "+", " ", "(", ")", "_", "%", "\n", "é", "𝒳", "a@b.c", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "foo@", ".5"]
SECRET_PARTS = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", ":", "=", " ", '"', "'", "abc", "deadbeef", "0123", "AKIA", "ABCDEFGH12345678", "x", "\n", "𝒳", ".", "/", "Z"]


@pytest.mark.parametrize("parts, find, digest, wanted", [
    (PII_PARTS, pii.find_pii, pii.pii_digest, brute.pii), (SECRET_PARTS, secrets.scan_secrets, secrets.secret_digest, brute.secrets),
])
def test_base_spans(spark, rows, parts, find, digest, wanted):
    rng = random.Random(3)
    data = [(i, noise(rng, parts, rng.randrange(0, 60)), "b", 1, 2) for i in range(400)] + [(400, None, "b", 1, 2), (401, "", "b", 1, 2)]
    got = {r.doc_id: r for r in digest(find(rows(data, DOCS))).collect()}
    for i, t, *_ in data:
        spans = wanted(t)
        assert got[i].base_sha256 == brute.sha(brute.joined(spans)), (t, got[i].spans)
        base, every = set(brute.joined(spans).split(",")), set(got[i].spans.split(","))
        assert base <= every or not spans
    assert sum(len(wanted(t)) for _, t, *_ in data) > 100


def test_very_long_runs_take_linear_time(spark, rows):
    long = ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 150_000, "1 " * 150_000, "deadbeef" * 40_000, "password" + " " * 300_000]
    data = [(i, t, "", 0, 0) for i, t in enumerate(long)]
    counts = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.pii_digest(pii.find_pii(rows(data, DOCS))).collect()}
    assert counts == {i: ((0, 0, 0, 0) if i != 2 else (0, 37_500, 0, 0)) for i in range(8)}
    assert {r.doc_id: r.n_hex for r in secrets.secret_digest(secrets.scan_secrets(rows(data, DOCS))).collect()}[6] == 1


def test_contexts_discover_identifiers(spark, rows):
    data = [(i, f"Reach us: mail me at user{i}@host{i}.org today. Version two of 3.1 was out.", "", 0, 0) for i in range(12)]
    data += [(50, "You can mail me at joe(at)site9 now", "", 0, 0), (51, "she paid two of 77777 coins", "", 0, 0), (52, "mail me at noon5x", "", 0, 0)]
    got = {r.doc_id: r for r in pii.pii_digest(pii.find_pii(rows(data, DOCS))).collect()}
    assert got[50].spans == "email:19:31" and got[50].n_email == 0  # not among the base spans
    assert got[51].spans == "" and got[52].spans == "email:11:17"
    assert got[3].spans == got[3].spans and got[3].n_email == 1 and got[3].spans.count(":") == 2


def test_discovered_identifiers_make_patterns(spark, rows):
    data = [(i, f"mail me at user{i}@host{i}.org", "", 0, 0) for i in range(12)]
    data += [(20 + i, f"mail me at joe{i}(at)site", "", 0, 0) for i in range(6)]
    # no seed stands behind "ping us on", only values found behind "mail me at" do
    data += [(30 + i, f"ping us on joe{i}(at)site", "", 0, 0) for i in range(6)]
    data += [(40, "ping us on ann7(at)site", "", 0, 0), (41, "joe3(at)site", "", 0, 0), (42, "- 55 joe3(at)site, 1 of 77777", "", 0, 0)]
    got = {r.doc_id: r.spans for r in pii.pii_digest(pii.find_pii(rows(data, DOCS))).collect()}
    assert got[33] == "email:11:23" and got[40] == "email:11:23"
    assert got[41] == "email:0:12" and got[42] == "email:5:17"


def test_one_word_at_a_lines_start_is_a_pattern(spark, rows):
    data = [(i, f"Notes\nEmail: user{i}@host{i}.org\nsome Email: x", "", 0, 0) for i in range(6)]
    data += [(20, "Email: joe(at)site9", "", 0, 0), (21, "a\n\n* email: ann(at)site8", "", 0, 0), (22, "1 22 email: bob(at)site7", "", 0, 0)]
    got = {r.doc_id: r.spans for r in pii.pii_digest(pii.find_pii(rows(data, DOCS))).collect()}
    assert got[20] == "email:7:19" and got[21] == "email:12:24" and got[22] == ""


def test_repeated_rows_and_empty_tables(spark, rows):
    data = [(1, "a@b.co", "", 0, 0), (1, "a@b.co", "", 0, 0), (None, "a@b.co", "", 0, 0)]
    assert [r.n_email for r in pii.pii_digest(pii.find_pii(rows(data, DOCS))).collect()] == [1, 1, 1]
    assert pii.find_pii(rows([], DOCS)).count() == 0 and secrets.scan_secrets(rows([], DOCS)).count() == 0


def entropy(s):
    return -sum(s.count(c) / len(s) * math.log2(s.count(c) / len(s)) for c in set(s))


def test_windows_are_counted_incrementally(spark, rows):
    rng = random.Random(8)
    data = [("".join(rng.choice("ab1c2d3e4f") if rng.random() < 0.7 else "a" for _ in range(rng.randrange(16, 60))),) for _ in range(60)]
    got = rows(data, "v string").withColumn("c", secrets.codes_of(F.col("v"))).select("v", secrets.hot_range(F.col("c"), 16, F.lit(2.7)).alias("r")).collect()
    for r in got:
        hot = [i for i in range(len(r.v) - 15) if entropy(r.v[i : i + 16]) >= 2.7 - 1e-9]
        clear = [i for i in range(len(r.v) - 15) if abs(entropy(r.v[i : i + 16]) - 2.7) > 1e-6]
        if len(clear) == len(r.v) - 15:
            assert (r.r.lo, r.r.hi) == ((hot[0], hot[-1] + 16) if hot else (0, 0))


def test_entropy_scan_and_allow_list(spark, rows):
    data = [
        (1, "key q9Zx7Lm2Vb8Tn4Kc1Wp6 end", "", 0, 0), (2, "id 123e4567-e89b-12d3-a456-426614174000", "", 0, 0), (3, "z1zzzzzzzzzzzzzzzzzzzzzzzzzz", "", 0, 0),
        (4, "q9Zx7Lm2Vb8Tn4Kc1Wp6EXAMPLE", "", 0, 0), (5, "token=q9Zx7Lm2Vb8Tn4Kc1Wp6", "", 0, 0),
    ]
    got = {r.doc_id: r.spans for r in secrets.secret_digest(secrets.scan_secrets(rows(data, DOCS))).collect()}
    assert got == {1: "entropy:4:24", 2: "", 3: "", 4: "", 5: "assign:0:26"}


def test_secrets_beside_known_and_allowed_parts(spark, rows):
    key = "q9Zx7Lm2Vb8Tn4Kc1Wp6"
    data = [
        (1, f"/keys/{key}/d41d8cd98f00b204e9800998ecf8427e", "", 0, 0), (2, f"/example/{key}", "", 0, 0), (3, f"d41d8cd98f00b204e9800998ecf8427e/{key}=sample", "", 0, 0),
        (4, f"/keys/{key}EXAMPLE/readme", "", 0, 0), (5, "2024/12/31/23/59/59/17/38/46/52", "", 0, 0), (6, "id=123e4567-e89b-12d3-a456-426614174000", "", 0, 0),
    ]
    got = {r.doc_id: r.spans.split(",") for r in secrets.secret_digest(secrets.scan_secrets(rows(data, DOCS))).collect()}
    for i, text, *_ in data[:3]:
        at = text.index(key)
        spans = [tuple(map(int, x.split(":")[1:])) for x in got[i] if x.startswith("entropy")]
        assert len(spans) == 1 and spans[0][0] <= at + 2 and spans[0][1] >= at + 18, (text, got[i])
    assert got[1][-1].startswith("hex:") and got[3][0] == "hex:0:32"
    assert got[4] == got[5] == got[6] == [""]


def test_long_random_strings_take_linear_time(spark, rows):
    """A candidate of 200,000 characters is scanned in seconds."""
    rng = random.Random(5)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    text = "".join(rng.choice(alphabet) for _ in range(200_000))
    started = time.monotonic()
    got = secrets.secret_digest(secrets.scan_secrets(rows([(1, text, "", 0, 0)], DOCS))).first()
    assert time.monotonic() - started < 60
    start, end = map(int, got.spans.split("entropy:")[1].split(",")[0].split(":"))
    assert start < 50 and end > 199_950


def test_many_identifiers_in_one_text(spark, rows):
    """20,000 matches and as many words or candidates beside them: neither is held against all of the others."""
    mails = " ".join(f"u{i}@h{i}.org id{i:07d}" for i in range(20_000))
    started = time.monotonic()
    got = pii.pii_digest(pii.find_pii(rows([(1, mails, "", 0, 0)], DOCS))).first()
    assert got.n_email == 20_000 and time.monotonic() - started < 90
    rng = random.Random(6)
    keys = " ".join(f"{rng.getrandbits(128):032x}" for i in range(20_000))
    started = time.monotonic()
    got = secrets.secret_digest(secrets.scan_secrets(rows([(1, keys, "", 0, 0)], DOCS))).first()
    assert got.n_hex == 20_000 and got.spans.count("entropy") == 0 and time.monotonic() - started < 90


def test_overlapping_is_what_a_scan_finds(spark, rows):
    rng = random.Random(7)
    data = []
    for _ in range(200):
        at, spans = 0, []
        for _ in range(rng.randrange(0, 12)):
            at += rng.randrange(0, 6)
            spans.append((at, at + rng.randrange(3, 9)))
            at = spans[-1][1]
        start = rng.randrange(0, 60)
        data.append((spans, start, start + rng.randrange(1, 30)))
    frame = rows(data, "s array<struct<start:int,end:int>>, a int, b int")
    for r in frame.select("*", overlapping(F.col("s"), F.col("a"), F.col("b"), 3).alias("got")).collect():
        assert [tuple(x) for x in r.got] == [tuple(x) for x in r.s if x.start < r.b and r.a < x.end]


def test_contexts_reach_over_words_of_any_length(spark, rows):
    word = "x" * 70
    data = [(i, f"{word} contact user{i}@host{i}.org", "", 0, 0) for i in range(6)] + [(20, f"a {word} contact joe(at)site9", "", 0, 0), (21, f"b {word}y contact ann(at)site9", "", 0, 0)]
    got = {r.doc_id: r.spans for r in pii.pii_digest(pii.find_pii(rows(data, DOCS))).collect()}
    assert got[20] == f"email:{len(word) + 11}:{len(word) + 23}" and got[21] == ""
