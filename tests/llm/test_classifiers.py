"""Toxicity and language identification: exact parts against plain Python, the rest by held-out accuracy."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest

from plantpulse.llm import language_id, toxicity
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, score string, toxicity string"
SYLLABLES = {"en": ["th", "er", "ing", "wh", "ou", "and"], "de": ["sch", "ung", "ä", "keit", "ver", "ich"], "ru": ["ст", "про", "ение", "ать"], "uk": ["ії", "ення", "ськ", "ати"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    return [(i, prose(rng, lang := rng.choice(list(SYLLABLES)), rng.randrange(1, 60)).capitalize(), lang, "s", "t") for i in range(600)]


def test_language_of_held_out_texts(spark, rows, corpus):
    docs = rows(corpus, DOCS).repartition(3)
    out = language_id.held_out(F.col("doc_id"), 4, 2)
    got = language_id.identify(docs, language_id.fit(docs.filter(~out))).withColumn("out", out).collect()
    assert len(got) == 600 and all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_spans_of_mixed_texts(spark, rows, corpus):
    model = language_id.fit(rows(corpus, DOCS))
    rng = random.Random(9)
    a, b = prose(rng, "en", 30), prose(rng, "ru", 20)
    data = [(1, f"{a}. {b}", None, "", ""), (2, "12 -- !", None, "", ""), (3, None, None, "", ""), (4, "", None, "", ""), (5, "日本 語", None, "", ""), (6, b, None, "", ""), (6, b, None, "", "")]
    got = language_id.identify(rows(data, DOCS), model).collect()
    assert [(s.start, s.end, s.lang) for s in got[0].lang_spans] == [(0, len(a), "en"), (len(a) + 2, len(a) + 2 + len(b), "ru")]
    assert [(r.lang_pred, r.score, r.lang_spans) for r in got[1:4]] == [("und", 0.0, [])] * 3
    assert got[4].lang_pred in SYLLABLES and got[5] == got[6] and got[5].lang_pred == "ru"
    assert "score" in got[0].asDict() and len(got[0]) == 7  # the new score replaces the one that came in


def test_without_training_rows(spark, rows):
    docs = rows([(1, "some text", None, "", "")], DOCS)
    assert [r.lang_pred for r in language_id.identify(docs, language_id.fit(docs)).collect()] == ["und"]
    assert language_id.identify(rows([], DOCS), None).count() == 0


def best_path(score, switch):
    return max(
        (sum(score[i][x] for i, x in enumerate(p)) - switch * sum(a != b for a, b in itertools.pairwise(p)) for p in itertools.product(range(score.shape[1]), repeat=len(score))),
        default=0,
    )


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(3)
    counts = [0, 5, 1, 0, 7, 3, 6]
    score = rng.normal(size=(sum(counts), 3)) * 3
    first = np.concatenate([[0], np.cumsum(counts)])
    label = language_id.viterbi(score.astype(np.float32), first, 2.0)
    for a, b in itertools.pairwise(first.tolist()):
        got = sum(score[i, label[i]] for i in range(a, b)) - 2.0 * sum(label[i] != label[i - 1] for i in range(a + 1, b))
        assert math.isclose(got, best_path(score[a:b], 2.0), abs_tol=1e-4)


def test_words_are_runs_of_letters():
    x = language_id.letters(["Ab, cÉ9x", None, "", "д"])
    assert (x.end - x.start).tolist() == [2, 2, 1, 1] and x.first.tolist() == [0, 3, 3, 3, 4]
    y = language_id.letters(["ab cé x д"])
    assert x.bucket.tolist() == y.bucket.tolist()


@pytest.fixture(scope="module")
def channel(spark):
    rng = random.Random(1)
    words = ["idiot", "stupid", "worthless", "trash", "pathetic", "the", "and", "reading", "letter", "book", "good"]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(50)], "doc_id long, text string")
    return toxicity.fit_channel(docs)


@pytest.mark.parametrize("noisy, clean", [
    ("you 1d10t!", "you idiot!"), ("$tup1d", "stupid"), ("s t u p i d", "stupid"), ("s-t-u-p-i-d one", "stupid one"), ("wooorthlesssss", "worthless"),
    ("tr4sh and p@the+ic", "trash and pathetic"), ("a good book", "a good book"), ("letter", "letter"), ("", ""), (None, ""), ("ID1OT", "idiot"),
])
def test_noise_is_decoded(channel, noisy, clean):
    assert channel.restore(noisy) == clean


@pytest.mark.parametrize("noisy, clean", [
    ("idi07", "idiot"), ("7ra5h", "trash"), ("path3tic 5tup1d go0d", "pathetic stupid good"), ("worthle$$", "worthless"), ("worthle55.", "worthless."), ("th3", "the"), ("the!!", "the!"),
    ("i d 1 0 t", "idiot"), ("i.d.1.0.7", "idiot"), ("s t u p 1 d", "stupid"), ("$-t-u-p-1-d!", "stupid!"), ("1 2 3 4.5 6", "1 2 3 4.5 6"), ("idiot", "idiot"),
])
def test_noise_at_the_end_and_spaced_signs_are_decoded(channel, noisy, clean):
    assert channel.restore(noisy) == clean
    assert set(toxicity.WORD.findall(clean)) <= {w for c in channel.chunks(noisy) for w in channel.words(c)}


def test_signs_at_the_end_may_be_no_letters(channel):
    assert "idiot" in channel.words("idiot2") and "trash" in channel.words("tr4sh99") and channel.words("the!!") == ["the"]


def test_decoding_takes_the_cheapest_path(channel):
    def paths(chunk):
        for arcs in itertools.product(*(channel.arcs(chunk, i) for i in range(len(chunk)))):
            out = " ".join("".join(x for x, _ in arcs).split())
            cost = sum(c for _, c in arcs)
            a = b = 0
            for c in "".join(x for x, _ in arcs) + " ":
                x = toxicity.letter(c)
                if x == 0 and b == 0:
                    continue
                cost += channel.cost[a, b, x]
                a, b = (b, x) if x else (0, 0)
            yield cost, out

    for chunk in ("1d10t", "s t u p", "tr4sh", "b00k", "a.n.d", "gooood"):
        assert " ".join(channel.decode(chunk).split()) == min(paths(chunk))[1]


def test_toxicity_of_held_out_texts(spark, rows, corpus):
    rng = random.Random(2)
    bad = ["idiot", "stupid", "scum", "$tup1d", "s c u m", "IDIOT"]
    docs, labels = [], []
    for i, t, *rest in corpus:
        toxic = rng.random() < 0.3
        w = t.split()
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            w.insert(rng.randrange(len(w) + 1), rng.choice(bad))
        docs.append((i, " ".join(w), *rest))
        labels.append((i, int(toxic)))
    docs += [(1000, None, "", "", ""), (1001, "", "", "", "")]
    labels += [(None, 1), (5000, None), (0, labels[0][1])]
    frame = rows(docs, DOCS).repartition(3)
    model = toxicity.fit(frame, rows(labels, "doc_id long, toxic int"))
    got = toxicity.score_toxicity(frame, model).collect()
    score = {r.doc_id: r.toxicity for r in got}
    assert len(got) == 602 and all(0 <= s <= 1 for s in score.values()) and score[1000] == score[1001] < 0.5
    held = [(y, score[i] >= toxicity.THRESHOLD) for i, y in labels if i in score and zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(y == p for y, p in held) / len(held) > 0.95


def test_toxicity_of_empty_tables(spark, rows):
    docs, labels = rows([(1, "x", "", "", "")], DOCS), rows([], "doc_id long, toxic int")
    assert [r.toxicity for r in toxicity.score_toxicity(docs, toxicity.fit(docs, labels)).collect()] == [0.0]
    none = rows([], DOCS)
    assert toxicity.score_toxicity(none, toxicity.fit(none, labels)).count() == 0


@pytest.mark.parametrize("text", ["a b c", "x s c u m y", "go s.c.u.m", "word s c u m", "1d10t. s c u m", "I a m so", "no one"])
def test_chunks_hold_what_the_text_holds(channel, text):
    words = {w for c in channel.chunks(text) for w in channel.words(c)}
    assert {w for w in toxicity.WORD.findall(channel.restore(text)) if len(w) > 1} <= words
