"""Benchmark decontamination against plain Python."""

import random

import pytest

from plantpulse.llm.decontamination import decontaminate
from tests.llm.brute import words

DOCS = "doc_id long, text string, hits string, items int, extra double"


def brute(docs, items, size=10):
    marks = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            marks.setdefault(tuple(w[s : s + n]), set()).add(item)
    out = []
    for i, text in docs:
        w = words(text)
        hit, held = set(), set()
        for n in {len(m) for m in marks}:
            for s in range(len(w) - n + 1):
                if (found := marks.get(tuple(w[s : s + n]))) is not None:
                    hit |= set(range(s, s + n))
                    held |= found
        out.append((i, len(w), len(hit), sorted(str(x) for x in held if x is not None)))
    return out


def made(seed, n_docs, n_items, vocabulary):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(vocabulary)] + ["Ünï", "THE", "the", "9", "日本"]
    text = lambda n: "".join(rng.choice(pool) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 3, 9, 10, 11, 25]))) for i in range(n_items)] + [(1, "w1 w2"), (None, text(12)), (n_items, None)]
    docs = []
    for i in range(n_docs):
        parts = [text(rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 3)):
            w = words(rng.choice(items)[1])
            s = rng.randrange(0, max(1, len(w) - 9))
            parts += [" ".join(w[s : s + rng.choice([8, 10, 14])]).upper(), text(rng.randrange(0, 9))]
        docs.append((i, " ".join(parts)))
    return [*docs, (n_docs, None), (n_docs + 1, "")], items


def judged(frame):
    return sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in frame.collect())


@pytest.mark.parametrize("seed, vocabulary", [(1, 3), (2, 40), (3, 400)])
def test_against_brute_force(spark, rows, seed, vocabulary):
    docs, items = made(seed, 60, 12, vocabulary)
    got = decontaminate(rows([(*d, "h", 1, 0.5) for d in docs], DOCS).repartition(3), rows(items, "item_id long, text string"))
    assert got.columns == ["doc_id", "text", "extra", "n_words", "hits", "n_hit", "items"]
    assert judged(got) == brute(docs, items)


def test_chunks_of_items(spark, rows):
    docs, items = made(5, 40, 15, 60)
    frame = rows(docs, "doc_id long, text string")
    for chunk in (1, 7):
        got = decontaminate(frame, rows(items, "item_id long, text string").coalesce(1), chunk=chunk, keep=["doc_id"])
        assert judged(got) == brute(docs, items)


def test_frequent_words_and_copies(spark, rows):
    """One passage and one word in most documents, copies of a third of them, an item of many chunks and its copy."""
    common = " ".join(f"c{i}" for i in range(10))
    long = " ".join(f"x{i % 7} the y{i}" for i in range(1500))
    items = [(1, common), (2, "the " * 12), (3, long), (4, long), (None, "the"), (5, common)]
    docs = [(i, f"the {common} {'the ' * (i % 14)} {i}" if i % 3 else f"copy {common} x") for i in range(300)] + [(300, long), (301, long[:4000])]
    got = decontaminate(rows(docs, "doc_id long, text string").repartition(5), rows(items, "item_id long, text string"), keep=["doc_id"])
    assert judged(got) == brute(docs, items)


def test_edges(spark, rows):
    items = rows([(1, "a b c d e f g h i j k")], "item_id long, text string")
    docs = [(1, "a b c d e f g h i j"), (1, "a b c d e f g h i j"), (None, "b c d e f g h i j k")]
    got = decontaminate(rows(docs, "doc_id long, text string"), items).collect()
    assert [(r.doc_id, r.n_hit, r["items"], [tuple(h) for h in r.hits]) for r in got] == [(i, 10, ["1"], [(0, 10)]) for i, _ in docs]
    assert decontaminate(rows([], "doc_id long, text string"), items).count() == 0
    nothing = decontaminate(rows(docs, "doc_id long, text string"), rows([], "item_id long, text string"))
    assert [(r.n_words, r.n_hit, r["items"]) for r in nothing.collect()] == [(10, 0, [])] * 3


def test_a_passage_across_two_documents_is_not_one(spark, rows):
    items = rows([(1, "a b c d e f g h i j")], "item_id long, text string")
    docs = rows([(1, "a b c d e"), (2, "f g h i j"), (3, "x a b c d e f g h i j x")], "doc_id long, text string").coalesce(1)
    assert [r.n_hit for r in decontaminate(docs, items).orderBy("doc_id").collect()] == [0, 0, 10]
