"""Exact and line deduplication against plain Python."""

import random

import pytest

from plantpulse.llm.exact_dedup import exact_dedup
from plantpulse.llm.line_dedup import line_dedup
from plantpulse.llm.runs import leaf_run, merged_totals
from pyspark.sql import functions as F
from tests.llm.brute import lower, sha

DOCS = "doc_id long, text string, run string, keep_id string, _id int"
TEXTS = ["A b", "a B", "ÄB", "äb", "", None, "x\ny", "A b ", "a b" * 5000]


def rows_of(n, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(TEXTS), "r", "k", 0) for i in range(n)]


@pytest.mark.parametrize("survivor, pick", [("largest", max), ("smallest", min)])
def test_exact_dedup(spark, rows, survivor, pick):
    data = rows_of(300)
    got = {r.doc_id: r for r in exact_dedup(rows(data, DOCS).repartition(7), survivor=survivor, leaf_runs=5, fan_in=2).collect()}
    groups = {}
    for i, t, *_ in data:
        groups.setdefault(lower(t or ""), []).append(i)
    assert len(got) == 300
    for t, ids in groups.items():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (pick(ids), len(ids), i == pick(ids), sha(t))


def test_exact_dedup_edges(spark, rows):
    data = [(None, "q", "", "", 1), (3, "q", "", "", 1), (3, "q", "", "", 1), (None, "z", "", "", 1), (None, "z", "", "", 1)]
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in exact_dedup(rows(data, DOCS), survivor="largest").collect())
    assert got == [(-1, -1, 2, True), (-1, -1, 2, True), (-1, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True)]
    assert exact_dedup(rows([], DOCS)).count() == 0


def test_hot_key_is_merged_in_a_tree(spark):
    data = spark.range(0, 5000, 1, 8).select(F.lit("k").alias("key"), "id", leaf_run(8).alias("run"))
    got = merged_totals(data, "run", ["key"], {"n": (F.count(F.lit(1)), F.sum), "lo": (F.min("id"), F.min)}, leaf_runs=8, fan_in=2).collect()
    assert len(got) == 8 and {(r.n, r.lo) for r in got} == {(5000, 0)}


def brute_lines(data, min_length=10, max_documents=1):
    key = lambda line: lower(line.strip("\t\n\x0b\x0c\r "))
    held = {}
    for i, t in data:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_length:
                held.setdefault(key(line), set()).add(i)
    out = {}
    for i, t in data:
        lines = (t or "").split("\n")
        gone = [len(held.get(key(x), ())) > max_documents and i != min(held[key(x)]) for x in lines]
        out[i] = (len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("most", [1, 2])
def test_line_dedup(spark, rows, most):
    rng = random.Random(4)
    pool = ["the shared line", " The SHARED line\r", "short", "", "ÜBER LINIE hier", "über linie hier", "\x0bthe shared line\x0c", "another long line", " nbsp is no blank"]
    data = [(i, None if i % 17 == 0 else "\n".join(rng.choice([*pool, f"own line number {i}"]) for _ in range(rng.randrange(0, 9)))) for i in range(120)]
    got = line_dedup(rows([(*d, 7, "x") for d in data], "doc_id long, text string, n_lines int, _fp string").repartition(5), max_documents=most, leaf_runs=5, fan_in=2)
    assert got.columns == ["doc_id", "text", "_fp", "n_lines", "n_dropped"]
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in got.collect()} == brute_lines(data, max_documents=most)


def test_line_dedup_edges(spark, rows):
    line = "a line of some length"
    data = [(2, line), (2, line), (None, line), (5, f"{line}\n{line}\n"), (1, None)]
    got = sorted((r.doc_id or -1, r.n_lines, r.n_dropped, r.text) for r in line_dedup(rows(data, "doc_id long, text string")).collect())
    assert got == [(-1, 1, 1, ""), (1, 1, 0, ""), (2, 1, 0, line), (2, 1, 0, line), (5, 3, 2, "")]
    assert line_dedup(rows([], "doc_id long, text string")).count() == 0


def test_line_dedup_of_a_long_text(spark, rows):
    long = "\n".join(f"line number {i}" for i in range(20_000))
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup(rows([(1, long), (2, long + "\nlast")], "doc_id long, text string")).collect()}
    assert got == {1: (20_000, 0, long), 2: (20_001, 20_000, "last")}
