"""The similarity join against all pairs in plain Python."""

import random
from math import comb

import numpy as np
import pytest

from plantpulse.llm import jaccard_join as jj
from plantpulse.llm.components import components
from tests.llm.brute import shingles


def brute(docs, similarity=0.8):
    sets = [shingles(t) for _, t in docs]
    links = [0] * len(docs)
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(root(i), []).append(docs[i][0])
    return sorted((docs[i][0], min(groups[root(i)]), links[i], len(groups[root(i)])) for i in range(len(docs)))


def family(rng, n, edits):
    base = [f"b{rng.randrange(10**6)}" for _ in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w).title() if rng.random() < 0.3 else ", ".join(w))
    return out


def made(seed):
    rng = random.Random(seed)
    texts = [t for _ in range(6) for t in family(rng, rng.randrange(1, 8), 5)] + family(rng, 30, 3)
    texts += [texts[0], texts[0].upper(), "", None, "one two", "One, two!", "a b c d e", "a b c d e f"]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


def judged(frame):
    return sorted((r.doc_id, r.class_id, r.n_links, r.n_docs) for r in frame.collect())


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 5)])
def test_against_all_pairs(spark, rows, monkeypatch, seed, block):
    monkeypatch.setattr(jj, "BLOCK", block)
    docs = made(seed)
    got = jj.near_duplicates(rows([(*d, b"x", 1) for d in docs], "doc_id long, text string, class binary, size int").repartition(4))
    assert judged(got) == brute(docs)
    kept = [r.doc_id for r in got.filter("representative").collect()]
    assert sorted(kept) == sorted({c for _, c, _, _ in brute(docs)})


def test_links_between_clusters_are_found(spark, rows, monkeypatch):
    # with no class attached to another, every link has to come from a bucket of several clusters
    monkeypatch.setattr(jj, "ATTACH", 2.0)
    monkeypatch.setattr(jj, "BLOCK", 6)
    docs = made(3)
    assert judged(jj.near_duplicates(rows(docs, "doc_id long, text string"))) == brute(docs)


def test_edges(spark, rows):
    data = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, None), (4, "")]
    got = sorted((r.doc_id or -1, r.class_id or -1, r.n_links, r.n_docs, r.representative) for r in jj.near_duplicates(rows(data, "doc_id long, text string")).collect())
    assert got == [(-1, 7, 2, 3, False), (3, 3, 0, 1, True), (4, 4, 0, 1, True), (7, 7, 2, 3, True), (7, 7, 2, 3, True)]
    assert jj.near_duplicates(rows([], "doc_id long, text string")).count() == 0


def test_posterior_bound():
    for k, m in jj.fewest_matches(0.8, 1e-9).items():
        tail = lambda x: sum(comb(k + 1, i) * 0.8**i * 0.2 ** (k + 1 - i) for i in range(x + 1))
        assert tail(m) >= 1e-9 and (m == 0 or tail(m - 1) < 1e-9)
        # the uniform prior's posterior, by numeric integration
        s = np.linspace(0, 1, 200_001)
        p = s**m * (1 - s) ** (k - m)
        assert abs(p[s >= 0.8].sum() / p.sum() - tail(m)) < 1e-3


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.unique(x[:2000]), np.unique(x[500:2500])
    s = jj.minhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.15


def test_components(spark, rows):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)] + [(300, 300)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(rows(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
