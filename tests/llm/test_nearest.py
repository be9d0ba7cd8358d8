"""Nearest neighbours against brute force."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantpulse.llm import nearest as nn

SCHEMA = "vec_id long, embedding array<float>"


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v)


def brute(data, k):
    """query -> ids by falling inner product, ties to the smaller id."""
    kept = sorted({(i, tuple(np.float32(v).tolist())) for i, v in data if i is not None and usable(v)})
    ids, matrix = np.array([i for i, _ in kept]), np.array([v for _, v in kept], np.float64)
    out = {}
    for at in np.flatnonzero(ids % 20 == 0):
        scores = matrix @ matrix[at]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[at]][:k]
        out[int(ids[at])] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def searched(df, **options):
    out = defaultdict(list)
    for r in nn.nearest(df, F.col("id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert all([r for r, _, _ in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [(i, s) for _, i, s in v] for q, v in out.items()}


def recall(got, want):
    return sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items()) / sum(len(w) for w in want.values())


def clustered(n, d, seed=0, norms=False):
    r = np.random.default_rng(seed)
    middles = r.standard_normal((40, d))
    v = middles[r.integers(0, 40, n)] + 0.6 * r.standard_normal((n, d))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return (v * r.uniform(0.5, 2.0, (n, 1)) if norms else v).astype(np.float32)


@pytest.mark.parametrize("norms", [False, True])
def test_recall_and_scores(rows, norms):
    vectors = clustered(3000, 16, norms=norms)
    data = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got, want = searched(rows(data, SCHEMA).repartition(4)), brute(data, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    exact = vectors.astype(np.float64)
    for q, found in got.items():
        assert [i for i, s in found] == [i for i, s in sorted(found, key=lambda x: (-x[1], x[0]))]
        assert all(abs(s - exact[q] @ exact[i]) < 1e-12 and i != q for i, s in found)


def test_small_sample_indexes_every_row(rows):
    """Centroids from a tenth of the rows: all rows are found, and recall holds."""
    data = [(i, v.tolist()) for i, v in enumerate(clustered(2000, 8, seed=3))]
    got, want = searched(rows(data, SCHEMA), sample=200), brute(data, 20)
    assert recall(got, want) >= 0.9
    assert {i for v in got.values() for i, _ in v} - set(range(0, 2000, 20))


def test_copies_ties_and_a_hot_vector(rows):
    """A third of the rows are one vector: the smallest identifiers win, the own one is skipped."""
    base = [(i, v.tolist()) for i, v in enumerate(clustered(200, 4, seed=1))]
    hot = [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(120)]
    data = base + hot + base[:30]
    got, want = searched(rows(data, SCHEMA).repartition(6)), brute(data, 20)
    assert got[1000] and [i for i, _ in got[1000]] == [i for i, _ in want[1000]]
    assert recall(got, want) >= 0.9


def test_unusable_rows_few_candidates_and_clashing_columns(rows):
    data = [(0, [1.0, 0.0]), (20, [0.6, 0.8]), (3, [-1.0, -0.0]), (4, [0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]), (8, [1.0, None]),
            (9, [float("nan"), 1.0]), (40, [float("inf"), 1.0]), (60, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (80, None)]
    want = brute([r for r in data if r[1] is None or len(r[1]) == 2], 20)
    got = searched(rows([(*r, "a", 1, 2.0) for r in data], SCHEMA + ", id string, rank int, score double"))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()} == {0: [20, 4, 3], 20: [4, 0, 3]}


def test_empty_and_alone(rows):
    assert searched(rows([], SCHEMA)) == {} and searched(rows([(1, None)], SCHEMA)) == {}
    assert searched(rows([(20, [1.0, 2.0])], SCHEMA)) == {} and searched(rows([(1, [1.0]), (2, [2.0])], SCHEMA)) == {}


def test_same_identifier_on_two_vectors(rows):
    """Each of the two asks; neither finds the other."""
    got = nn.nearest(rows([(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0])], SCHEMA), F.col("id") % 20 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(20, 1, 1)] * 2


def test_search_in_blocks_and_parts_is_the_same(rows, monkeypatch):
    data = [(i * 5, v.tolist()) for i, v in enumerate(clustered(900, 8, seed=5))]
    whole = searched(rows(data, SCHEMA))
    monkeypatch.setattr(nn, "BLOCK", 16)
    split = searched(rows(data, SCHEMA))
    assert {q: [i for i, _ in v] for q, v in split.items()} == {q: [i for i, _ in v] for q, v in whole.items()}


def test_graph_finds_all_lists_within_reach():
    vectors = clustered(4000, 12, seed=2).astype(np.float64)
    index = nn.fit(vectors, 1.0 + 1e-6, 4000)
    points = index.aimed(vectors[:200])
    true = nn._distances(points, index.centroids)
    limit = index.reach * np.maximum(true.min(1, keepdims=True), index.floor)
    found = index.search(points, index.reach)
    wanted = true <= limit
    assert (np.isfinite(found) & wanted).sum() / wanted.sum() > 0.98
    sizes = np.bincount(nn._distances(index.lifted(vectors), index.centroids).argmin(1), minlength=len(index.centroids))
    assert sizes.max() <= 6 * sizes.mean()


def test_copies_lie_over_boundaries():
    vectors = clustered(3000, 8, seed=4).astype(np.float64)
    index = nn.fit(vectors, 1.0 + 1e-6, 3000)
    lists = index.postings(vectors)
    assert max(map(len, lists)) <= nn.COPIES and sum(map(len, lists)) > len(lists)
    dist = nn._distances(index.lifted(vectors), index.centroids)
    assert all(dist[i, x].max() <= nn.BOUNDARY * dist[i].min() * 1.2 for i, x in enumerate(lists))
