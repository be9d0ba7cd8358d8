"""Nearest neighbours by inner product: balanced posting lists, boundary copies, a graph over the centroids."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.session import cut

K = 20
#: Distinct vectors the centroids, the graph and the pruning ratio are fitted on, about; at most twice as many. All are indexed.
SAMPLE = 16_384
#: Lists at most: the centroids are in every task's memory. Below that their number is the root of that of the vectors.
LISTS = 4_096
#: Lists a vector near a boundary is copied to at most, and how much farther than the nearest one those may be.
COPIES, BOUNDARY = 4, 1.05
#: Share of the true neighbours whose lists the pruning ratio reaches on the sample.
TARGET = 0.97
#: Vectors and queries that meet in one group of the search at most, about.
BLOCK = 2_048
DEGREE, FAR_LINKS, BEAM = 24, 8, 8


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, h) of the vectors that take part; ``h`` is a hash of the vector.

    Null and zero vectors, those with null or non-finite entries, those of another length than most (of equally frequent
    lengths the greater), and rows without an identifier take no part.
    """
    v = F.transform(F.col(f"`{vec_col}`"), lambda c: c + F.lit(0).cast("float"))  # -0.0 becomes 0.0
    kept = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = kept.filter(~bad & F.exists("v", lambda c: c != 0))
    most = kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return kept.filter(F.size("v") == (most["d"] if most else 0)).withColumn("h", F.xxhash64("v"))


def classes_of(vectors: DataFrame, k: int) -> DataFrame:
    """(c, h, v, ids) of each distinct vector with its k + 1 smallest identifiers.

    Larger ones can't be among anyone's k nearest, as ties go to the smaller, so a vector that a third of the rows
    have is one row here. Each task passes on k + 1 identifiers of a vector at most.
    """
    same = Window.partitionBy("h", "v").orderBy("id")
    few = vectors.distinct().withColumn("r", F.row_number().over(same)).filter(F.col("r") <= k + 1)
    grouped = few.groupBy("h", "v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return cut(grouped.withColumn("c", F.monotonically_increasing_id()), "nearest-vectors")


_HITS = pa.list_(pa.struct([("score", pa.float64()), ("first", pa.int64()), ("c", pa.int64()), ("ids", pa.list_(pa.int64()))]))


def _matrix(column: pa.ChunkedArray | pa.Array, dtype: type = np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), dtype)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (centroids**2).sum(1) - 2 * points @ centroids.T
    return np.sqrt(np.maximum(square, 0))


def _balanced(points: np.ndarray, lists: int, random: np.random.Generator, rounds: int = 14) -> np.ndarray:
    """Centroids of about equally full clusters: in the first rounds the emptiest clusters move into those of over twice the
    mean size, so dense regions get more lists."""
    centroids = points[random.choice(len(points), lists, replace=False)].copy()
    for turn in range(rounds):
        nearest = np.concatenate([_distances(points[i:i + 1024], centroids).argmin(1) for i in range(0, len(points), 1024)])
        sizes = np.bincount(nearest, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
        if turn < rounds - 4:
            full = np.flatnonzero(sizes > 2 * len(points) / lists)
            for big, small in zip(full[np.argsort(-sizes[full])], np.argsort(sizes)):
                centroids[small] = points[random.choice(np.flatnonzero(nearest == big))]
    return centroids


@dataclass(frozen=True)
class Index:
    """Centroids in the space where the nearest is that of the largest inner product, a graph over them, and the pruning
    ratio. A vector gets one entry more, so that all have the length ``norm``; a query gets 0 and that length."""

    norm: float
    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    floor: float = 0.0
    reach: float = 1.0

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        return np.c_[vectors, np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(1), 0))]

    def aimed(self, queries: np.ndarray) -> np.ndarray:
        length = np.sqrt((queries**2).sum(1))[:, None]
        return np.c_[queries * (self.norm / length), np.zeros(len(queries))]

    def search(self, points: np.ndarray, reach: float) -> np.ndarray:
        """Distances to the centroids the graph leads to, infinite for others: all within ``reach`` of the nearest are there.

        The walk begins at the entry nodes and expands every node within reach of the nearest so far, and the best BEAM
        nodes in any case, until none of these is left.
        """
        m, lists = len(points), len(self.centroids)
        dist = np.full((m, lists), np.inf)
        dist[:, self.entries] = _distances(points, self.centroids[self.entries])
        expanded = np.zeros((m, lists), bool)
        squares, beam = (self.centroids**2).sum(1), min(BEAM, lists) - 1
        norms = (points**2).sum(1)
        while True:
            limit = np.maximum(reach * np.maximum(dist.min(1), self.floor), np.partition(dist, beam, axis=1)[:, beam])
            rows, nodes = np.nonzero(~expanded & (dist <= limit[:, None]) & np.isfinite(dist))
            if not len(rows):
                return dist
            expanded[rows, nodes] = True
            fresh = np.zeros((m, lists), bool)
            fresh[rows[:, None], self.graph[nodes]] = True
            rows, nodes = np.nonzero(fresh & np.isinf(dist))
            for i in range(0, len(rows), 65_536):
                r, c = rows[i:i + 65_536], nodes[i:i + 65_536]
                dist[r, c] = np.sqrt(np.maximum(norms[r] + squares[c] - 2 * np.einsum("ij,ij->i", points[r], self.centroids[c]), 0))

    def postings(self, vectors: np.ndarray) -> list[list[int]]:
        """The lists of each vector, nearest first. Of lists nearly as near as that, one is taken if it lies farther from those
        taken than the vector from it, so copies go over different boundaries."""
        points = self.lifted(vectors)
        dist = self.search(points, BOUNDARY)
        ranked = np.argsort(dist, axis=1)[:, : 4 * COPIES]
        out = []
        for row, order in zip(dist, ranked):
            taken = [int(order[0])]
            for c in order[1:]:
                if len(taken) == COPIES or row[c] > BOUNDARY * row[order[0]]:
                    break
                if (((self.centroids[taken] - self.centroids[c]) ** 2).sum(1) > row[c] ** 2).all():
                    taken.append(int(c))
            out.append(taken)
        return out

    def probes(self, queries: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
        """The lists to search for each query: those whose distance is within the ratio of the nearest one's, and beyond that
        the nearest ones until ``least`` vectors are among them (``sizes`` counts every vector in one list)."""
        points = self.aimed(queries)
        dist = self.search(points, self.reach)
        out = []
        for point, row in zip(points, dist):
            order = np.argsort(row)
            picked = order[row[order] <= self.reach * max(row[order[0]], self.floor)]
            if sizes[picked].sum() < least:
                order = np.argsort(_distances(point[None], self.centroids)[0])
                enough = int(np.searchsorted(np.cumsum(sizes[order]), least)) + 1
                picked = np.union1d(picked, order[:enough])
            out.append(picked)
        return out


def fit(sample: np.ndarray, norm: float, count: int, k: int = K, lists: int = LISTS, seed: int = 7) -> Index:
    """Centroids, graph and pruning ratio from a bounded sample of ``count`` distinct vectors.

    The ratio is the smallest that reaches a list of TARGET of the true nearest neighbours of 512 vectors within the
    sample. In all of the table neighbours are nearer than in a part of it, so it is rather too wide than too narrow.
    """
    random = np.random.default_rng(seed)
    bare = Index(norm, np.zeros((1, sample.shape[1] + 1)), np.zeros((1, 1), int), np.zeros(1, int))
    points = bare.lifted(sample)
    number = max(1, min(lists, round(count**0.5), len(sample) // 4))
    centroids = _balanced(points, number, random)
    near = np.argsort(_distances(centroids, centroids), axis=1)[:, 1:DEGREE + 1]
    graph = np.c_[near, random.integers(0, number, (number, FAR_LINKS))]
    entries = np.arange(0, number, max(1, round(number**0.5)))
    index = Index(norm, centroids, graph, entries)
    lists_of = index.postings(sample)
    member = np.zeros((len(sample), number), bool)
    member[np.repeat(np.arange(len(sample)), [len(x) for x in lists_of]), np.concatenate(lists_of)] = True
    asked = random.choice(len(sample), min(512, len(sample)), replace=False)
    dist = _distances(bare.aimed(sample[asked]), centroids)
    floor = float(np.quantile(dist.min(1), 0.05))
    needed = []
    for at, row in zip(asked, dist):
        scores = sample @ sample[at]
        scores[at] = -np.inf
        true = np.argsort(-scores)[: min(k, len(sample) - 1)]
        needed.append(np.where(member[true], row, np.inf).min(1) / max(row.min(), floor, 1e-300))
    ratios = np.concatenate(needed) if needed else np.ones(0)
    return Index(norm, centroids, graph, entries, floor, max(1.0, float(np.quantile(ratios, TARGET))) if len(ratios) else 1.0)


def _best(scores: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k largest scores, ties to the smaller ``first``."""
    if scores.shape[1] > k:
        bound = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
        rows, columns = np.nonzero(scores >= bound)
    else:
        rows, columns = (x.ravel() for x in np.indices(scores.shape))
    order = np.lexsort((first[columns], -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], columns[place < k]


@dataclass(frozen=True)
class Layout:
    """How lists become groups of the search: short lists share a group, long ones are several blocks, and the queries of a group
    are dealt to several parts. All arrays have one entry per list."""

    group: np.ndarray
    blocks: np.ndarray
    parts: np.ndarray


def _layout(index: Index, sizes: np.ndarray, asked: np.ndarray) -> Layout:
    middle = index.centroids - index.centroids.mean(0)
    order = np.argsort(middle @ np.linalg.svd(middle, full_matrices=False)[2][0])
    group, blocks, parts = (np.zeros(len(sizes), int) for _ in range(3))
    now, fill, members = 0, 0, []

    def close() -> None:
        for x in members:
            parts[x] = max(1, -(-int(asked[members].max()) // BLOCK))

    for one in order:
        if members and fill + sizes[one] > BLOCK:
            close()
            now, fill, members = now + 1, 0, []
        group[one], blocks[one] = now, max(1, -(-int(sizes[one]) // BLOCK))
        members.append(one)
        fill += sizes[one]
    close()
    return Layout(group, blocks, parts)


def _posted(vectors: DataFrame, index: Index) -> DataFrame:
    """(c, v, ids, lists): the lists a vector is posted to."""
    kind = next(f.dataType.simpleString() for f in vectors.schema if f.name == "v")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield pa.record_batch([*part.columns, pa.array(index.postings(_matrix(part.column("v"))), pa.list_(pa.int32()))], [*part.schema.names, "lists"])

    return cut(vectors.select("c", "v", "ids").mapInArrow(task, f"c long, v {kind}, ids array<long>, lists array<int>"), "nearest-postings")


@dataclass(frozen=True)
class Sample:
    """The sampled vectors with their class, and their identifiers."""

    matrix: np.ndarray
    c: np.ndarray
    ids: list[list[int]]


def _probed(vectors: DataFrame, index: Index, sizes: np.ndarray, least: int, sample: Sample, k: int) -> DataFrame:
    """(c, v, lists, bound, hits): the lists a query searches, its best k + 1 vectors of the sample, and the least score of these.

    The sample's vectors are candidates like all others, so nothing below the bound can be among the nearest.
    """
    kind = next(f.dataType.simpleString() for f in vectors.schema if f.name == "v")
    first = np.array([x[0] for x in sample.ids])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256).select(["c", "v"])
                matrix = _matrix(part.column("v"))
                scores = matrix @ sample.matrix.T
                rows, columns = _best(scores, first, k + 1)
                hits: list[list[dict]] = [[] for _ in matrix]
                for r, c in zip(rows, columns):
                    hits[r].append({"score": float(scores[r, c]), "first": int(first[c]), "c": int(sample.c[c]), "ids": sample.ids[c]})
                bound = [x[-1]["score"] if len(x) > k else -np.inf for x in hits]
                lists = index.probes(matrix, sizes, least)
                yield pa.record_batch([*part.columns, pa.array(lists, pa.list_(pa.int32())), pa.array(bound, pa.float64()), pa.array(hits, _HITS)], [*part.schema.names, "lists", "bound", "hits"])

    schema = f"c long, v {kind}, lists array<int>, bound double, hits array<struct<score:double,first:long,c:long,ids:array<long>>>"
    return cut(vectors.select("c", "v").mapInArrow(task, schema), "nearest-probes")


def _counts(rows: DataFrame, column: Column, lists: int) -> np.ndarray:
    out = np.zeros(lists, int)
    for r in rows.select(F.explode(column).alias("list")).groupBy("list").count().collect():
        out[r["list"]] = r["count"]
    return out


def _shipped(rows: DataFrame, layout: Layout, queries: bool) -> DataFrame:
    """One row per group of the search that a row belongs to, with its lists there."""

    def at(values: np.ndarray) -> Column:
        return F.get(F.lit(values.astype(int).tolist()).cast("array<int>"), F.col("list"))

    each = rows.select("*", F.explode("lists").alias("list")).withColumn("g", at(layout.group)).withColumn("n", at(layout.blocks)).withColumn("p", at(layout.parts))
    extra = "bound" if queries else "ids"
    each = each.groupBy("c", "g", "n", "p").agg(F.first("v").alias("v"), F.first(extra).alias(extra), F.collect_list("list").alias("lists"))
    own, other = ("p", "n") if queries else ("n", "p")
    each = each.withColumn(own, F.pmod(F.xxhash64("c"), F.col(own)).cast("int"))
    return each.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))


def _search(postings: DataFrame, queries: DataFrame, layout: Layout, k: int) -> DataFrame:
    """(q, score, first, c, ids): the best k + 1 distinct vectors of each group for each query, of those at its bound or above."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            vectors, asked = _matrix(left.column("v")), _matrix(right.column("v"))
            ids = left.column("ids").combine_chunks()
            first = ids.flatten().to_numpy()[ids.value_lengths().to_numpy().cumsum() - ids.value_lengths().to_numpy()]
            c, q, bound = left.column("c").to_numpy(), right.column("c").to_numpy(), right.column("bound").to_numpy()
            bound = np.where(np.isfinite(bound), bound - 1e-12 * np.abs(bound), bound)  # products of other blocks round otherwise
            held, wanted = (side.column("lists").combine_chunks() for side in (left, right))
            held_row, wanted_row = (np.repeat(np.arange(len(x)), x.value_lengths().to_numpy()) for x in (held, wanted))
            held, wanted = held.flatten().to_numpy(), wanted.flatten().to_numpy()
            for one in np.intersect1d(held, wanted):
                a, b = held_row[held == one], wanted_row[wanted == one]
                scores = asked[b] @ vectors[a].T
                rows, columns = np.nonzero(scores >= bound[b][:, None])
                out.append((b[rows], a[columns], scores[rows, columns]))
        if not any(len(rows) for rows, _, _ in out):
            return pa.table([pa.array([], t) for t in found.types], schema=found)
        rows, columns, scores = (np.concatenate(x) for x in zip(*out))
        order = np.lexsort((columns, rows))  # a copy of a vector in two lists of the group counts once
        rows, columns, scores = rows[order], columns[order], scores[order]
        once = np.r_[True, (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])]
        rows, columns, scores = rows[once], columns[once], scores[once]
        order = np.lexsort((first[columns], -scores, rows))
        rows, columns, scores = rows[order], columns[order], scores[order]
        top = np.arange(len(rows)) - np.searchsorted(rows, rows) <= k
        rows, columns, scores = rows[top], columns[top], scores[top]
        return pa.table([q[rows], scores, first[columns], c[columns], ids.take(pa.array(columns))], schema=found)

    found = pa.schema([("q", pa.int64()), ("score", pa.float64()), ("first", pa.int64()), ("c", pa.int64()), ("ids", pa.list_(pa.int64()))])
    keys = ["g", "n", "p"]
    return _shipped(postings, layout, False).groupBy(*keys).cogroup(_shipped(queries, layout, True).groupBy(*keys)).applyInArrow(
        meet, "q long, score double, first long, c long, ids array<long>")


def nearest(rows: DataFrame, asks: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", lists: int = LISTS, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found of each row for which ``asks`` (on ``id``) holds.

    Distinct vectors are posted to the list of their nearest centroid, and to others nearly as near. A query walks the
    graph over the centroids, takes the lists within the pruning ratio, and scores all vectors there in double
    precision. Its k + 1 best vectors of the sample are candidates too, so a group of the search gives out only what scores no
    less than they. Lists longer than BLOCK are searched in blocks, and the queries of a list in parts, so no group grows
    with the table; nothing is left out of a list. The driver holds the sample, the centroids and counts per list.

    Rows that ``usable`` leaves out neither ask nor are found. Rows alike in identifier and vector are one row. A row's
    own identifier is never among its results. With fewer than k candidates all are returned, with at least k always k.
    Ties go to the smaller identifier. An empty table gives an empty result; other columns are not read.
    """
    vectors = usable(rows, id_col, vec_col)
    known = classes_of(vectors, k)
    facts = known.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("norm")).first()
    if not facts["n"]:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = int(min(1.0, sample / facts["n"]) * 2**30)
    chosen = known.filter(F.pmod("h", F.lit(2**30)) < share).orderBy("h", "c").limit(2 * sample) if share < 2**30 else known.orderBy("h", "c")
    chosen = chosen.select("c", "v", "ids").collect()
    some = Sample(np.array([r["v"] for r in chosen], dtype=np.float64), np.array([r["c"] for r in chosen]), [list(r["ids"]) for r in chosen])
    index = fit(some.matrix, facts["norm"] ** 0.5, facts["n"], k, lists)
    number = len(index.centroids)

    postings = _posted(known, index)
    sizes, primary = _counts(postings, F.col("lists"), number), _counts(postings, F.slice("lists", 1, 1), number)
    asking = vectors.filter(asks).distinct()
    asked = known.join(asking.select("h", "v").distinct(), ["h", "v"], "left_semi")
    probes = _probed(asked, index, primary, min(k + 1, facts["n"]), some, k)
    layout = _layout(index, sizes, _counts(probes, F.col("lists"), number))

    sampled = probes.select(F.col("c").alias("q"), F.inline("hits")).select("q", "score", "first", "c", "ids")
    found = _search(postings, probes, layout, k).unionByName(sampled).repartition("q").groupBy("q", "c").agg(F.max("score").alias("score"), F.first("first").alias("first"), F.first("ids").alias("ids"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "first", "c")
    few = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).select("q", "score", F.explode("ids").alias("id"))
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).filter(F.col("r") <= k + 1)
    tops = few.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("top"))
    named = tops.join(known.select(F.col("c").alias("q"), "h", "v"), "q").drop("q")
    each = asking.join(named, ["h", "v"]).select(F.col("id").alias("query_id"), F.filter("top", lambda x: x["id"] != F.col("id")).alias("top"))
    return each.select("query_id", F.posexplode(F.slice("top", 1, k)).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
