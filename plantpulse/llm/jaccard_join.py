"""Near duplicates: a similarity join on word shingles with Bayesian pruning of candidates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.components import components
from plantpulse.llm.words import groups, mixed, windows, words
from plantpulse.session import cut

SHINGLE = 5
SIMILARITY = 0.8
#: MinHash values, in bands of ROWS: texts of similarity 0.8 share no band with probability (1 - 0.8 ** 4) ** 32 = 5e-8.
HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
#: A pair is dropped when the posterior probability that it reaches the similarity falls below this.
TOLERANCE = 1e-9
#: MinHash values compared between two looks at the posterior.
STEP = 16
#: Estimated similarity to a bucket's leading class from which a class is dealt with in that class's cluster.
ATTACH = 0.5
#: Classes, and shingles, of one side of a block.
BLOCK, BLOCK_SHINGLES = 1024, 4_000_000

_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, one text after the other, and where each begins; one more at the end.

    A text of fewer than k words, but not none, has one shingle of all its words.
    """
    w = words(data, bounds)
    rolled = windows(w.hash, k)
    sets = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        sets.append(np.unique(rolled[a : b - k + 1]) if b - a >= k else windows(w.hash[a:b], b - a) if b > a else w.hash[:0])
    return np.concatenate([*sets, w.hash[:0]]), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def minhash(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, HASHES) of texts that all have shingles."""
    out = np.empty((len(first) - 1, HASHES), np.uint32)
    for h in range(HASHES):
        out[:, h] = np.minimum.reduceat((mixed(shingles * _MULTIPLIERS[h]) >> np.uint64(32)).astype(np.uint32), first[:-1])
    return out


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in groups(batch.column(2)):
                shingles, first = shingle_sets(data, bounds, k)
                some = np.flatnonzero(np.diff(first))
                starts = first[some]
                signature = minhash(shingles, np.append(starts, len(shingles))) if len(some) else np.zeros((0, HASHES), np.uint32)
                digest: list[bytes | None] = [None] * (hi - lo)
                sketch: list[bytes | None] = [None] * (hi - lo)
                for d, s in zip(some.tolist(), signature, strict=True):
                    digest[d] = hashlib.blake2b(shingles[first[d] : first[d + 1]].tobytes(), digest_size=16).digest()
                    sketch[d] = s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, hi - lo) for c in (0, 1)), pa.array(digest, pa.binary()), pa.array(np.diff(first)), pa.array(sketch, pa.binary())],
                    names=["id", "fp", "class", "size", "sketch"],
                )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in groups(batch.column(1)):
                shingles, first = shingle_sets(data, bounds, k)
                sets = [shingles[first[d] : first[d + 1]].tobytes() for d in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.binary())], names=["class", "set"])

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = len(batch)
        s = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(n, BANDS, ROWS).astype(np.uint64)
        key = np.zeros((n, BANDS), np.uint64)
        for r in range(ROWS):
            key = mixed(key ^ s[:, :, r] ^ (np.uint64(r + 1) << np.uint64(40)))
        at = pa.array(np.repeat(np.arange(n), BANDS))
        yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n)), pa.array(key.view(np.int64).ravel()), batch.column(0).take(at)], names=["band", "key", "class"])


def _alike(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sketch", "other"))
            good = (a == b).mean(axis=1) >= least
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in ("class", "pop", "leader")], names=["class", "pop", "leader"])

    return run


def fewest_matches(similarity: float, tolerance: float) -> dict[int, int]:
    """After each number of compared values, the least matches with which a pair goes on.

    With m of k values equal and a uniform prior on the similarity, the posterior probability that it is at least t
    is P(Bin(k + 1, t) <= m).
    """
    out = {}
    for k in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(k + 1, m) * similarity**m * (1 - similarity) ** (k + 1 - m)
        out[k] = m
    return out


def likely_pairs(a: np.ndarray, b: np.ndarray, allowed, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature matrices that survive all looks; ``allowed(i, j)`` says which are asked for.

    The first look compares slices of all pairs, later ones only the pairs left.
    """
    left, right = [], []
    for lo in range(0, len(a), 128):
        part = a[lo : lo + 128]
        same = np.zeros((len(part), len(b)), np.int16)
        for h in range(STEP):
            same += part[:, h, None] == b[None, :, h]
        i, j = np.nonzero(same >= least[STEP])
        keep = allowed(i + lo, j)
        i, j = i[keep], j[keep]
        matches = same[i, j]
        for k in range(2 * STEP, HASHES + 1, STEP):
            if not len(i):
                break
            matches = matches + (part[i, k - STEP : k] == b[j, k - STEP : k]).sum(axis=1)
            go = matches >= least[k]
            i, j, matches = i[go], j[go], matches[go]
        left.append(i + lo)
        right.append(j)
    return np.concatenate([*left, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*right, np.zeros(0, np.int64)]).astype(np.int64)


def exact_pairs(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (i, j) of sets whose Jaccard similarity is at least ``similarity``; i is in order."""
    if not len(i):
        return i, j
    size = np.array([len(s) for s in sets])
    flat, number = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(len(flat), bool)
    keep = np.zeros(len(i), bool)
    cuts = [0, *(np.flatnonzero(np.diff(i)) + 1).tolist(), len(i)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        own = number[at[i[lo]] : at[i[lo] + 1]]
        mark[own] = True
        for part in range(lo, hi, 256):
            others = j[part : min(hi, part + 256)]
            common = np.add.reduceat(mark[np.concatenate([number[at[o] : at[o + 1]] for o in others])], np.concatenate([[0], np.cumsum(size[others])[:-1]]), dtype=np.int64)
            keep[part : part + len(others)] = common >= similarity * (len(own) + size[others] - common) - 1e-9
        mark[own] = False
    return i[keep], j[keep]


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number of each one's component."""
    label = np.arange(n)
    while len(i):
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if (least == label).all():
            break
        label = least
    return label


LINKS = "class binary, links long, root binary"


def _within(similarity: float, least: dict[int, int]):
    """All links between the classes of two blocks of a cluster, or in one: per class their weight and a local root."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, bi, bj = (k.as_py() for k in key)
        names = table.column("class").to_pylist()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint32).reshape(-1, HASHES)
        weight = table.column("n_docs").to_numpy()
        block = table.column("block").to_numpy()
        a, b = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
        ordered = (lambda i, j: i < j) if bi == bj else (lambda i, j: np.ones(len(i), bool))
        i, j = likely_pairs(sketch[a], sketch[b], ordered, least)
        sets = [np.frombuffer(s, np.uint64) for s in table.column("set").to_pylist()]
        i, j = exact_pairs(sets, a[i], b[j], similarity)
        links = np.bincount(i, weight[j], len(names)) + np.bincount(j, weight[i], len(names))
        root = local_roots(len(names), i, j)
        some = np.flatnonzero(links)
        return pa.table({"class": pa.array([names[x] for x in some], pa.binary()), "links": pa.array(links[some].astype(np.int64)), "root": pa.array([names[root[x]] for x in some], pa.binary())})

    return run


def _across(least: dict[int, int]):
    """Likely pairs of classes of different clusters in a bucket, if no band before has both."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        band, _, bi, bj = (k.as_py() for k in key)
        names = np.array(table.column("class").to_pylist(), object)
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint32).reshape(-1, HASHES)
        cluster = np.unique(np.array(table.column("cluster").to_pylist(), object), return_inverse=True)[1]
        block = table.column("block").to_numpy()
        a, b = np.flatnonzero(block == bi), np.flatnonzero(block == bj)

        def allowed(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            i, j = a[i], b[j]
            return (cluster[i] != cluster[j]) & ((i < j) if bi == bj else True)

        i, j = likely_pairs(sketch[a], sketch[b], allowed, least)
        i, j = a[i], b[j]
        before = (sketch[i, : band * ROWS] == sketch[j, : band * ROWS]).reshape(len(i), band, ROWS).all(axis=2).any(axis=1) if band else np.zeros(len(i), bool)
        i, j = i[~before], j[~before]
        return pa.table({"a": pa.array(names[i].tolist(), pa.binary()), "b": pa.array(names[j].tolist(), pa.binary())})

    return run


def _verified(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(common >= similarity * (len(x) + len(y) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good, pa.bool_())) for c in ("a", "b", "n_a", "n_b")], names=["a", "b", "n_a", "n_b"])

    return run


def _in_blocks(members: DataFrame, keys: list[str], shingles: bool) -> DataFrame:
    """Members of each group of at least two, dealt to blocks, once for each pair of blocks that has theirs."""
    total = [F.count(F.lit(1)).alias("n"), F.sum("size").alias("all")] if shingles else [F.count(F.lit(1)).alias("n")]
    sizes = members.groupBy(*keys).agg(*total).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK)
    if shingles:
        blocks = F.least(F.col("n"), F.greatest(blocks, F.ceil(F.col("all") / BLOCK_SHINGLES)))
    dealt = members.join(sizes.select(*keys, blocks.cast("int").alias("blocks")), keys)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    each = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return each.withColumn("bi", F.least("block", "o")).withColumn("bj", F.greatest("block", "o")).drop("o", "blocks")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per document: id, text_fp (a hash of the text), class_id, n_links, n_docs and representative.

    Texts with the same set of shingles are one class, so copies cost no pairs. Classes that share a band of MinHash values
    are candidates. To compare each pair once, however many bands it shares, a class joins the cluster of the class
    that leads one of its buckets and that it resembles; clusters are compared within themselves, buckets only between clusters. Both
    are cut into blocks of bounded size, and each pair of blocks is one group: it compares MinHash values step by
    step, drops pairs whose posterior probability of reaching ``similarity`` is below ``tolerance``, verifies the rest on
    the sets of 64-bit shingle hashes, and gives back a count and a root per class, not the pairs. Connected classes make
    a group; class_id is its smallest identifier, n_links the number of other documents linked to a document (its copies
    included), n_docs the group's size. representative is true for the rows of the group's smallest
    (identifier, text hash): the document that stays.

    Null texts count as empty; a text without words has no links and is its own representative, and its class_id is its
    identifier. A text of fewer than ``shingle`` words is a single shingle. Repeated rows are copies of each other and
    share one fate. Null identifiers sort last. An empty table gives an empty result. Other columns are not touched.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    three = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("fp"), text.alias("text"))
    kind = three.schema["id"].dataType.simpleString()
    rows = cut(three.mapInArrow(_sketch(shingle), f"id {kind}, fp long, class binary, size long, sketch binary"), "sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp"))
    some = rows.filter(F.col("class").isNotNull())
    classes = cut(some.groupBy("class").agg(F.count(F.lit(1)).alias("n_docs"), first.alias("first"), F.first("size").alias("size"), F.first("sketch").alias("sketch")), "classes")

    least = fewest_matches(similarity, tolerance)
    bands = classes.select("class", "sketch").mapInArrow(_bands, "band int, key long, class binary")
    buckets = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = cut(bands.join(buckets, ["band", "key"]), "buckets")
    # the class that meets most others leads a bucket: in a large family it is close to all, so few links lead elsewhere
    popular = shared.groupBy("class").agg(F.sum("n").alias("pop"))
    ranked = shared.join(popular, "class")
    top = ranked.groupBy("band", "key").agg(F.max(F.struct("pop", "class")).alias("top"))
    star = ranked.join(top, ["band", "key"]).filter(F.col("class") != F.col("top.class"))
    star = star.select("class", F.col("top.pop").alias("pop"), F.col("top.class").alias("leader")).distinct()
    sketches = classes.select("class", "sketch")
    star = star.join(sketches, "class").join(sketches.select(F.col("class").alias("leader"), F.col("sketch").alias("other")), "leader")
    attached = star.mapInArrow(_alike(ATTACH), "class binary, pop long, leader binary").groupBy("class").agg(F.max(F.struct("pop", "leader")).alias("best"))
    attached = cut(attached.select("class", "best.leader"), "attached")
    further = attached.select(F.col("class").alias("leader"), F.col("leader").alias("further"))
    attached = attached.join(further, "leader", "left").select("class", F.coalesce("further", "leader").alias("leader"))
    cluster = F.coalesce("leader", "class").alias("cluster")
    clusters = cut(popular.join(attached, "class", "left").select("class", cluster).join(classes, "class"), "clusters")

    between = shared.select("band", "key", "class").join(clusters.select("class", "cluster"), "class")
    mixed_buckets = between.groupBy("band", "key").agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi")).filter("lo < hi").select("band", "key")
    between = _in_blocks(between.join(mixed_buckets, ["band", "key"]), ["band", "key"], False).join(sketches, "class")
    pairs = cut(between.groupBy("band", "key", "bi", "bj").applyInArrow(_across(least), "a binary, b binary"), "pairs")

    within = cut(_in_blocks(clusters.select("cluster", "class", "size"), ["cluster"], True), "units")
    wanted = within.select("class").union(pairs.select("a")).union(pairs.select("b")).distinct()
    source = wanted.join(classes, "class").select("class", "first.id", "first.fp")
    texts = three.join(
        source.withColumnsRenamed({"id": "_id", "fp": "_fp"}).hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")),
    ).select("class", "text")
    sets = texts.mapInArrow(_sets(shingle), "class binary, set binary").groupBy("class").agg(F.first("set").alias("set"))
    sets = cut(sets, "sets")

    units = within.join(classes.select("class", "n_docs", "sketch"), "class").join(sets, "class")
    inside = units.groupBy("cluster", "bi", "bj").applyInArrow(_within(similarity, least), LINKS)
    a_side = sets.join(classes, "class").select(F.col("class").alias("a"), F.col("set").alias("set_a"), F.col("n_docs").alias("n_a"))
    b_side = a_side.select(F.col("a").alias("b"), F.col("set_a").alias("set_b"), F.col("n_a").alias("n_b"))
    sure = pairs.join(a_side, "a").join(b_side, "b").mapInArrow(_verified(similarity), "a binary, b binary, n_a long, n_b long")
    outside = sure.select(F.explode(F.array(
        F.struct(F.col("a").alias("class"), F.col("n_b").alias("links"), F.least("a", "b").alias("root")),
        F.struct(F.col("b").alias("class"), F.col("n_a").alias("links"), F.least("a", "b").alias("root")),
    )).alias("x")).select("x.*")
    links = cut(inside.union(outside), "links")

    groups_of = components(links.select(F.col("class").alias("a"), F.col("root").alias("b")))
    linked = links.groupBy("class").agg(F.sum("links").alias("links"))
    per_class = classes.select("class", "n_docs", "first").join(groups_of.withColumnRenamed("node", "class"), "class", "left").join(linked, "class", "left")
    per_class = per_class.withColumn("root", F.coalesce("root", "class"))
    whole = per_class.groupBy("root").agg(F.sum("n_docs").alias("all_docs"), F.min("first").alias("group_first"))
    per_class = per_class.join(whole, "root").select(
        "class", "all_docs", "group_first", (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links"),
    )
    met = rows.select("id", "fp", "class").join(per_class, "class", "left")
    same = F.col("id").eqNullSafe(F.col("group_first.id")) & (F.col("fp") == F.col("group_first.fp"))
    return met.select(
        F.col("id").alias(id_col), F.col("fp").alias("text_fp"), F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("group_first.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("all_docs", F.lit(1)).cast("long").alias("n_docs"),
        (F.col("class").isNull() | same).alias("representative"),
    )
