"""Benchmark decontamination: a prefix-filtered set join between texts and windows of benchmark items."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.words import POWERS, Words, groups, mixed, spelled, windows, words
from plantpulse.session import cut

WINDOW = 10
#: Window starts of an item that make a chunk, the unit in which items are dealt to tasks.
CHUNK = 2048
#: Bits of a filter are chosen by so many bits of a hash, so a filter has 1 MB whatever the tables' size.
FILTER_BITS = 23
PAGE = 1 << 15
#: A word is frequent when it makes up this share of all counted words; at most 1 / SHARE words are.
SHARE = 1 / 256

RANGES = "array<struct<start:int,end:int>>"


class Filters(NamedTuple):
    vocabulary: np.ndarray  # bit per word of a window
    prefix: np.ndarray  # bit per necessary word
    placed: np.ndarray  # bit per (necessary word, its place, window)
    forms: list[tuple[int, int]]  # (words of a window, place of the necessary word)
    frequent: dict[int, int]  # frequent words and the parts their rows are dealt to


def bit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def placed(prefix: np.ndarray, offset: int, window: np.ndarray) -> np.ndarray:
    """One hash of a necessary word, its place and its window: equal for a text's words and an item's."""
    return mixed(prefix * POWERS[3:4] + window + POWERS[5 + offset])


def filter_of(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits of a column of hashes, put together in the tasks; the driver gets 256 pages of 4 KB at most."""
    at = F.shiftrightunsigned(F.col(column), 64 - FILTER_BITS) + 1
    pages = hashes.groupBy(F.bitmap_bucket_number(at).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(1 << FILTER_BITS, bool)
    for page, bits in pages.collect():
        out[(page - 1) * PAGE : page * PAGE] = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
    return out


def _chunks(size: int, starts: int):
    """Items (identifier, text) to (item, chunk, k, spelling): each chunk has the words of at most ``starts`` windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in groups(batch.column(1)):
                w = words(data, bounds)
                for r in range(lo, hi):
                    a, b = int(w.first[r - lo]), int(w.first[r - lo + 1])
                    k = min(size, b - a)
                    for s in range(a, b - k + 1 if k else a, starts):
                        text = spelled(w, s, min(starts + k - 1, b - s))
                        chunk = hashlib.blake2b(text, digest_size=16, person=str(k).encode()).digest()
                        row = [batch.column(0).slice(r, 1), pa.array([chunk]), pa.array([k], pa.int32()), pa.array([text])]
                        yield pa.RecordBatch.from_arrays(row, names=["item", "chunk", "k", "spelling"])

    return run


def _of_spelling(text: bytes) -> Words:
    return words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))


def _chunk_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            h = np.unique(_of_spelling(text).hash)
            yield pa.RecordBatch.from_arrays([pa.array([chunk.as_py()] * len(h), pa.binary()), pa.array(h.view(np.int64))], names=["chunk", "word"])


def _counted(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for _, _, data, bounds in groups(batch.column(0)):
                h = words(data, bounds).hash
                word, n = np.unique(h[known[bit(h)]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return run


WINDOWS = "window binary, chunk binary, k int, offset int, prefix long, hash long, placed long, spelling binary"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of chunks (chunk, k, spelling, counts of its words), each with its rarest word."""
    for batch in batches:
        for chunk, k, text, counted in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            w = _of_spelling(text)
            rarity = sorted((c["n"], c["word"]) for c in counted)
            rank = {word: i for i, (_, word) in enumerate(rarity)}
            order = np.array([rank[h] for h in w.hash.view(np.int64).tolist()], np.int64)
            rolled = windows(w.hash, k)
            offset = np.lib.stride_tricks.sliding_window_view(order, k).argmin(axis=1)
            prefix = w.hash[np.arange(len(rolled)) + offset]
            place = np.array([placed(prefix[i : i + 1], int(o), rolled[i : i + 1])[0] for i, o in enumerate(offset)], np.uint64)
            spelling = [spelled(w, s, k) for s in range(len(rolled))]
            window = [hashlib.blake2b(s, digest_size=16).digest() for s in spelling]
            longs = [pa.array(x.view(np.int64)) for x in (prefix, rolled, place)]
            columns = [pa.array(window), pa.array([chunk] * len(rolled)), pa.array([k] * len(rolled), pa.int32()), pa.array(offset, pa.int32()), *longs, pa.array(spelling)]
            yield pa.RecordBatch.from_arrays(columns, names=["window", "chunk", "k", "offset", "prefix", "hash", "placed", "spelling"])


def occurrences(w: Words, known: Filters) -> Iterator[tuple[int, int, np.ndarray]]:
    """(k, offset, starts) of places that hold a necessary word where a window has it, in a text's bounds."""
    place = np.flatnonzero(known.prefix[bit(w.hash)])
    text = np.searchsorted(w.first, place, "right") - 1
    rolled: dict[int, np.ndarray] = {}
    for k, offset in known.forms:
        s = place - offset
        inside = (s >= w.first[text]) & (s + k <= w.first[text + 1])
        s = s[inside]
        if len(s):
            if k not in rolled:
                rolled[k] = windows(w.hash, k)
            s = s[known.placed[bit(placed(w.hash[s + offset], offset, rolled[k][s]))]]
        if len(s):
            yield k, offset, s


CANDIDATES = "fp binary, start int, k int, offset int, prefix long, hash long, part int, spelling binary"


def _candidates(sent):
    """Texts (hash, text) to the windows that may be an item's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for lo, _, data, bounds in groups(batch.column(1)):
                w = words(data, bounds)
                for k, offset, s in occurrences(w, known):
                    d = np.searchsorted(w.first, s, "right") - 1
                    prefix = w.hash[s + offset].view(np.int64)
                    parts = np.array([known.frequent.get(p, 1) for p in prefix.tolist()])
                    part = mixed(s.astype(np.uint64) + (lo + d).astype(np.uint64) * POWERS[2]) % parts.astype(np.uint64)
                    columns = [
                        batch.column(0).take(pa.array(lo + d)), pa.array(s - w.first[d], pa.int32()), pa.array(np.full(len(s), k, np.int32)),
                        pa.array(np.full(len(s), offset, np.int32)), pa.array(prefix), pa.array(windows(w.hash, k)[s].view(np.int64)),
                        pa.array(part.astype(np.int32)), pa.array([spelled(w, x, k) for x in s.tolist()], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["fp", "start", "k", "offset", "prefix", "hash", "part", "spelling"])

    return run


def _n_words(text_at: int, names: list[str]):
    """names: columns to give back, the first ones of those that come in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [np.diff(words(data, bounds).first) for _, _, data, bounds in groups(batch.column(text_at))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(np.concatenate([*n, np.zeros(0, np.int64)]))], names=[*names, "n_words"])

    return run


def merged(ranges: Column) -> Column:
    """Sorted ranges without overlaps, touching ones put together; as few array copies as there are results."""

    def put(state: Column, r: Column) -> Column:
        apart = r["start"] > state["end"]
        done = F.when(apart, F.concat(state["done"], F.array(F.struct(state["start"].alias("start"), state["end"].alias("end"))))).otherwise(state["done"])
        return F.struct(done.alias("done"), F.when(apart, r["start"]).otherwise(state["start"]).alias("start"), F.greatest(state["end"], r["end"]).alias("end"))

    in_order = F.array_sort(ranges)
    zero = F.struct(F.array().cast(RANGES).alias("done"), F.get(in_order, F.lit(0))["start"].alias("start"), F.get(in_order, F.lit(0))["end"].alias("end"))
    return F.aggregate(in_order, zero, put, lambda s: F.concat(s["done"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))


def item_windows(items: DataFrame, texts: DataFrame, window: int, chunk: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Windows of ``items`` with their rarest word in ``texts``, (window, item) pairs, and frequent words with their parts.

    A window's words are counted in the tasks behind a filter of the benchmark's words; the counts meet the chunks by a
    join on the word, whose hot words are dealt to several parts by the chunk.
    """
    spark = texts.sparkSession
    dealt = items.repartition(F.xxhash64("text"))
    all_chunks = cut(dealt.mapInArrow(_chunks(window, chunk), "item string, chunk binary, k int, spelling binary"), "chunks")
    chunks = all_chunks.dropDuplicates(["chunk"]).select("chunk", "k", "spelling")
    parts = 16
    chunk_words = cut(chunks.select("chunk", "spelling").mapInArrow(_chunk_words, "chunk binary, word long"), "chunk-words")
    vocabulary = filter_of(chunk_words.distinct(), "word")
    counted = texts.select("text").mapInArrow(_counted(spark.sparkContext.broadcast(vocabulary)), "word long, n long")
    counts = cut(counted.groupBy("word").agg(F.sum("n").alias("n")), "counts")
    spread = counts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = chunk_words.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int")).join(spread, ["word", "part"], "left")
    rarity = met.groupBy("chunk").agg(F.collect_list(F.struct("word", F.coalesce("n", F.lit(0)).alias("n"))).alias("counted"))
    found = chunks.join(rarity, "chunk").select("chunk", "k", "spelling", "counted").mapInArrow(_windows, WINDOWS)
    found = cut(found, "windows")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # parts in proportion, so that no part of a word has more than SHARE of all words
    hot = counts.filter(F.col("n") >= F.lit(total * SHARE)).withColumn("parts", (1 + F.floor(F.col("n") / F.lit(max(total, 1) * SHARE))).cast("int"))
    owners = found.select("window", "chunk").join(all_chunks.filter(F.col("item").isNotNull()).select("chunk", "item").distinct(), "chunk")
    distinct = found.drop("chunk").dropDuplicates(["window"])
    hot = hot.select(F.col("word").alias("prefix"), "parts")
    return cut(distinct.join(hot, "prefix", "left").fillna(1, ["parts"]), "distinct-windows"), owners.select("window", "item").distinct(), hot


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, chunk: int = CHUNK, keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs`` and n_words, hits (word ranges inside occurrences of windows), n_hit and items (sorted as strings).

    A window is ``window`` consecutive words of an item, or all of a shorter item. The words of the windows are counted
    over all documents, and each window's rarest word is its necessary prefix: a text that contains the window contains
    that word. Documents are read once for the counts, once for candidates and once for the result, whatever the size of
    the benchmark; items are dealt in chunks of ``chunk`` windows. A place in a text is a candidate where a necessary word
    stands, the window lies within the text's bounds, and a filter of 1 MB knows word, place and rolling hash; the filters
    let some too many through when the benchmark is large, never too few. Candidates and windows are joined on the word,
    its place and the hash, frequent words in several parts, and the spelled words decide. Results belong to a text, so
    copies share one; they come back by a join on the text's hash, which Spark broadcasts below its threshold or else
    splits where it is skewed.

    Null texts have no words, on either side. An item without an identifier marks words but isn't listed; items that
    share an identifier are one. Repeated documents are judged each for itself. Empty tables give empty hits or an
    empty result. Other columns are kept; n_words, hits, n_hit and items replace columns of those names.
    """
    spark = docs.sparkSession
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "hits", "n_hit", "items")]
    fp = "_text"
    while fp in docs.columns:
        fp = f"_{fp}"
    digest = F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256))
    texts = docs.select(digest.alias("fp"), F.col(f"`{text_col}`").alias("text")).filter(F.length("text") > 0)
    known = items.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{item_text_col}`").alias("text")).filter(F.length("text") > 0)

    marks, owners, hot = item_windows(known, texts, window, chunk)
    forms = [tuple(r) for r in marks.select("k", "offset").distinct().collect()]  # at most window * (window + 1) / 2
    frequent = dict(hot.collect()) if forms else {}  # at most 1 / SHARE words
    filters = Filters(np.zeros(0, bool), filter_of(marks, "prefix"), filter_of(marks, "placed"), forms, frequent)
    candidates = texts.mapInArrow(_candidates(spark.sparkContext.broadcast(filters)), CANDIDATES)
    # copies of a text give the same candidates, whatever part each is dealt to
    candidates = candidates.dropDuplicates(["fp", "start", "k", "offset"])
    in_parts = marks.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    same = ["prefix", "part", "k", "offset", "hash", "spelling"]
    sure = cut(candidates.join(in_parts.select("window", *same), same).select("fp", "start", "k", "window", "part"), "hits")

    reach = F.struct(F.col("start"), (F.col("start") + F.col("k")).alias("end"))
    hits = sure.groupBy("fp").agg(merged(F.collect_set(reach)).alias("hits"))
    owned = owners.join(in_parts.select("window", "part"), "window")
    held = sure.select("fp", "window", "part").distinct().join(owned, ["window", "part"]).groupBy("fp").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = cut(hits.join(held, "fp", "left"), "found")

    whole = [*names, fp, *([] if text_col in names else [text_col])]
    source = docs.withColumn(fp, digest).select(*[F.col(f"`{c}`") for c in whole])
    back = source.select(*[F.col(f"`{c}`") for c in whole[: len(names) + 1]])
    read = source.mapInArrow(_n_words(source.columns.index(text_col), back.columns), back.schema.add("n_words", "long"))
    judged = read.join(found.withColumnRenamed("fp", fp), fp, "left")
    n_hit = F.aggregate("hits", F.lit(0), lambda total, r: total + r["end"] - r["start"])
    return judged.select(
        *[F.col(f"`{c}`") for c in names], "n_words", F.coalesce("hits", F.array().cast(RANGES)).alias("hits"),
        F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
