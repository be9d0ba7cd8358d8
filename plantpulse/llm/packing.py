"""Best-fit packing of documents' tokens into sequences of bounded length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plantpulse.llm.tokens import END, encoder, vocabulary_path
from plantpulse.session import cut

SEQUENCE = 1024
#: Parts in which the pieces of one length are ranked, so that no length is one task's.
PARTS = 1024
PIECE = "piece int, start long, length long, ids_crc32 long"
RANK_BITS = 44


def piece_bounds(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all of ``size`` but the first, which takes the rest."""
    first = n % size or min(n, size)
    return [(0, first), *((s, size) for s in range(first, n, size))]


def _pieces(path: str, size: int, end: int | None):
    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for r, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "")
                if end is not None:
                    ids.append(end)
                raw = np.array(ids, "<u4").tobytes()
                for p, (s, n) in enumerate(piece_bounds(len(ids), size) if ids else []):
                    row.append(r)
                    piece.append(p)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(raw[4 * s : 4 * (s + n)]))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns, names=[batch.schema.names[0], "piece", "start", "length", "ids_crc32"])

    return cut_up


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, path: str | None = None, end: int | None = END) -> DataFrame:
    """Pieces of the documents' tokens: id, piece, start, length, ids_crc32."""
    kind = docs.schema[id_col].dataType.simpleString()
    two = docs.select(F.col(id_col), F.col(text_col))
    return two.mapInArrow(_pieces(path or vocabulary_path(), size, end), f"`{id_col}` {kind}, {PIECE}")


def sweep(counts: np.ndarray) -> np.ndarray:
    """Best-fit matches for ``counts[n]`` pieces of each length n, the sequence length being ``len(counts) - 1``.

    Pieces of a length and gaps of a size are interchangeable, so the sorted documents and gaps are runs of equal ones.
    Superstep by superstep, from the longest length down: each piece's successor among the gaps is the smallest that holds
    it; of more pieces than gaps the first by rank win, in order, as many in a gap as it holds; the gaps are updated; what
    is left looks for the next larger gaps, then opens sequences. That repeats until nothing is left. A row is
    (length, first rank, pieces, pieces a gap, first sequence, offset in it): ranks ``first ... first + pieces`` go to
    gaps in turn. There are a few rows for each length, whatever the number of pieces, as a superstep splits one run of
    gaps at most.
    """
    size = len(counts) - 1
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
    rows, opened = [], 0
    for length in range(size, 0, -1):
        left, rank = int(counts[length]), 0
        gap = length
        while left:
            while gap <= size and not gaps[gap]:
                gap += 1
            if gap > size:
                per = size // length
                gaps[size].append((opened, -(-left // per)))
                opened += -(-left // per)
                gap = size
            first, n = gaps[gap].pop()
            per = gap // length
            full = min(n, left // per)
            if full:
                rows.append((length, rank, full * per, per, first, size - gap))
                gaps[gap - per * length].append((first, full))
                rank, left = rank + full * per, left - full * per
            if full < n and left and left < per:
                rows.append((length, rank, left, left, first + full, size - gap))
                gaps[gap - left * length].append((first + full, 1))
                full, left = full + 1, 0
            if full < n:
                gaps[gap].append((first + full, n - full))
    return np.array(rows, np.int64).reshape(-1, 6)


def _placed(matches: np.ndarray, id_col: str, size: int):
    """Ranked pieces with their sequence and offset: the match whose ranks hold a piece's rank."""
    codes = (matches[:, 0] << RANK_BITS) | matches[:, 1]
    by = np.argsort(codes)
    codes, matches = codes[by], matches[by]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            m = matches[np.searchsorted(codes, (length << RANK_BITS) | rank, "right") - 1]
            within = rank - m[:, 1]
            sequence = m[:, 4] + within // m[:, 3]
            offset = m[:, 5] + within % m[:, 3] * length
            columns = [batch.column(c) for c in (id_col, "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=[id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return place


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, path: str | None = None, end: int | None = END, parts: int = PARTS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Every document is its token ids and ``end``; only longer ones than ``size`` are cut. Pieces are counted by length; the
    best-fit sweep (see there) works on these at most ``size`` counts, and its matches are ranges of ranks. Pieces get
    their rank among those of their length in parallel, in ``parts`` parts that start where the parts before end, and
    look their match up. So the driver and each task hold a few rows per length, however many documents there are, and
    a length that a third of all pieces has is ranked by ``parts`` tasks.

    Null and empty texts are a single ``end`` (no piece if ``end`` is None). Rows that repeat an identifier are packed each
    for itself; equal pieces are interchangeable. An empty table gives an empty result. Other columns are not touched.
    """
    rows = cut(pieces(docs, id_col, text_col, size, path, end).withColumn("part", F.pmod(F.xxhash64(id_col, "piece"), F.lit(parts)).cast("int")), "pieces")
    kind = rows.schema[id_col].dataType.simpleString()
    per_part = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(size + 1, np.int64)
    for length, n in per_part.groupBy("length").agg(F.sum("n")).collect():  # at most ``size`` rows
        counts[length] = n
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = per_part.select("length", "part", before.alias("before"))
    order = W.partitionBy("length", "part").orderBy(id_col, "piece", "ids_crc32")
    ranked = rows.join(starts, ["length", "part"]).withColumn("rank", F.col("before") + F.row_number().over(order) - 1)
    schema = f"`{id_col}` {kind}, {PIECE}, sequence_id long, offset long"
    return ranked.select(id_col, "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_placed(sweep(counts), id_col, size), schema)
