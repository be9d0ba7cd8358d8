"""Training-order materialisation: token sequences in fixed-stride binary shards, in a keyed random order."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantpulse.llm.packing import piece_bounds
from plantpulse.llm.tokens import END, encoder, vocabulary_path
from plantpulse.session import scratch

SEQUENCE = 256
SHARD_SLOTS = 16_384
#: Fills a slot's rest; not an id, as vocabularies of this format have fewer than 65,535.
PAD = 0xFFFF
ROUNDS = 6
#: Of the compression of sequences on their way; ids take a sixth less room than at the default level.
LEVEL = 9
#: Ids compressed together: a long reach makes them a tenth smaller.
PAGE_BYTES, BUNDLE_BYTES = 8 << 20, 32 << 20


def feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 ... n - 1, applied to ``index``.

    A balanced Feistel network permutes the smallest domain of 4^b numbers that holds them; numbers that land at n or beyond
    walk on along their cycle until they are below n, so it stays one-to-one.
    """
    bits = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << bits) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(bits), x & mask
        for r in range(ROUNDS):
            f = right + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xBF58476D1CE4E5B9) & ((1 << 64) - 1))
            f = (f ^ (f >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f ^ (f >> np.uint64(31))) & mask)
        return (left << np.uint64(bits)) | right

    out = once(index.astype(np.uint64))
    while len(beyond := np.flatnonzero(out >= np.uint64(n))):
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


def _tokenise(path: str, size: int, end: int):
    """Sequences numbered within their task: (part, pos, id, piece, ids as little-endian 16 bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, pos = encoder(path).encode_ordinary, TaskContext.get().partitionId(), 0
        for batch in batches:
            row, piece, ids = [], [], []
            for r, text in enumerate(batch.column(1)):
                raw = np.array([*encode(text.as_py() or ""), end], "<u2")
                for p, (s, n) in enumerate(piece_bounds(len(raw), size)):
                    row.append(r)
                    piece.append(p)
                    ids.append(raw[s : s + n].tobytes())
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(row), pa.int32()), pa.array(range(pos, pos + len(row)), pa.int64()), batch.column(0).take(at), pa.array(piece, pa.int32()), pa.array(ids, pa.binary())],
                names=["part", "pos", "id", "piece", "ids"],
            )
            pos += len(row)

    return run


def _bundle(bases: dict[int, int], n: int, key: int, shard_slots: int):
    """Slots of sequences, and what of BUNDLE_BYTES of them goes to one shard as one compressed row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=LEVEL).compress

        def bundled(rows: pa.Table) -> pa.RecordBatch:
            part, pos, piece = (rows.column(c).to_numpy() for c in ("part", "pos", "piece"))
            doc = rows.column("id").fill_null(0).to_numpy()
            known = rows.column("id").is_valid().to_numpy()
            raw = rows.column("ids").to_pylist()
            which, at = np.unique(part, return_inverse=True)
            slot = feistel(np.array([bases[p] for p in which.tolist()], np.int64)[at] + pos, n, key)
            by = np.argsort(slot)
            shard = slot[by] // shard_slots
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(by)]
            shards, bundles = [], []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                own = by[lo:hi]
                ids = [raw[i] for i in own]
                head = np.array([slot[own], doc[own], known[own], piece[own], [len(x) for x in ids]], "<i8")
                shards.append(int(shard[lo]))
                bundles.append(pack(np.int64(len(own)).tobytes() + head.tobytes() + b"".join(ids)))
            return pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(bundles, pa.binary())], names=["shard", "bundle"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= BUNDLE_BYTES:
                yield bundled(pa.Table.from_batches(held))
                held, size = [], 0
        if sum(map(len, held)):
            yield bundled(pa.Table.from_batches(held))

    return run


def _filesystem(uri: str):
    """The file system of a shared folder and the path in it; both local and remote ones."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def shard_name(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:09d}.bin"


def _write(folder: str, size: int, shard_slots: int, n: int):
    """One shard: its bundles put at their slots, written under another name and then renamed, so that a task that
    runs again leaves the same file."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        shard = key[0].as_py()
        first = shard * shard_slots
        out = np.full((min(shard_slots, n - first), size), PAD, "<u2")
        index = []
        for bundle in table.column("bundle"):
            data = unpack(bundle.as_py())
            count = int(np.frombuffer(data, "<i8", 1)[0])
            slot, doc, known, piece, length = np.frombuffer(data, "<i8", 5 * count, 8).reshape(5, count)
            at = 8 + 40 * count
            for s, k in zip((slot - first).tolist(), length.tolist(), strict=True):
                out[s, : k // 2] = np.frombuffer(data, "<u2", k // 2, at)
                at += k
            index.append((slot, doc, known, piece))
        system, path = _filesystem(folder)
        system.create_dir(path, recursive=True)
        temporary = f"{shard_name(path, shard)}.{TaskContext.get().taskAttemptId()}"
        with system.open_output_stream(temporary) as stream:
            stream.write(out.tobytes())
        system.move(temporary, shard_name(path, shard))
        slot, doc, known, piece = (np.concatenate(x) for x in zip(*index, strict=True))
        by = np.argsort(slot)
        slot, doc, known, piece = slot[by], doc[by], known[by], piece[by]
        return pa.table({
            "slot": pa.array(slot), "shard": pa.array(np.full(len(slot), shard)), "id": pa.array(doc, mask=known == 0), "piece": pa.array(piece.astype(np.int32)),
        })

    return run


def write_shards(
    docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, key: int = 1,
    shard_slots: int = SHARD_SLOTS, path: str | None = None, end: int = END,
) -> tuple[str, DataFrame]:
    """Write the shards; gives their folder and the index of slots: slot, shard, id, piece.

    A document's ids and ``end`` are cut into sequences of ``size`` ids, the first of which may be shorter. Sequences are
    numbered densely (by task, then in it); a keyed Feistel permutation with cycle-walking gives each number its global
    slot. A shard is a range of ``shard_slots`` slots, one file of fixed-stride records of ``size`` 16-bit ids, padded with
    PAD: slot s lies in shard s div ``shard_slots`` at byte (s mod ``shard_slots``) * ``size`` * 2, so a reader can start
    at any slot and go on from there. What a task has for a shard travels as one compressed row. A task writes one
    shard at a time and holds ``shard_slots`` * ``size`` * 2 bytes, whatever the input. The folder must be one that all
    executors share; by default it is a new one below spark.checkpoint.dir.

    Null and empty texts are one sequence of ``end``. Null identifiers stay null in the index. Rows that repeat an
    identifier have sequences each. An empty table writes no shard and gives an empty index. Other columns are not read.
    """
    spark = docs.sparkSession
    store = folder or scratch(spark, "shards")
    work = scratch(spark, "sequences")
    two = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col))
    found = two.mapInArrow(_tokenise(path or vocabulary_path(), size, end), "part int, pos long, id long, piece int, ids binary")
    found.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", LEVEL).option("parquet.page.size", PAGE_BYTES).parquet(work)
    rows = spark.read.schema(found.schema).parquet(work)
    bases, n = {}, 0
    for part, count in sorted(rows.groupBy("part").agg(F.count(F.lit(1))).collect()):  # one row per task
        bases[part] = n
        n += count
    bundles = rows.mapInArrow(_bundle(bases, n, key, shard_slots), "shard long, bundle binary")
    index = bundles.groupBy("shard").applyInArrow(_write(store, size, shard_slots, n), "slot long, shard long, id long, piece int")
    index.write.parquet(f"{work}-index")
    return store, spark.read.schema(index.schema).parquet(f"{work}-index").withColumnRenamed("id", id_col)


def _read(folder: str, size: int, shard_slots: int, names: list[str]):
    """Rows of the index with the ids of their slots; a batch reads each shard's part in one go."""
    stride = size * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            ids: list[bytes] = [b""] * len(slot)
            for shard in np.unique(slot // shard_slots).tolist():
                own = np.flatnonzero(slot // shard_slots == shard)
                first, last = int(slot[own].min()), int(slot[own].max())
                system, path = _filesystem(folder)
                with system.open_input_file(shard_name(path, shard)) as file:
                    file.seek((first - shard * shard_slots) * stride)
                    records = np.frombuffer(file.read((last + 1 - first) * stride), "<u2").reshape(-1, size)
                for i, s in zip(own.tolist(), (slot[own] - first).tolist(), strict=True):
                    ids[i] = records[s][records[s] != PAD].astype("<u4").tobytes()
            added = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
            if "ids" in names:
                added.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    return run


def read_slots(index: DataFrame, folder: str, size: int = SEQUENCE, shard_slots: int = SHARD_SLOTS, with_ids: bool = True) -> DataFrame:
    """The index's rows with length, ids_crc32 and (little-endian 32-bit) ids read from their slots.

    The index lists a shard's slots in order, so a task reads its part of a shard in one go, wherever it starts; filter the
    index to go on from a slot. There is no exchange.
    """
    added = "length long, ids_crc32 long" + ", ids binary" * with_ids
    schema = T.StructType([*index.schema.fields, *T._parse_datatype_string(added).fields])
    return index.mapInArrow(_read(folder, size, shard_slots, schema.names), schema)
