"""Packing and token shards: exact ids, gapless sequences, round trips."""

import random
import zlib

import numpy as np
import pytest

from plantpulse.llm.packing import pack, piece_bounds, sweep
from plantpulse.llm.token_shards import feistel, read_slots, shard_name, write_shards
from plantpulse.llm.tokens import END, encoder, vocabulary_path

TRICKY = [
    "", None, "a", " ", "  two  blanks ", "\n\n x\n", "it's we'll I'D 'S", "naïve Ünïcödé 𝒳𝒴 ß", "12 345,678.9", "tab\t\tend\r\n", "日本語 テキスト", "<|endoftext|> in a text",
    "!!!???", "a" * 3000, "é combining", " nbsp em", "x\x00y", "١٢٣ ६", "🙂🙂 ok", "word " * 2000,
]


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("text", TRICKY)
def test_ids(text):
    assert encoder(vocabulary_path()).encode_ordinary(text or "") == reference_ids(text)


def test_ids_of_random_texts():
    rng = random.Random(2)
    signs = "ab Z'sdtml \n\t.,1é9ßИ日🙂　-$"
    for _ in range(300):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(40)))
        assert encoder(vocabulary_path()).encode_ordinary(text) == reference_ids(text)


@pytest.mark.parametrize("n", [1, 5, 8, 9, 16, 17])
def test_piece_bounds(n):
    got = piece_bounds(n, 8)
    assert sum(k for _, k in got) == n and [s for s, _ in got] == [sum(k for _, k in got[:i]) for i in range(len(got))]
    assert all(k == 8 for _, k in got[1:]) and (n > 8 or len(got) == 1)


def best_fit_decreasing(lengths, size):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps[gaps.index(min(fit))] -= n
        else:
            gaps.append(size - n)
    return sorted(gaps)


@pytest.mark.parametrize("seed", range(12))
def test_sweep_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    size = rng.choice([7, 20, 64])
    lengths = [rng.randint(1, size) if rng.random() < 0.6 else rng.randint(1, 3) for _ in range(rng.randrange(0, 300))]
    counts = np.bincount(lengths, minlength=size + 1)
    used, seen = {}, {}
    for length, first, n, per, sequence, offset in sweep(counts).tolist():
        for r in range(n):
            assert (length, first + r) not in seen
            seen[length, first + r] = True
            used.setdefault(sequence + r // per, []).append((offset + r % per * length, length))
    assert len(seen) == len(lengths) and all((n, r) in seen for n in set(lengths) for r in range(counts[n]))
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    assert sorted(size - sum(n for _, n in p) for p in used.values()) == best_fit_decreasing(lengths, size)


def test_pack(spark, rows):
    data = [(i if i % 9 else None, t) for i, t in enumerate(TRICKY * 3)]
    got = pack(rows([(*d, 1, "x") for d in data], "doc_id long, text string, part int, rank string").repartition(4), size=64, parts=4).collect()
    wanted = sorted((crc([*reference_ids(t), END][s : s + n]), s, n) for _, t in data for s, n in piece_bounds(len(reference_ids(t)) + 1, 64))
    assert sorted((r.ids_crc32, r.start, r.length) for r in got) == wanted
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        assert [o for o, _ in sorted(places)] == [sum(n for _, n in sorted(places)[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 64
    assert len(by) == len(best_fit_decreasing([n for _, _, n in wanted], 64))
    assert pack(rows([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    a, b = feistel(np.arange(n), n, 1), feistel(np.arange(n), n, 2)
    assert sorted(a) == sorted(b) == list(range(n))
    assert n < 100 or ((a != b).mean() > 0.9 and (a != np.arange(n)).mean() > 0.9)


def test_shards_round_trip(spark, rows, tmp_path):
    data = [(i if i % 9 else None, t) for i, t in enumerate(TRICKY)]
    docs = rows([(*d, 1) for d in data], "doc_id long, text string, slot int").repartition(3)
    folder, index = write_shards(docs, folder=str(tmp_path / "shards"), size=16, shard_slots=50)
    wanted = [(i, p, [*reference_ids(t), END][s : s + n]) for i, t in data for p, (s, n) in enumerate(piece_bounds(len(reference_ids(t)) + 1, 16))]
    read = read_slots(index, folder, 16, 50).collect()
    assert sorted(r.slot for r in read) == list(range(len(wanted))) and all(r.shard == r.slot // 50 for r in read)
    got = {r.slot: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in read}
    assert all(r.length == len(got[r.slot]) and r.ids_crc32 == crc(got[r.slot]) for r in read)
    key = lambda x: (x[0] or -1, x[1], x[2])
    assert sorted(((r.doc_id, r.piece, got[r.slot]) for r in read), key=key) == sorted(wanted, key=key)
    # any slot is at its place by arithmetic, and a reader may go on from there
    raw = np.fromfile(shard_name(folder, 1), "<u2").reshape(-1, 16)
    assert raw[7][: len(got[57])].tolist() == got[57] and len(raw) == min(50, len(wanted) - 50)
    assert {r.slot: r.ids_crc32 for r in read_slots(index.filter("slot >= 57"), folder, 16, 50, with_ids=False).collect()} == {s: crc(got[s]) for s in range(57, len(wanted))}
    # written again, the order is the same for the same key
    again, _ = write_shards(docs, folder=str(tmp_path / "again"), size=16, shard_slots=50)
    assert (tmp_path / "again/shard-000000001.bin").read_bytes() == (tmp_path / "shards/shard-000000001.bin").read_bytes()


def test_no_documents_make_no_shards(spark, rows, tmp_path):
    folder, index = write_shards(rows([], "doc_id long, text string"), folder=str(tmp_path / "none"))
    assert index.count() == 0 and read_slots(index, folder).count() == 0
