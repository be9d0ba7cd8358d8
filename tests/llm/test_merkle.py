"""Merkle manifest against plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from plantpulse.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row, lower=False) -> str:
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    parts = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return digest("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root and, per leaf, (left, right) siblings on each level."""
    paths, spots, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for path, at in zip(paths, spots):
            run = level[at // 16 * 16: at // 16 * 16 + 16]
            path.append(("".join(run[: at % 16]), "".join(run[at % 16 + 1:])))
        level = [digest("".join(level[i:i + 16])) for i in range(0, len(level), 16)]
        spots = [at // 16 for at in spots]
    return level[0], paths


def brute(rows) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    root, upper = tree([built[s][0] for s in order])
    out = []
    for s, above in zip(order, upper):
        for (_, _, leaf, row), path in zip(sorted(groups[s], key=lambda x: x[:3]), built[s][1]):
            path = path + above
            folded = leaf_of(row, lower=True) if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 else leaf
            for left, right in path:
                folded = digest(left + folded + right)
            out.append((row[0], leaf, built[s][0], root, digest("".join(a + b for a, b in path)), folded, folded == root))
    return out


def key(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


def spark_rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=key)


CASES = {
    "many": [(i, f"Text Number {i}", "en" if i % 3 else None, ["a", "b", None, "ä"][i % 4] if i % 2 else "a", i) for i in range(700)],
    "odd": [(1, None, None, None, None), (1, "", "", "", 0), (None, "X", "en", "s", 3), (None, None, "en", "s", 3), (7, "A" * 100_000, "en", "s", -5),
            (7, "A" * 100_000, "en", "s", -5), (7, "a", "en", "s", 1), (25, "2:AB", "-", "1s", 1), (26, "Ünïcode ß", "de", "1s", 9)],
    "copies": [(5, "Same", "en", "s", 4)] * 40 + [(6, "other", "en", "t", 5)],
    "one": [(10, "Only", "en", "s", 4)],
    "power": [(i, f"T{i}", "en", "s", i) for i in range(256)] + [(i, f"T{i}", "en", "t", i) for i in range(300, 557)],
    "sources": [(i, "T", "en", f"s{i}", i) for i in range(40)],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("stride", [1, 2, 3])
def test_manifest_is_that_of_plain_python(rows, case, stride):
    if stride != 2 and case not in ("power", "odd"):
        pytest.skip("other strides on two cases")
    got = merkle.merkle_manifest(rows(CASES[case], SCHEMA).repartition(3), stride)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert spark_rows(got) == sorted(brute(CASES[case]), key=key)


def test_empty_table_and_clashing_columns(rows):
    assert merkle.merkle_manifest(rows([], SCHEMA)).count() == 0
    data = CASES["odd"]
    more = rows([(*r, "x", 1, "y", 2, 3) for r in data], SCHEMA + ", tree string, at long, digest string, m long, id long")
    assert spark_rows(merkle.merkle_manifest(more)) == sorted(brute(data), key=key)


def test_proofs_hold_every_sibling_and_changed_rows_fail(spark, rows):
    data = CASES["many"]
    judged = merkle.merkle_manifest(rows(data, SCHEMA)).collect()
    assert {r["doc_id"] for r in judged if not r["verified"]} == {r[0] for r in data if zlib.crc32(str(r[0]).encode()) % 5 == 0}


def test_a_large_source_spreads_over_tasks(spark, rows):
    """A third and more of the rows in one source: no group of the plan holds more than FAN ** STRIDE digests."""
    data = rows([(i, "t", "en", "hot", 1) for i in range(3000)], SCHEMA)
    leaves = data.selectExpr("'x' AS tree", "doc_id AS id", "sha2(text, 256) AS digest")
    forest = merkle.grow(leaves, ["id"])
    assert len(forest.levels) == 3
    sizes = [r[0] for r in forest.levels[0].groupBy("tree", (forest.levels[0]["at"] / 256).cast("int")).count().select("count").collect()]
    assert max(sizes) == 256 and len(sizes) == 12
