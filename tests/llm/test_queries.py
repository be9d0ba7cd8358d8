"""Registered queries against their SQL and plain Python, and the pipeline's stages, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from plantpulse.llm.queries import ORACLES, QUERIES
from tests.llm import brute, test_nearest, test_whitening
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_exact_and_lines import brute_lines
from tests.llm.test_jaccard_join import brute as brute_links

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF)
    wanted = con.execute(ORACLES[name])
    names = [c[0] for c in wanted.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(wanted.fetchall())


@pytest.mark.parametrize("name, find", [("op2_pii", brute.pii), ("op9_secrets", brute.secrets)])
def test_base_spans(spark, texts, name, find):
    got = {r.doc_id: r.base_sha256 for r in QUERIES[name](spark, SF).collect()}
    assert got == {i: brute.sha(brute.joined(find(t))) for i, t in texts.items()}


def test_links(spark, texts):
    got = sorted((r.doc_id, r.class_id, r.n_links, r.n_docs) for r in QUERIES["op7_ngram_jaccard_join"](spark, SF).collect())
    assert got == brute_links(sorted(texts.items()))


def test_all_are_registered():
    names = driver.queries()
    assert set(QUERIES) <= set(names) and names["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(driver.oracle_sql())


def test_pipeline(spark, con, texts):
    """Each stage against plain Python on what it was given."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    given = texts
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    sizes = []
    for (name, stage), n in zip(corpus_pipeline.STAGES, (5, 8, 7, 10, 4), strict=True):
        frame = stage(spark, docs, SF)
        if n == 4:
            assert {r.doc_id for r in frame.collect()} == set(given)
            break
        assert frame.columns == columns
        docs = spark.createDataFrame(frame.collect(), frame.schema)
        kept = {r.doc_id: r.text for r in docs.collect()}
        assert all(r.n_chars == len(r.text) for r in docs.collect())
        if n == 5:
            assert all(given[i] == t for i, t in kept.items()) and len(kept) > 0.7 * len(given)
        elif n == 8:
            assert kept == {i: t for i, (_, _, t) in brute_lines(list(given.items())).items()}
        elif n == 7:
            wanted = {c for _, c, _, _ in brute_links(sorted(given.items()))}
            assert kept == {i: given[i] for i in wanted}
        else:
            assert kept == {i: given[i] for i, _, hit, _ in brute_hits(list(given.items()), items) if not hit}
        given = kept
        sizes.append(len(kept))
    assert sizes == sorted(sizes, reverse=True)
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_clashing_columns_and_odd_rows(spark):
    data = [(1, "t", None, "_id", 5, 2), (1, "t", None, "_id", 5, 2), (None, None, "en", None, None, 3), (2, "", "en", "s", 0, 4)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, _fp string, n_chars long, _id int")
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, docs, SF)
        # of the two rows alike in identifier and text, near duplicates keep one
        assert frame.count() == (3 if name == "ngram_jaccard_join" else 4)
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_near_duplicates_keep_one_row(spark):
    """Rows alike in identifier and text, copies without words, and empty texts."""
    data = [(3, "a b c", "x"), (3, "a b c", "w"), (5, "a, b C", "x"), (7, "--", "x"), (6, "--", "z"), (6, "--", "y"), (None, "--", "x"), (8, "!", "x"), (9, "", "x"), (4, None, "x"), (4, "", "x")]
    docs = spark.createDataFrame([{"doc_id": i, "text": t, "tag": {"k": g}} for i, t, g in data], "doc_id long, text string, tag map<string,string>")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "", r.tag["k"]) for r in kept.collect()) == [(3, "a b c", "w"), (4, "", "x"), (6, "--", "y"), (8, "!", "x"), (9, "", "x")]


def test_whitening_against_numpy(spark, con):
    data = con.execute(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    got, want = test_whitening.judged(QUERIES["op12_embedding_whitening"](spark, SF), [v for _, v in data])
    test_whitening.same_up_to_sign(got, want)


def test_nearest_against_brute_force(spark, con):
    data = con.execute(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    want, got = test_nearest.brute(data, 20), {}
    for r in QUERIES["op13_nearest_neighbours"](spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert test_nearest.recall(got, want) >= 0.9
    scores = {(q, i): s for q, v in want.items() for i, s in v}
    assert all(abs(s - scores[q, i]) < 1e-12 for q, v in got.items() for i, s in v if (q, i) in scores)
