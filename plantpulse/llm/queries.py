"""Registered queries of this package and the SQL that gives the same rows, where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.llm import language_id, toxicity
from plantpulse.llm.decontamination import decontaminate
from plantpulse.llm.exact_dedup import exact_dedup
from plantpulse.llm.jaccard_join import near_duplicates
from plantpulse.llm.line_dedup import line_dedup
from plantpulse.llm.merkle import FAN, merkle_manifest
from plantpulse.llm.nearest import nearest
from plantpulse.llm.packing import pack
from plantpulse.llm.pii import find_pii, pii_digest
from plantpulse.llm.secrets import scan_secrets, secret_digest
from plantpulse.llm.text import UPPER, hex_sha256
from plantpulse.llm.token_shards import read_slots, write_shards
from plantpulse.llm.whitening import whiten_embeddings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWER = f"translate({{}}, '{UPPER}', '{UPPER.lower()}')"
_TEXT = LOWER.format("coalesce(text, '')")


@query("op1_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_TEXT} AS t FROM documents) WINDOW same AS (PARTITION BY t)
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), survivor="largest")


@query("op2_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(find_pii(table(spark, sf_dir, "documents")))


_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op8_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, {LOWER.format(f"trim(line, {_STRIP})")} AS k FROM lines),
held AS (SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT doc_id, line, pos, coalesce(doc_id <> first_id, false) AS gone FROM keyed LEFT JOIN held USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", hex_sha256(F.col("text")).alias("kept_sha256"))


@query("op9_secrets")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(scan_secrets(table(spark, sf_dir, "documents")))


@query("op3_token_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = write_shards(table(spark, sf_dir, "documents"))
    return read_slots(index, folder, with_ids=False)


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query("op10_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORDS.format(_TEXT)} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format(_TEXT)} AS w FROM benchmark),
spans AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
marks AS (SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS gram FROM spans, unnest(range(1, len(w) - k + 2)) AS r(s)),
grams AS (SELECT doc_id, s, k, array_to_string(w[s : s + k - 1], ' ') AS gram
          FROM d, (SELECT DISTINCT k FROM spans), unnest(range(1, len(w) - k + 2)) AS r(s)),
hits AS (SELECT DISTINCT doc_id, s, k, item_id FROM grams JOIN marks USING (k, gram)),
inside AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
         FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN inside USING (doc_id) LEFT JOIN held USING (doc_id)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        hex_sha256(F.array_join("items", ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", language_id.held_out(F.col("doc_id"), 3, 1).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language_id.held_out(F.col("doc_id"), 4, 2)
    model = language_id.fit(docs.filter(~out))
    return language_id.identify(docs, model, keep=["doc_id"]).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query("op7_ngram_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_docs", "representative")


def _merkle_levels(first: str, name: str, levels: int) -> str:
    """CTEs ``<name>0`` to ``<name><levels>`` of (tree, i, h, m): the nodes of each level, tops carried along as they are."""
    out = [f"{name}0 AS ({first})"]
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (
  SELECT tree, i // {FAN} AS i, CASE WHEN m = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, (m + {FAN - 1}) // {FAN} AS m
  FROM {name}{k} GROUP BY tree, i // {FAN}, m)""")
    return ",\n".join(out)


def _merkle_siblings(name: str, alias: str, at: str, tree: str, levels: int) -> str:
    """Lateral joins that give (l, r), the siblings to the left and right, of one leaf's ancestor on each level."""
    return "\n".join(f"""LEFT JOIN LATERAL (
  SELECT coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < {at} // {FAN**k}), '') AS l,
         coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > {at} // {FAN**k}), '') AS r, coalesce(max(s.m), 1) > 1 AS inner_node
  FROM {name}{k} AS s WHERE s.tree = {tree} AND s.i // {FAN} = {at} // {FAN ** (k + 1)}) AS {alias}{k} ON true""" for k in range(levels))


def _merkle_sql(levels: int = 5, upper: int = 3) -> str:
    """Levels suffice for FAN ** levels documents of a source and FAN ** upper sources."""
    enc = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
    leaf = " || ".join(enc.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    low = leaf.replace("text", LOWER.format("text"))
    # bits of the CRC: each character is xor-ed in before the first of its eight steps
    bits = "flatten(list_transform(range(1, length({0}) + 1), lambda p: [CAST(ascii({0}[p]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))".format("CAST(doc_id AS VARCHAR)")
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda a, x: CASE WHEN xor(a, x) % 2 = 1 THEN xor(xor(a, x) >> 1, 3988292384) ELSE xor(a, x) >> 1 END), 4294967295)"
    own, above = [f"p{k}" for k in range(levels)], [f"u{k}" for k in range(upper)]
    proof = " || ".join(f"CASE WHEN {a}.inner_node THEN {a}.l || {a}.r ELSE '' END" for a in own + above)
    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, sha256({leaf}) AS leaf,
         CASE WHEN {crc} % 5 = 0 THEN sha256({low}) END AS other
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS m FROM leaves),
{_merkle_levels("SELECT tree, i, leaf AS h, m FROM placed", "g", levels)},
subroots AS (SELECT tree AS of, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS j, count(*) OVER () AS m FROM g{levels}),
{_merkle_levels("SELECT '' AS tree, j AS i, subroot AS h, m FROM subroots", "t", upper)},
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT h FROM t{upper}) AS root, sha256({proof}) AS proof_sha256,
         coalesce(other, leaf) AS start, {", ".join(f"{a}.l AS l_{a}, {a}.r AS r_{a}, {a}.inner_node AS n_{a}" for a in own + above)}
  FROM placed JOIN subroots ON of = placed.tree
  {_merkle_siblings("g", "p", "placed.i", "placed.tree", levels)}
  {_merkle_siblings("t", "u", "subroots.j", "''", upper)}),
""" + ",\n".join(
        f"f{k} AS (SELECT * EXCLUDE (start), CASE WHEN n_{a} THEN sha256(l_{a} || start || r_{a}) ELSE start END AS start FROM {'folded' if k == 0 else f'f{k - 1}'})"
        for k, a in enumerate(own + above)) + f"""
SELECT doc_id, leaf, subroot, root, proof_sha256, start AS folded_root, start = root AS verified FROM f{levels + upper - 1}
"""


@query("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(table(spark, sf_dir, "embeddings"))


@query("op13_nearest_neighbours")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
