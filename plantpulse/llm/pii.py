"""Personal data: fixed patterns as seeds, and contextual patterns bootstrapped from them; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.text import found, joined, located, overlapping
from plantpulse.session import cut

LOCAL = r"A-Za-z0-9._%+-"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Kinds in their order. Runs of a class are matched from their start (or the last match's end) only: the same matches,
#: but in linear time on very long runs.
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
#: An identifier-like word: it holds a digit or an @.
WORD = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: What of such a word isn't the identifier: brackets, quotes and stops around it.
RIM = "()[]{}<>\"'.,;:!?"
#: Characters of the shortest identifier-like word that may be one ("5 of 12" has none).
LEAST_WORD = 5
#: Characters of the shortest match of each pattern.
LEAST_SPAN = {"email": 3, "ip": 7, "card": 13, "phone": 3}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a string pass the Luhn check."""
    digits = F.reverse(_digits(value))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
    "card": luhn,
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def context(before: Column, start: Column) -> Column:
    """The lexical pattern: the last two words before an entity on its line, lower-cased, with the signs between them.

    Where a line starts with a single word and the entity follows, that word behind a line feed, which stands for the
    line's start, is the pattern. ``before`` ends at ``start`` and reaches to the text's start if it is as long. Null if
    there is neither. Words of any length count.
    """
    line = F.substring_index(before, "\n", -1)
    whole = (F.length(before) == start) | before.contains("\n")
    two = F.regexp_extract(line, r"(?<!\p{L})(\p{L}++[^\p{L}\n0-9@]{1,3}\p{L}++[^\p{L}\n0-9@]{1,3})$", 1)
    one = F.regexp_extract(line, r"^[^\p{L}\n0-9@]{0,3}(\p{L}++[^\p{L}\n0-9@]{1,3})$", 1)
    return F.when(two != "", F.lower(two)).when(whole & (one != ""), F.concat(F.lit("\n"), F.lower(one)))


def _valid(kind: str) -> Column:
    """The located matches of a kind that pass its check."""
    return F.filter(f"_{kind}", lambda s: VALID[kind](s["value"]))


def _as(n: int, fields: Callable[[Column], tuple[Column, ...]]) -> Column:
    """The matches of the n-th kind as structs of the kind's number and ``fields``."""
    return F.transform(f"_{KINDS[n]}", lambda s: F.struct(F.lit(n).alias("kind"), *fields(s)))


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row, with a row number: id, base spans, and the seeds and candidates with their contexts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    got = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), text.alias("_text"),
        *[found(text, p).alias(f"_{k}") for k, p in PATTERNS.items()], found(text, WORD).alias("_word"),
    )
    kinds = [*PATTERNS.items(), ("word", WORD)]
    got = got.select("_row", "_id", *[located(F.col("_text"), F.col(f"_{k}"), p).alias(f"_{k}") for k, p in kinds])
    right = [_valid(k).alias(f"_{k}") for k in KINDS]
    got = got.select("_row", "_id", "_word", *right)
    base = F.concat(*[_as(n, lambda s: (s["start"], s["end"])) for n in range(len(KINDS))])
    seeds = F.concat(*[_as(n, lambda s: (s["value"], context(s["before"], s["start"]).alias("ctx"))) for n in range(len(KINDS))])
    got = got.withColumn("seeds", F.filter(seeds, lambda s: s["ctx"].isNotNull())).withColumn("base", F.array_sort(base))

    def trimmed(s: Column) -> Column:
        """The word without its rim; its context includes a bracket or quote before it."""
        lead = F.length(s["value"]) - F.length(F.ltrim(s["value"], F.lit(RIM)))
        value = F.btrim(s["value"], F.lit(RIM))
        return F.struct((s["start"] + lead).alias("start"), (s["start"] + lead + F.length(value)).alias("end"), value.alias("value"), context(s["before"], s["start"]).alias("ctx"))

    words = F.filter(F.transform("_word", trimmed), lambda s: F.length(s["value"]) >= LEAST_WORD)
    met = lambda k, s: F.size(overlapping(F.col(f"_{k}"), s["start"], s["end"], LEAST_SPAN[k]))
    free = F.filter(words, lambda s: sum((met(k, s) for k in KINDS[1:]), met(KINDS[0], s)) == 0)
    return got.select("_row", "_id", "base", "seeds", free.alias("words"))


def bootstrap(seeds: DataFrame, words: DataFrame, rounds: int, least_seeds: int, least_pattern: float, least_instance: float) -> DataFrame:
    """(value, kind) of the discovered identifiers.

    The graph joins contexts and the values seen after them, whether seeds stand behind a context or not. A context's
    confidence for a kind is the mean score of its distinct values: 1 for seeds, and for other values
    1 - prod(1 - confidence) over their contexts that are at least ``least_pattern`` and backed by ``least_seeds`` seeds
    or values of at least ``least_instance``. Both are computed anew for each round, so values found in one round make
    patterns of new contexts in the next.
    """
    known = seeds.select("ctx", "value", "kind").distinct()
    unknown = cut(words.filter(F.col("ctx").isNotNull()).select("ctx", "value").distinct(), "pii-edges")
    sure = known.groupBy("ctx", "kind").agg(F.count(F.lit(1)).cast("double").alias("gain"), F.count(F.lit(1)).alias("n"))
    sure = cut(sure, "pii-contexts")
    sizes = sure.select("ctx", "n").unionByName(unknown.groupBy("ctx").agg(F.count(F.lit(1)).alias("n")))
    sizes = cut(sizes.groupBy("ctx").agg(F.sum("n").alias("n_values")), "pii-sizes")
    scores = None
    for _ in range(rounds):
        support = sure
        if scores is not None:
            more = unknown.join(scores, "value").groupBy("ctx", "kind").agg(F.sum("score").alias("gain"), F.count_if(F.col("score") >= least_instance).alias("n"))
            support = sure.unionByName(more).groupBy("ctx", "kind").agg(F.sum("gain").alias("gain"), F.sum("n").alias("n"))
        confidence = F.col("gain") / F.col("n_values")
        backed = support.filter(F.col("n") >= least_seeds).join(sizes, "ctx")
        good = backed.filter(confidence >= least_pattern).select("ctx", "kind", confidence.alias("confidence"))
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        scores = cut(unknown.join(good, "ctx").groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score")), "pii-scores")
    best = scores.filter(F.col("score") >= least_instance).groupBy("value").agg(F.max(F.struct("score", -F.col("kind"))).alias("b"))
    return best.select("value", (-F.col("b.col2")).alias("kind"))


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, least_seeds: int = 5,
    least_pattern: float = 0.5, least_instance: float = 0.5,
) -> DataFrame:
    """Per row: id, base (array of kind, start, end) and spans (base ones and discovered ones).

    Fixed patterns find the seeds (email, IP address, payment card, phone number). The two words before a seed are
    a lexical pattern, or the one word between a line's start and it; patterns and the identifier-like words that follow
    them form a graph, which is scored for ``rounds`` rounds over the whole corpus (see bootstrap). Words that follow a
    pattern of high confidence get that pattern's kind wherever they occur; they have a digit or an @ and at least
    LEAST_WORD characters, and overlap no base span. The graph holds each pair once, so frequent pairs weigh nothing, and
    its hot contexts are combined before each exchange.

    Null texts count as empty and have no spans. Repeated rows get the same spans, each for itself. Positions are code
    points, ends exclusive; spans are in order of kind, then start. An empty table gives an empty result.
    """
    rows = cut(base_spans(docs, id_col, text_col), "pii-base")
    seeds = rows.select(F.explode("seeds").alias("s")).select("s.*")
    words = rows.select("_row", F.explode("words").alias("w")).select("_row", "w.*")
    discovered = bootstrap(seeds, words, rounds, least_seeds, least_pattern, least_instance)
    more = words.join(discovered, "value").groupBy("_row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return rows.join(more, "_row", "left").select(
        F.col("_id").alias(id_col), "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"),
    )


def kind_name(span: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), span["kind"] + 1)


def pii_digest(got: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans, and all spans as text."""
    count = lambda n, k: F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long").alias(f"n_{k}")
    return got.select(
        id_col, *[count(n, k) for n, k in enumerate(KINDS)], F.sha2(joined(F.col("base"), kind_name), 256).alias("base_sha256"),
        joined(F.col("spans"), kind_name).alias("spans"),
    )
