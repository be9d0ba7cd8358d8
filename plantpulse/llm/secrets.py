"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings; DataFrame functions only."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.text import found, joined, located, overlapping, running_sum

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
#: kind -> (pattern, least length). Runs are matched from their start only, which long texts need.
BASE = {"assign": (ASSIGN, 0), "access": (r"AKIA[A-Z0-9]++", 20), "hex": (r"(?<![0-9a-f])[0-9a-f]{24,}+", 24)}
#: Least characters of the value of an assignment.
LEAST_VALUE = 6
#: Characters of the shortest span of a fixed pattern.
LEAST_SPAN = len("token=") + LEAST_VALUE
#: Strings of 20 or more characters of keys and codes with a digit and a letter among them.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}+"
#: Character class -> (pattern, least bits per character in a window).
CLASSES = {"hex": (r"^[0-9a-fA-F]+$", 2.6), "alnum": (r"^[A-Za-z0-9]+$", 3.3), "base64": (r"^[A-Za-z0-9+/_=-]+$", 3.4)}
#: Not secrets: worked examples, counting sequences, version-4-like identifiers, dates and numbers joined by signs.
ALLOW = (
    r"(?i)example|sample|placeholder|x{6,}",
    r"(?i)0123456789|abcdefghij",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^[A-Za-z]{0,3}[0-9]+([/_=+-][0-9]+)+$",
)
ORDER = ("assign", "access", "hex", "entropy")


def _f(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def codes_of(value: Column) -> Column:
    return F.transform(F.split(value, ""), lambda c: F.ascii(c))


def hot_range(codes: Column, window: int, least: Column) -> Column:
    """struct<lo, hi>: from the first to the last window of at least ``least`` bits per character; hi 0 if there is none.

    ``codes`` are a string's characters, taken apart once. With each character of a window goes its count there, and with
    the window the sum of n log n over its counts: a step takes the first character off, adds the next one, and changes the
    counts and the sum by these two alone. So the time is in proportion to the length. Both arguments are read in every
    step and should be stored columns or fields, not expressions over the whole string.
    """
    first = F.slice(codes, 1, window)
    entry = lambda c, n: F.struct(c.alias("c"), n.cast("int").alias("n"))
    held = F.transform(first, lambda c: entry(c, F.size(F.filter(first, lambda d: d == c))))
    # each of n equal characters has its n-th part of n log n
    start = F.aggregate(held, F.lit(0.0), lambda s, x: s + F.log2(x["n"].cast("double")))
    bits = lambda s: F.lit(math.log2(window)) - s / window

    def noted(held: Column, s: Column, i: Column, lo: Column, hi: Column) -> Column:
        hot = bits(s) >= least
        return F.struct(held.alias("w"), s.alias("s"), i.alias("i"), F.when(hot & (hi == 0), i).otherwise(lo).alias("lo"), F.when(hot, i + window).otherwise(hi).alias("hi"))

    def slide(state: Column, came: Column) -> Column:
        gone = F.get(state["w"], F.lit(0))
        rest = F.slice(state["w"], 2, window - 1)
        change = lambda c: (c == came).cast("int") - (c == gone["c"]).cast("int")
        like = F.get(F.filter(rest, lambda x: x["c"] == came), F.lit(0))["n"]
        there = F.when(like.isNull(), F.lit(0)).otherwise(like - (came == gone["c"]).cast("int"))
        held = F.concat(F.transform(rest, lambda x: entry(x["c"], x["n"] + change(x["c"]))), F.array(entry(came, there + 1)))
        return noted(held, state["s"] - _f(gone["n"]) + _f(gone["n"] - 1) - _f(there) + _f(there + 1), state["i"] + 1, state["lo"], state["hi"])

    more = F.slice(codes, F.lit(window + 1), F.greatest(F.size(codes) - window, F.lit(0)))
    done = F.aggregate(more, noted(held, start, F.lit(0), F.lit(0), F.lit(0)), slide)
    return F.struct(done["lo"].alias("lo"), done["hi"].alias("hi"))


def _open_pieces(s: Column, window: int, allow: tuple[str, ...]) -> Column:
    """array<struct<start, value>>: what of a candidate lies between base spans and allowed parts, ``window`` long at least.

    Parts are what lies between the signs / and =. A pattern that fits the candidate from end to end allows all of it.
    """
    fits = lambda v, form: reduce(or_, [v.rlike(form.format(p)) for p in allow], F.lit(False))
    block = lambda lo, hi: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    n = F.length(s["value"])
    parts = F.split(s["value"], "[/=]", -1)
    ends = running_sum(F.transform(parts, lambda p: F.length(p) + 1))
    free = F.filter(F.arrays_zip(parts.alias("p"), ends.alias("e")), lambda x: fits(x["p"], "{}"))
    known = F.concat(*[overlapping(F.col(f"_{k}"), s["start"], s["end"], LEAST_SPAN) for k in BASE])
    blocks = F.concat(
        F.transform(known, lambda b: block(F.greatest(b["start"] - s["start"], F.lit(0)), F.least(b["end"], s["end"]) - s["start"])),
        F.transform(free, lambda x: block(x["e"] - 1 - F.length(x["p"]), x["e"] - 1)),
        F.when(fits(s["value"], "^(?:{})$"), F.array(block(F.lit(0), n))).otherwise(F.array().cast("array<struct<lo:int,hi:int>>")),
    )

    def between(state: Column, b: Column) -> Column:
        piece = F.array(block(state["at"], b["lo"]))
        return F.struct(F.greatest(state["at"], b["hi"]).alias("at"), F.when(b["lo"] - state["at"] >= window, F.concat(state["got"], piece)).otherwise(state["got"]).alias("got"))

    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<lo:int,hi:int>>").alias("got"))
    pieces = F.aggregate(F.concat(F.array_sort(blocks), F.array(block(n, n))), begun, between, lambda state: state["got"])
    return F.transform(pieces, lambda g: F.struct((s["start"] + g["lo"]).alias("start"), F.substring(s["value"], g["lo"] + 1, g["hi"] - g["lo"]).alias("value")))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 16, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """Per row: id, base (array of kind, start, end) and spans (base ones and those of the entropy scan).

    Fixed patterns give the kinds assign, access and hex. Candidate strings get the kind entropy where a window of
    ``window`` characters reaches the bits per character of its class. Windows that overlap a fixed pattern's span, or a
    part of the string (between / and =) that an allow-list pattern fits, don't count; what lies between those is
    scanned piece by piece, if it has a digit and a letter. Everything happens in the scan of the texts, without an exchange.

    Null texts count as empty and have no spans. Repeated rows are scanned each for itself. Positions are code points,
    ends exclusive. Spans are in order of start, then kind. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    got = docs.select(
        F.col(id_col).alias("_id"), text.alias("_text"), *[found(text, p).alias(f"_{k}") for k, (p, _) in BASE.items()],
        found(text, CANDIDATE).alias("_entropy"),
    )
    got = got.select("_id", *[located(F.col("_text"), F.col(f"_{k}"), p).alias(f"_{k}") for k, p in [*((k, p) for k, (p, _) in BASE.items()), ("entropy", CANDIDATE)]])

    def span(kind: str, s: Column, lo: Column | None = None, hi: Column | None = None) -> Column:
        return F.struct((s["start"] if lo is None else s["start"] + lo).alias("start"), F.lit(ORDER.index(kind)).alias("kind"), (s["end"] if hi is None else s["start"] + hi).alias("end"))

    def long_enough(kind: str) -> Column:
        if kind == "assign":
            return F.filter("_assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= LEAST_VALUE)
        return F.filter(f"_{kind}", lambda s: F.length(s["value"]) >= BASE[kind][1])

    def spans_of(kind: str) -> Column:
        return F.transform(long_enough(kind), lambda s: span(kind, s))

    got = got.select("_id", "_entropy", *[spans_of(k).alias(f"_{k}") for k in BASE])
    got = got.withColumn("base", F.array_sort(F.concat(*[f"_{k}" for k in BASE])))
    least = lambda v: F.coalesce(*[F.when(v.rlike(p), F.lit(b)) for p, b in CLASSES.values()])
    opened = F.flatten(F.transform("_entropy", lambda s: _open_pieces(s, window, allow)))
    got = got.select("_id", "base", opened.alias("_open"))
    unknown = F.filter("_open", lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    apart = F.transform(unknown, lambda s: F.struct(s["start"].alias("start"), codes_of(s["value"]).alias("codes"), least(s["value"]).alias("least")))
    scanned = F.transform(apart, lambda s: F.struct(s["start"].alias("start"), hot_range(s["codes"], window, s["least"]).alias("r")))
    hot = F.transform(F.filter(scanned, lambda s: s["r"]["hi"] > 0), lambda s: span("entropy", s, s["r"]["lo"], s["r"]["hi"]))
    return got.select(F.col("_id").alias(id_col), "base", F.array_sort(F.concat("base", hot)).alias("spans"))


def kind_name(span: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in ORDER]), span["kind"] + 1)


def secret_digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans, and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == ORDER.index(k))).cast("long").alias(f"n_{k}")
    return scanned.select(
        id_col, *[count(k) for k in BASE], F.sha2(joined(F.col("base"), kind_name), 256).alias("base_sha256"),
        joined(F.col("spans"), kind_name).alias("spans"),
    )
