"""Column helpers for texts and spans; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Elements summed in one go by running_sum.
BLOCK = 512


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(column, UPPER, UPPER.lower())


def running_sum(numbers: Column) -> Column:
    """Inclusive running sums of an array of ints, in blocks so that long arrays are not copied for each element."""

    def put(state: Column, x: Column) -> Column:
        total = state["t"] + x
        return F.struct(total.alias("t"), F.concat(state["a"], F.array(total)).alias("a"))

    def within(block: Column, start: Column) -> Column:
        return F.aggregate(block, F.struct(start.alias("t"), F.array().cast("array<int>").alias("a")), put)

    def put_block(state: Column, b: Column) -> Column:
        done = within(F.slice(numbers, b * BLOCK + 1, BLOCK), state["t"])
        return F.struct(done["t"].alias("t"), F.concat(state["a"], done["a"]).alias("a"))

    blocks = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int"))
    zero = F.struct(F.lit(0).alias("t"), F.array().cast("array<int>").alias("a"))
    return F.when(F.size(numbers) > 0, F.aggregate(blocks, zero, put_block)["a"]).otherwise(F.array().cast("array<int>"))


def found(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches, as an array of strings."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def located(text: Column, values: Column, pattern: str) -> Column:
    """array<struct<start, end, value, before>> of ``values = found(text, pattern)``; code points, end exclusive.

    ``before`` is what lies between the match before (or the start of the text) and this one. The text is only split
    where there are matches.
    """
    gaps = F.split(text, pattern, -1)
    ends = running_sum(F.zip_with(F.slice(gaps, 1, F.size(values)), values, lambda g, v: F.length(g) + F.length(v)))
    spans = F.transform(
        F.arrays_zip(ends.alias("e"), values.alias("v"), F.slice(gaps, 1, F.size(values)).alias("g")),
        lambda x: F.struct((x["e"] - F.length(x["v"])).alias("start"), x["e"].alias("end"), x["v"].alias("value"), x["g"].alias("before")),
    )
    empty = F.array().cast("array<struct<start:int,end:int,value:string,before:string>>")
    return F.when(F.size(values) > 0, spans).otherwise(empty)


def overlapping(spans: Column, start: Column, end: Column, least: int) -> Column:
    """Those of ``spans`` that overlap [start, end). They are sorted, don't overlap each other, and are ``least`` long at least.

    The first one is found by halving, and only as many are looked at from there as fit into the range, so a text may have
    any number of spans and of ranges.
    """
    turns = F.sequence(F.lit(1), F.length(F.bin(F.size(spans).cast("long"))))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        over = F.get(spans, middle)["end"] <= start
        return F.when(state["lo"] >= state["hi"], state).otherwise(
            F.struct(F.when(over, middle + 1).otherwise(state["lo"]).alias("lo"), F.when(over, state["hi"]).otherwise(middle).alias("hi")))

    begun = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))
    first = F.aggregate(turns, begun, halve, lambda state: state["lo"])
    some = F.slice(spans, first + 1, F.floor((end - start) / least).cast("int") + 2)
    return F.filter(some, lambda x: (x["start"] < end) & (start < x["end"]))


def joined(spans: Column, name: Callable[[Column], Column]) -> Column:
    """``kind:start:end`` of all spans, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def hex_sha256(column: Column) -> Column:
    """Lower-case hex digest of a string's UTF-8 bytes."""
    return F.sha2(column, 256)
