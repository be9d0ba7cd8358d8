"""Text columns: clipping, number and repr texts, canonical JSON, digests."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from plantpulse.constants import UNSIGNED_FIELDS, WHITESPACE
from plantpulse.functions.temperature import _col

__all__ = [
    "strip", "clip", "float_text", "quoted", "canonical_json", "canonical_json_udf", "message_hash",
    "verify_message", "fixed_decimals", "escape_tag",
]


def strip(text: Column | str) -> Column:
    return F.btrim(_col(text), F.lit(WHITESPACE))


def clip(text: Column | str, n: int, mark: str = "…") -> Column:
    """First ``n`` characters followed by a mark, as short hashes are displayed."""
    return F.concat(F.substring(_col(text), 1, n), F.lit(mark))


def fixed_decimals(x: Column | str, digits: int) -> Column:
    """``%.<n>f`` text, rounding the stored binary value half-even."""
    return F.call_function("format_number", _col(x), F.lit("0." + "0" * digits))


def float_text(x: Column | str) -> Column:
    """Shortest float text with a plain decimal form up to 1e16, as JSON tools print it."""
    text = _col(x).cast("string")
    magnitude = F.abs(_col(x))
    plain = text.try_cast("decimal(38,20)").cast("string")
    plain = F.regexp_replace(plain, r"(\.\d+?)0+$", "$1")
    sci = F.regexp_replace(F.lower(text), r"\.0e", "e")
    sci = F.regexp_replace(sci, r"e(\d)", "e+$1")
    sci = F.regexp_replace(sci, r"e([+-])(\d)$", "e$10$2")
    return (
        F.when(F.isnan(_col(x)), "nan")
        .when(magnitude == float("inf"), F.when(_col(x) > 0, "inf").otherwise("-inf"))
        .when((magnitude >= 1e16) | ((magnitude < 1e-4) & (magnitude > 0)), sci)
        .when((magnitude >= 1e7) | ((magnitude < 1e-3) & (magnitude > 0)), plain)
        .otherwise(text)
    )


def quoted(text: Column | str) -> Column:
    """Single-quoted literal of a text, as shown inside reject reasons."""
    body = _col(text)
    for raw, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(shown))
    single, double = F.instr(_col(text), "'") > 0, F.instr(_col(text), '"') > 0
    return (
        F.when(single & ~double, F.concat(F.lit('"'), body, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def canonical_json_udf(exclude: tuple[str, ...] = UNSIGNED_FIELDS):
    """Arrow UDF: signed content of a raw JSON message as sorted, ASCII JSON text.

    It must start from the raw text: once a number is a Spark DOUBLE, 75 and
    75.0 can no longer be told apart, and they hash differently.
    """
    dropped = frozenset(exclude)

    def canonical(text):
        try:
            message = json.loads(text)
        except (TypeError, ValueError):
            return None
        if not isinstance(message, dict):
            return None
        return json.dumps({k: v for k, v in message.items() if k not in dropped}, sort_keys=True)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(canonical)

    return run


def canonical_json(raw: Column | str, exclude: tuple[str, ...] = UNSIGNED_FIELDS) -> Column:
    return canonical_json_udf(exclude)(_col(raw))


def message_hash(canonical: Column | str, prev_hash: Column | str) -> Column:
    return F.sha2(F.concat(_col(canonical), _col(prev_hash)).cast("binary"), 256)


def verify_message(canonical: Column | str, declared_prev: Column | str, declared_hash: Column | str,
                   expected_prev: Column | str) -> Column:
    """Struct (ok, reason) of one message against the hash it should follow."""
    prev = F.coalesce(_col(declared_prev), F.lit(""))
    declared = F.coalesce(_col(declared_hash), F.lit(""))
    computed = message_hash(canonical, prev)
    reason = (
        F.when(prev != _col(expected_prev),
               F.concat(F.lit("prev_hash_mismatch: declared="), clip(prev, 16),
                        F.lit(" expected="), clip(expected_prev, 16)))
        .when(declared != computed,
              F.concat(F.lit("hash_mismatch: declared="), clip(declared, 16),
                       F.lit(" computed="), clip(computed, 16)))
        .otherwise("")
    )
    return F.struct((reason == "").alias("ok"), reason.alias("reason"))


def escape_tag(text: Column | str) -> Column:
    """Backslash before the three separators of a line-protocol tag."""
    return F.regexp_replace(_col(text), r"([ ,=])", r"\\$1")
