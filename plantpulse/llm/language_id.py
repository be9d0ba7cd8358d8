"""Language identification: scripts narrow the candidates, and Viterbi over words labels spans of mixed texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantpulse.llm.words import GROUP_BYTES, groups

BUCKETS = 1 << 18
#: Cost of a change of language between two words, in nats.
SWITCH = 6.0
#: A language is a candidate for a script that holds this share of its letters.
LEAST_SHARE = 1e-3
SMOOTHING = 0.05
UNKNOWN = "und"
#: Code point ranges of scripts.
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF))), ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))), ("cyrillic", ((0x400, 0x52F),)),
    ("armenian", ((0x530, 0x58F),)), ("hebrew", ((0x590, 0x5FF),)), ("arabic", ((0x600, 0x6FF), (0x750, 0x77F))),
    ("devanagari", ((0x900, 0x97F),)), ("bengali", ((0x980, 0x9FF),)), ("tamil", ((0xB80, 0xBFF),)), ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)), ("hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))), ("kana", ((0x3040, 0x30FF),)),
    ("han", ((0x3400, 0x9FFF), (0x20000, 0x3134F))),
)
OTHER = len(SCRIPTS) + 1


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Script number (0: no letter) and lower-case form of every code point."""
    script = np.zeros(0x110000, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            script[cp] = OTHER
            if len(small := c.lower()) == 1:
                lower[cp] = ord(small)
    for n, (_, ranges) in enumerate(SCRIPTS, 1):
        for lo, hi in ranges:
            part = script[lo : hi + 1]
            part[part > 0] = n
    return script, lower


def letter_scripts() -> np.ndarray:
    """Script number of every code point, 0 for no letter."""
    return _tables()[0]


@dataclass
class Letters:
    """Words (runs of letters) of a group of texts, and a bucket for each letter with its neighbours in the word."""

    start: np.ndarray  # of each word, in code points of its group
    end: np.ndarray
    first: np.ndarray  # of each text, its first word; one more at the end
    bounds: np.ndarray  # of each text, in code points
    at: np.ndarray  # of each word, its first letter
    bucket: np.ndarray  # of each letter
    script: np.ndarray  # of each letter


def letters(texts: list[str | None]) -> Letters:
    script_of, lower_of = _tables()
    texts = [t or "" for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    script = script_of[cps]
    inside = script > 0
    edge = np.ones(len(cps) + 1, bool)  # no word goes on between a code point and the one before
    edge[1:-1] = ~(inside[1:] & inside[:-1])
    edge[bounds] = True
    start = np.flatnonzero(inside & edge[:-1])
    end = np.flatnonzero(inside & edge[1:]) + 1
    c = lower_of[cps[inside]]
    length = end - start
    at = np.cumsum(length) - length
    before = np.concatenate([[0], c[:-1]]).astype(np.uint32) if len(c) else c
    after = np.concatenate([c[1:], [0]]).astype(np.uint32) if len(c) else c
    before[at] = 0
    after[at + length - 1] = 0
    h = (before * np.uint32(0x9E3779B1)) ^ ((c * np.uint32(0x85EBCA77)) << np.uint32(3)) ^ (after * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    h = (h ^ (h >> np.uint32(13))) >> np.uint32(14)
    return Letters(start, end, np.searchsorted(start, bounds), bounds, at, h.astype(np.int64), script[inside])


def text_groups(column: pa.Array, size: int = GROUP_BYTES) -> Iterator[tuple[int, list[str | None]]]:
    for lo, hi, _, _ in groups(column, size):
        yield lo, column.slice(lo, hi - lo).to_pylist()


@dataclass
class LanguageModel:
    """Fitted on letter trigrams; its size is BUCKETS floats for each language, whatever the corpus."""

    languages: list[str]
    score: np.ndarray  # (BUCKETS, languages): log probability of a letter in its place
    candidate: np.ndarray  # (scripts, languages): 0, or a cost that rules a language out

    def words(self, x: Letters) -> np.ndarray:
        """(words, languages)"""
        total = np.add.reduceat(self.score[x.bucket], x.at, axis=0)
        return total + self.candidate[x.script[x.at]]


def _count(languages: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = BUCKETS + OTHER + 1
        number = {x: n for n, x in enumerate(languages)}
        total = np.zeros((len(languages), width), np.int64)
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            for lo, texts in text_groups(batch.column(1)):
                x = letters(texts)
                per_text = np.diff(np.concatenate([x.at, [len(x.bucket)]])[x.first])
                of = np.repeat(lang[lo : lo + len(texts)], per_text)
                for n in np.unique(of):
                    mine = of == n
                    total[n, :BUCKETS] += np.bincount(x.bucket[mine], minlength=BUCKETS)
                    total[n, BUCKETS:] += np.bincount(x.script[mine], minlength=OTHER + 1)
        n, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(at), pa.array(total[n, at])], names=["lang", "at", "n"])

    return count


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> LanguageModel | None:
    """Letter statistics of each language over all rows that have one; None without any.

    Tasks count for themselves and exchange their sums, at most BUCKETS for each language; the languages' number is
    the labels' and doesn't grow with the rows.
    """
    known = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    languages = sorted(r[0] for r in known.select("lang").distinct().collect())
    if not languages:
        return None
    sums = known.mapInArrow(_count(languages), "lang long, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros((len(languages), BUCKETS + OTHER + 1))
    total[sums["lang"], sums["at"]] = sums["n"]
    grams, scripts = total[:, :BUCKETS], total[:, BUCKETS:]
    seen = max(1, np.count_nonzero(grams.sum(axis=0)))
    score = np.log((grams + SMOOTHING) / (grams.sum(axis=1, keepdims=True) + SMOOTHING * seen)).T.astype(np.float32)
    share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
    fits = share.T >= LEAST_SHARE
    fits[~fits.any(axis=1)] = True  # a script that no language has leaves all of them
    return LanguageModel(languages, np.ascontiguousarray(score), np.where(fits, 0, -1e4).astype(np.float32))


def viterbi(score: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word; texts are taken in step, the ones with most words first."""
    count = np.diff(first)
    by = np.argsort(-count, kind="stable")
    by = by[count[by] > 0]
    begin, count = first[:-1][by], count[by]
    label = np.zeros(len(score), np.int64)
    if not len(by):
        return label
    changed = np.zeros(score.shape, bool)
    best = np.zeros(len(score), np.int64)  # of the word before
    value = score[begin].astype(np.float64)
    steps = int(count[0])
    active = np.searchsorted(-count, -np.arange(steps), "left")  # texts with more words than the step's number
    rows = np.arange(len(by))
    final = value.copy()
    for t in range(1, steps):
        m = active[t]
        v, at = value[:m], begin[:m] + t
        top = v.argmax(axis=1)
        other = (v[rows[:m], top] - switch)[:, None]
        change = other > v
        best[at] = top
        changed[at] = change
        value = np.where(change, other, v) + score[at]
        value -= value.max(axis=1, keepdims=True)
        final[:m] = value
    now = final.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = begin[:m] + t
        label[at] = now[:m]
        if t:
            now[:m] = np.where(changed[at, now[:m]], best[at], now[:m])
    return label


def _label(sent, switch: float, text_at: int, names: list[str]):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            predicted, share, spans = [], [], []
            for _, texts in text_groups(batch.column(text_at)):
                x = letters(texts)
                if model is None or not len(x.start):
                    predicted += [UNKNOWN] * len(texts)
                    share += [0.0] * len(texts)
                    spans += [[]] * len(texts)
                    continue
                label = viterbi(model.words(x), x.first, switch)
                length = x.end - x.start
                for d in range(len(texts)):
                    a, b = x.first[d], x.first[d + 1]
                    if a == b:
                        predicted.append(UNKNOWN)
                        share.append(0.0)
                        spans.append([])
                        continue
                    own = label[a:b]
                    by = np.bincount(own, weights=length[a:b], minlength=len(model.languages))
                    predicted.append(model.languages[int(by.argmax())])
                    share.append(float(by.max() / by.sum()))
                    cut = np.flatnonzero(np.diff(own)) + 1
                    lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [b - a]])
                    spans.append([
                        {"start": int(x.start[a + i] - x.bounds[d]), "end": int(x.end[a + j - 1] - x.bounds[d]), "lang": model.languages[own[i]]}
                        for i, j in zip(lo, hi, strict=True)
                    ])
            added = [pa.array(predicted, pa.string()), pa.array(share, pa.float64()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *added], names=[*names, "lang_pred", "score", "lang_spans"])

    return run


def identify(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", switch: float = SWITCH, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs`` and lang_pred, score, lang_spans.

    The script of a word leaves the languages that use it; each of them scores the word by its letters with their
    neighbours; Viterbi with a cost for each change labels the words, and runs of words of one label are the spans (start
    and end in code points). lang_pred is the language of most letters, score its share of the letters.

    Null texts and texts without a letter are ``und`` with score 0 and no spans, and so is everything without a model. Ties
    go to the language that sorts first. Repeated rows get the same result. Texts of any length are labelled whole.
    lang_pred, score and lang_spans replace columns of those names.
    """
    added = T._parse_datatype_string("lang_pred string, score double, lang_spans array<struct<start:int,end:int,lang:string>>")
    names = [c for c in (docs.columns if keep is None else keep) if c not in added.names]
    whole = names if text_col in names else [*names, text_col]
    source = docs.select(*[F.col(f"`{c}`") for c in whole])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*[source.schema[c] for c in names], *added.fields])
    return source.mapInArrow(_label(sent, switch, whole.index(text_col), names), schema)


def held_out(id_column: Column, parts: int, part: int) -> Column:
    """Whether a row is held out from training: crc32 of its identifier as text, modulo ``parts``; null is empty."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % parts == part
