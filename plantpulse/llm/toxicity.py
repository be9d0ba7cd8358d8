"""Toxicity of texts after noisy-channel deobfuscation."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantpulse.llm.language_id import held_out, letter_scripts, text_groups

#: Labelled rows the classifier is fitted on, at most; chosen by a hash of the identifier.
LABELLED = 50_000
#: Toxic documents a feature must be seen in, and its least log odds.
LEAST_SEEN = 3
LEAST_ODDS = 1.0
THRESHOLD = 0.7
#: Letters of the language model: 0 is a word's edge, 1-26 a-z, 27 any other letter.
ALPHABET = 28
#: What a sign may stand for, fixed values.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "tl", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "€": "e",
}
SEPARATORS = " .-_*"
#: Costs in nats: to read a sign as a letter, to drop a separator, to drop a repeated letter, to keep what can't be read.
SIGN, DROP, REPEAT, KEEP = 1.0, 0.5, 0.3, 14.0

_SIGNS = "0-9@$!|+€"
_ONE = rf"(?:[^\W\d_]|[{_SIGNS}])"
_ANY = r"(?:[^\W_]|[@$!|+€])"
#: Single letters and signs with a separator between them; runs without a letter are left alone (see Channel.restore).
SPACED = rf"(?<![^\W_@$!|+€]){_ONE}(?:[ .\-_*]{_ONE}){{2,}}(?![^\W_])"
#: A letter anywhere and a sign anywhere; the language model decides what the signs are.
LEETED = rf"(?<![^\W_@$!|+€])(?={_ANY}*?[^\W\d_])(?={_ANY}*?[{_SIGNS}]){_ANY}+"
#: A quick look for two single characters in a row, which spaced-out words have.
SINGLES = re.compile(rf"[ .\-_*][\w@$!|+€][ .\-_*][\w@$!|+€](?![^\W_])")
REPEATED = r"(?<![^\W\d_])(?=([^\W\d_]*?)([^\W\d_])\2\2)[^\W\d_]+"
SPACED_OUT = re.compile(SPACED)
TRIPLE = re.compile(r"(.)\1\1")
#: Around words; no letters and no signs that stand for one.
RIM = ".,;:?\"'()[]"
NOISY = re.compile(f"{SPACED}|{LEETED}|{REPEATED}")
WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings of words that are features too.
STEMS = (4, 5)


def letter(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


@dataclass
class Channel:
    """Restores obfuscated chunks: a lattice of letters for what was written, scored by a character language model."""

    cost: np.ndarray  # -log P(letter | two letters before), (ALPHABET, ALPHABET, ALPHABET)
    seen: dict[str, str] = field(default_factory=dict)

    def __getstate__(self):
        return {"cost": self.cost, "seen": {}}

    def arcs(self, chunk: str, i: int) -> list[tuple[str, float]]:
        """What the i-th sign may have come from, and at what cost. A run of three or more of a sign is one or two."""
        c = chunk[i]
        if c in SEPARATORS:
            return [("", DROP), (" ", 0.0)]
        letters = [(c, 0.0)] if c.isalpha() else [(x, SIGN) for x in LEET.get(c, "")] + [(" ", KEEP)]
        if c == "!" and not chunk[i + 1 : i + 2].isalnum():
            letters.append((c, 0.0))  # an exclamation mark as such
        before = i - len(chunk[:i].rstrip(c))
        run = before + len(chunk[i:]) - len(chunk[i:].lstrip(c))
        if run < 3 or not before:
            return letters
        return [*letters, ("", REPEAT)] if before == 1 else [("", 0.0)]

    def decode(self, chunk: str) -> str:
        """The cheapest path through the lattice (Viterbi over the last two letters)."""
        if (known := self.seen.get(chunk)) is not None:
            return known
        cost = self.cost
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for i in range(len(chunk)):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (spent, path) in best.items():
                for out, price in self.arcs(chunk, i):
                    if out == "":
                        to, total, way = (a, b), spent + price, path
                    else:
                        x = letter(out)
                        if x == 0 and b == 0:
                            to, total, way = (0, 0), spent + price, path
                        else:
                            to = (b, x) if x else (0, 0)
                            total, way = spent + price + cost[a, b, x], (out, path)
                    if to not in after or total < after[to][0]:
                        after[to] = (total, way)
            best = after
        path = min(((spent + (cost[a, b, 0] if b else 0.0), path) for (a, b), (spent, path) in best.items()), key=lambda x: x[0])[1]
        out = []
        while path is not None:
            out.append(path[0])
            path = path[1]
        text = "".join(reversed(out))
        if len(self.seen) > 200_000:
            self.seen.clear()
        self.seen[chunk] = text
        return text

    def restore(self, text: str | None) -> str:
        """A lower-cased text with its noisy chunks restored."""
        return NOISY.sub(lambda m: self.decode(m[0]) if WORD.search(m[0]) else m[0], (text or "").lower())

    def chunks(self, text: str | None) -> set[str]:
        """The distinct strings between blanks of a text, and its spaced-out words: what is restored by itself."""
        low = (text or "").lower()
        found, end = set(low.split()), 0
        for hint in SINGLES.finditer(low):
            # the run starts with the character before the hint, or else with the hint's first one
            at = hint.start()
            if at < end:
                continue
            if run := (at and SPACED_OUT.match(low, at - 1)) or SPACED_OUT.match(low, at + 1):
                end = run.end()
                if WORD.search(run[0]):
                    found.add(run[0])
        return found

    def words(self, chunk: str) -> list[str]:
        """The words of a restored chunk. Signs at its end may be no letters, so its words without them count too."""
        core = chunk.strip(RIM)
        if core.isalpha() and not TRIPLE.search(core):
            return [core]
        found = WORD.findall(self.restore(chunk))
        bare = core.rstrip("".join(LEET))
        return list(dict.fromkeys(found + WORD.findall(self.restore(bare)))) if bare != core else found


@cache
def _letter_codes() -> np.ndarray:
    code = np.where(letter_scripts() > 0, 27, 0)
    code[:0x80] = 0
    code[97:123] = code[65:91] = np.arange(1, 27)
    return code


def _letter_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    code = _letter_codes()
    total = np.zeros(ALPHABET**3, np.int64)
    for batch in batches:
        for _, texts in text_groups(batch.column(0)):
            x = code[np.frombuffer(("  " + "  ".join(t or "" for t in texts) + "  ").encode("utf-32-le", "surrogatepass"), "<u4")]
            # two letters before within the word, and an edge after each word
            b = x[1:-1]
            a = np.where(b > 0, x[:-2], 0)
            c = x[2:]
            real = (c > 0) | (b > 0)
            total += np.bincount((a[real] * ALPHABET + b[real]) * ALPHABET + c[real], minlength=ALPHABET**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])


def fit_channel(docs: DataFrame, text_col: str = "text") -> Channel:
    """The character language model of all documents' texts: at most ALPHABET ** 3 counts, summed by tasks first."""
    counts = np.zeros(ALPHABET**3)
    sums = docs.select(text_col).mapInArrow(_letter_counts, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    for at, n in sums.collect():
        counts[at] = n
    counts = counts.reshape(ALPHABET, ALPHABET, ALPHABET)
    one = (counts.sum((0, 1)) + 0.1) / (counts.sum() + 0.1 * ALPHABET)
    two = (counts.sum(0) + 2.0 * one) / (counts.sum((0, 2))[:, None] + 2.0)
    three = (counts + 2.0 * two) / (counts.sum(2, keepdims=True) + 2.0)
    return Channel(-np.log(three))


def features(channel: Channel, text: str | None) -> set[str]:
    """Words of a restored text and their beginnings, which forms of one stem share."""
    found = {w for chunk in channel.chunks(text) for w in channel.words(chunk)}
    return found | {f"{w[:n]}*" for w in found for n in STEMS if len(w) >= n}


def shaped(odds: np.ndarray) -> np.ndarray:
    """Squares, so that one strong word counts for more than several weak ones of a long text."""
    return (odds / 3) ** 2


@dataclass
class ToxicityModel:
    channel: Channel
    odds: dict[str, float]  # of features, log odds of toxic documents
    weights: np.ndarray | None  # of the three largest odds of a text, and the constant; None without labels
    memo: dict[str, list[float]] = field(default_factory=dict)  # of chunks, their words' odds above 0

    def __getstate__(self):
        return self.__dict__ | {"memo": {}}

    def evidence(self, text: str | None) -> list[float]:
        """The largest log odds of the text's words, at most three."""
        memo, odds = self.memo, self.odds
        if len(memo) > 500_000:
            memo.clear()
        found = []
        for chunk in self.channel.chunks(text):
            x = memo.get(chunk)
            if x is None:
                x = memo[chunk] = [o for w in self.channel.words(chunk) if (o := max(odds.get(w, 0.0), *(odds.get(f"{w[:n]}*", 0.0) for n in STEMS if len(w) >= n), 0.0))]
            found += x
        return (sorted(found, reverse=True) + [0.0, 0.0, 0.0])[:3]

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.weights, [*shaped(np.array(self.evidence(text))), 1.0]), -30, 30))))


def _fold(identifier) -> int:
    """0: for the calibration of the classifier, 1-3: for its odds."""
    return (int(identifier) * 0x9E3779B97F4A7C15 >> 40) % 4


def _feature_counts(sent):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel, labels = sent.value
        seen = (Counter(), Counter())
        for batch in batches:
            wanted = [r for r, i in enumerate(batch.column(0).to_pylist()) if i in labels and _fold(i)]
            rows = batch.take(pa.array(wanted, pa.int64()))
            for i, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                seen[labels[i]].update(features(channel, text))
                seen[labels[i]][""] += 1
        for toxic, counter in enumerate(seen):
            keys = list(counter)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([counter[k] if t == toxic else 0 for k in keys], pa.int64()) for t in (0, 1))], names=["feature", "clean", "toxic"],
            )

    return count


def _calibration(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, labels = sent.value
        for batch in batches:
            wanted = [r for r, i in enumerate(batch.column(0).to_pylist()) if i in labels and not _fold(i)]
            rows = batch.take(pa.array(wanted, pa.int64()))
            x = [model.evidence(t) for t in rows.column(1).to_pylist()]
            y = [labels[i] for i in rows.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(pa.array([e[k] for e in x], pa.float64()) for k in range(3)), pa.array(y, pa.int64())], names=["a", "b", "c", "y"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 0.02) -> np.ndarray:
    """Weights and constant of a logistic regression with a small ridge (Newton's method)."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    train: tuple[int, int] = (3, 1), labelled: int = LABELLED,
) -> ToxicityModel:
    """The channel's language model from all texts, and the classifier from labelled ones.

    The classifier learns from at most ``labelled`` rows of ``labels`` that aren't held out (see held_out: ``train`` is its
    parts and part), the first by a hash of their identifier. Three quarters of them give log odds of features, the
    rest calibrates how a text's largest odds make a probability. Null identifiers and labels are left out; an identifier
    that is labelled twice is toxic if one label says so. Without both labels every score is 0.
    """
    spark = docs.sparkSession
    channel = fit_channel(docs, text_col)
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col), *train))
    known = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("y"))
    label_of = dict(known.orderBy(F.xxhash64("id"), "id").limit(labelled).collect())
    two = docs.select(F.col(id_col).cast("long"), text_col)
    sent = spark.sparkContext.broadcast((channel, label_of))
    counts = two.mapInArrow(_feature_counts(sent), "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = counts.filter(F.col("toxic") >= LEAST_SEEN).toPandas()
    all_rows = counts[counts["feature"] == ""]
    model = ToxicityModel(channel, {}, None)
    if not len(all_rows) or not int(all_rows["clean"].iloc[0]):
        return model
    clean, toxic = (int(all_rows[c].iloc[0]) for c in ("clean", "toxic"))
    odds = np.log((counts["toxic"] + 0.5) / (toxic + 1)) - np.log((counts["clean"] + 0.5) / (clean + 1))
    good = (odds >= LEAST_ODDS) & (counts["feature"] != "")
    model.odds = dict(zip(counts["feature"][good], odds[good].astype(float), strict=True))
    sent = spark.sparkContext.broadcast((model, label_of))
    fitted = two.mapInArrow(_calibration(sent), "a double, b double, c double, y long").toPandas()
    y = fitted["y"].to_numpy(float)
    if 0 < y.sum() < len(y):
        model.weights = logistic(shaped(fitted[["a", "b", "c"]].to_numpy()), y)
    return model


def _score(sent, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column(text_at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(scores, pa.float64())], names=[*names, "toxicity"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs`` and toxicity, from 0 to 1.

    Chunks that are spaced out, hold letters and signs or repeat a letter three times are decoded: each sign has the
    letters it may stand for, separators and repeats may go, and Viterbi takes the path that the character language
    model likes best. The restored words' odds are scored. Texts are read whole. Null texts count as empty; empty texts get the
    score of a text without evidence. Repeated rows get equal scores. toxicity replaces a column of that name.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c != "toxicity"]
    whole = names if text_col in names else [*names, text_col]
    source = docs.select(*[F.col(f"`{c}`") for c in whole])
    schema = T.StructType([*[source.schema[c] for c in names], T.StructField("toxicity", T.DoubleType())])
    return source.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model), whole.index(text_col), names), schema)
