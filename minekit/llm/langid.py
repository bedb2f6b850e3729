"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a binary n-gram classifier (the log ratio of n-gram shares
among languages with and without the bit) predicts that bit of a text. Decoding is loss-weighted: a language's
distance is the sum of logistic losses of its bits, each weighted by how well the bit's classifier does on
training texts of that language. The nearest codeword wins; a text is ambiguous if the second is about as near.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import in_batches, stored

UNKNOWN = "und"
BUCKETS = 1 << 14  # hashed n-grams of one to three letters
ORDERS = 3
#: Rows a model learns from at most, per language: those with the smallest share of hashes.
ROWS = 2000
AMBIGUOUS = 0.2  # of the score, between the two nearest languages
_AT_ONCE = 1 << 18  # code points per step
_SCALE = 2.0  # how far the mean evidence of n-grams reaches: about 0.9 for a plain text among four languages


def _letters() -> np.ndarray:
    """Lower-case code point of each letter of the first plane, a space for all else."""
    out = np.full(0x10000, 32, np.uint32)
    for point in range(0x10000):
        letter = chr(point)
        if letter.isalpha():
            out[point] = ord(letter.lower()[0])
    return out


class Grams:
    """Counts hashed n-grams of texts."""

    def __init__(self):
        self.letters = _letters()

    def counts(self, text: str) -> np.ndarray | None:
        """By bucket; None if the text has no letter. Long texts are counted in overlapping steps."""
        if not any(map(str.isalpha, text)):
            return None
        total = np.zeros(BUCKETS, np.int64)
        for at in range(0, len(text), _AT_ONCE):
            known = min(at, ORDERS)
            total += self._step(text[at - known:at + _AT_ONCE], known)
        return total

    def _step(self, text: str, known: int) -> np.ndarray:
        """Counts of the n-grams that end behind the first `known` code points."""
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        small = self.letters[np.minimum(points, 0xFFFF)]
        points = np.where(points > 0xFFFF, points, small).astype(np.uint64)
        out = np.zeros(BUCKETS, np.int64)
        gram, lettered = np.zeros(len(points), np.uint64), np.zeros(len(points), bool)
        for order in range(1, ORDERS + 1):
            # gram[i]: the n-gram of this order that ends at i; it counts if it holds a letter.
            gram = np.concatenate((gram[:1], gram[:-1])) * np.uint64(0x9E3779B1) + points
            lettered = np.concatenate((lettered[:1], lettered[:-1])) | (points != 32)
            first = max(known, order - 1)
            hashed = (gram[first:][lettered[first:]] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)
            out += np.bincount(hashed.astype(np.int64), minlength=BUCKETS)
        return out


def codewords(languages: int, seed: int = 5) -> np.ndarray:
    """Rows of +1 and -1. Up to five languages get every distinct split, more get the best of random codes."""
    if languages < 2:
        return np.zeros((languages, 0))
    if languages <= 5:
        splits = [s for s in itertools.product((1, -1), repeat=languages) if s[0] == 1 and -1 in s]
        return np.array(splits, float).T
    rng = np.random.default_rng(seed)
    bits = math.ceil(10 * math.log2(languages))
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice((-1.0, 1.0), (languages, bits))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        distance = ((code.shape[1] - code @ code.T) / 2 + np.eye(languages) * bits).min()
        if distance > apart:
            best, apart = code, distance
    return best


@dataclass
class Model:
    """`languages`, their `codes`, `weights` by n-gram bucket and bit, and `trust` by language and bit."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def margins(self, counts: np.ndarray) -> np.ndarray:
        """Signed certainty of each bit: the mean evidence of an n-gram, scaled."""
        return _SCALE * (counts @ self.weights) / max(1, counts.sum())

    def decode(self, margins: np.ndarray) -> tuple[int, float, bool]:
        """The nearest language, its score (0 to 1), and whether the second is about as near."""
        if len(self.languages) == 1:
            return 0, 1.0, False
        loss = (self.trust * np.logaddexp(0, -self.codes * margins)).sum(axis=1)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        first, second = np.argsort(-share, kind="stable")[:2]
        return int(first), float(share[first]), bool(share[first] - share[second] < AMBIGUOUS)

    def predict(self, counts: np.ndarray | None) -> tuple[str, float, bool]:
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, counts is not None
        first, score, ambiguous = self.decode(self.margins(counts))
        return self.languages[first], score, ambiguous


def _bit_weights(by_language: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Log ratio of n-gram shares with and without each bit; languages count alike."""
    share = (by_language + 0.5) / (by_language.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
    out = np.empty((BUCKETS, codes.shape[1]))
    for bit in range(codes.shape[1]):
        on = codes[:, bit] > 0
        out[:, bit] = np.log(share[on].mean(axis=0)) - np.log(share[~on].mean(axis=0))
    return out


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = ROWS) -> Model:
    """Learn from rows with a language and a letter, about `rows` per language at most, chosen by hash of the text.

    Tasks sum n-gram counts by language, so the driver gets one vector per language and part.
    """
    known = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(
        "lang is not null and text is not null")
    # Distinct texts, as copies share a hash: a row count would leave a language with many copies hardly any text.
    distinct = known.select("lang", F.xxhash64("text", "lang").alias("hash")).distinct()
    sizes = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros((BUCKETS, 0)), np.zeros((0, 0)))
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, rows / n))]), F.col("lang"))
    # Hashes are spread evenly, so this keeps the wanted share of each language; copies count once.
    chosen = known.where((F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) / (1 << 30)) < share)
    sample = stored(chosen.dropDuplicates(), "languages").repartition(8)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter, sums = Grams(), {}
        for batch in batches:
            for body, language in zip(batch["text"], batch["lang"]):
                found = counter.counts(body)
                if found is not None:
                    sums[language] = sums.get(language, 0) + found
        yield pd.DataFrame({"lang": list(sums), "counts": [v.astype("<i8").tobytes() for v in sums.values()]})

    totals = np.zeros((len(languages), BUCKETS))
    for row in sample.mapInPandas(gather, "lang string, counts binary").collect():
        totals[languages.index(row["lang"])] += np.frombuffer(row["counts"], "<i8")
    codes = codewords(len(languages))
    model = Model(languages, codes, _bit_weights(totals, codes), np.ones(codes.shape))
    if len(languages) == 1:
        return model

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Per language: texts, and how many of them each bit's classifier gets right."""
        counter, right = Grams(), np.zeros((len(languages), codes.shape[1] + 1))
        for batch in batches:
            for body, language in zip(batch["text"], batch["lang"]):
                found = counter.counts(body)
                if found is not None:
                    row = languages.index(language)
                    right[row, :-1] += codes[row] * model.margins(found) > 0
                    right[row, -1] += 1
        yield pd.DataFrame({"right": [right.tobytes()]})

    right = sum(np.frombuffer(r["right"]).reshape(len(languages), -1)
                for r in sample.mapInPandas(judge, "right binary").collect())
    trust = (right[:, :-1] + 1) / (right[:, -1:] + 2)
    model.trust = trust / trust.sum(axis=1, keepdims=True) * codes.shape[1]
    return model


def predict(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, `lang_pred`, `score` and `ambiguous` of every row. Null texts and texts without a letter are `und`,
    with score 0; so is every text if the model has learnt no language."""

    def batch(rows: pa.RecordBatch, counter: Grams) -> pa.RecordBatch:
        found = [model.predict(counter.counts(t or "")) for t in rows.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
             pa.array([f[2] for f in found], pa.bool_())], names=["id", "lang_pred", "score", "ambiguous"])

    kind = docs.schema[id].dataType.simpleString()
    narrow = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    found = in_batches(narrow, batch, f"id {kind}, lang_pred string, score double, ambiguous boolean", Grams)
    return found.withColumnRenamed("id", id)
