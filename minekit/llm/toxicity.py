"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel compares words. Every subsequence of three letters that a word holds within six neighbouring
letters is a feature, weighted by LAMBDA to the power of the letters it spans, so an insult keeps most of its
features when letters are inserted or left out. K(a, b) is the product of both feature vectors, scaled by
word length. Landmarks are words; the Nyström map sends a word to K(word, landmarks) K(landmarks,
landmarks)^-1/2, where a linear SVM is trained by dual coordinate descent.

Labels mark documents, words get them in place of sentences: every word of a clean document is clean, and of a
toxic document the word that the present model rates highest is toxic (for the first model: the word most typical
of toxic documents). A text that is toxic only by a phrase of ordinary words is not found.

After training, the SVM's weights are folded back through the landmarks into one weight per feature. Scoring
a word sums looked-up weights: exactly the kernel expansion, at a cost that does not depend on the landmarks.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import in_batches

LENGTH, WINDOW, LAMBDA = 3, 6, 0.5
LONGEST = 32  # letters of a word the kernel sees at once; longer words are cut into overlapping parts
#: Defaults of `fit`: rows it learns from at most (half of them with either label), and landmarks.
ROWS, LANDMARKS = 4000, 300
#: Log likelihood ratio from which a word counts as typical of toxic documents.
EVIDENCE = 7.0
#: Signs that often stand for letters.
_STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_MARKS = ".,;:!?\"'()[]{}<>«»„“”…"
_SPELLED = re.compile(r"(?<!\S)\w(?:[ \t]\w){2,}(?!\S)")
_CODES = 40
_FEATURES = _CODES ** 3
#: Offsets of the second and third letter behind the first, and the weight of that span.
_SPANS = [(i, j, LAMBDA ** (j + 1)) for i, j in itertools.combinations(range(1, WINDOW), 2)]


def tokens_of(text: str | None) -> set[str]:
    """The distinct words of a text as they stand, and runs of three or more single letters as one word."""
    text = (text or "").lower()
    found = set(text.split())
    found.update(run.replace(" ", "").replace("\t", "") for run in _SPELLED.findall(text))
    return found


def parts_of(token: str) -> list[str]:
    """The letters of a token, in overlapping parts if it is long; signs inside are skipped or read as letters."""
    core = token.strip(_MARKS)
    if not core.isalpha():
        core = "".join(filter(str.isalpha, core.translate(_STAND_INS)))
    if len(core) <= LONGEST:
        return [core] if len(core) >= LENGTH else []
    return [core[i:i + LONGEST] for i in range(0, len(core) - LONGEST // 2, LONGEST // 2)]


def codes(words: Sequence[str]) -> np.ndarray:
    """Letters a to z as 1 to 26, others by the remainder of their code point as 27 to 39, 0 behind the end."""
    width = max(map(len, words), default=1)
    points = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), -1).astype(np.int32)
    plain = (points >= 97) & (points <= 122)
    return np.where(points == 0, 0, np.where(plain, points - 96, points % 13 + 27))


def _occurrences(letters: np.ndarray):
    """(feature, weight) of every subsequence, one array per span; feature 0 where the word has ended."""
    for i, j, weight in _SPANS:
        if j < letters.shape[1]:
            last = letters[:, j:]
            feature = (letters[:, :-j] * _CODES + letters[:, i:letters.shape[1] - j + i]) * _CODES + last
            yield np.where(last > 0, feature, 0), weight


#: By word length: the norm of a word that has no subsequence twice. It scales the kernel.
_NORMS = np.array([max(1e-9, sum(max(0, n - j) * w * w for _, j, w in _SPANS)) ** 0.5 for n in range(LONGEST + 1)])


def expand(words: Sequence[str], weights: np.ndarray) -> np.ndarray:
    """The kernel expansion: summed `weights` of the subsequences of every word, scaled. weights[0] must be 0."""
    total = np.zeros((len(words), *weights.shape[1:]), weights.dtype)
    for feature, weight in _occurrences(codes(words)):
        total += weight * weights[feature].sum(axis=1)
    scale = _NORMS[[len(w) for w in words]]
    return total / (scale if weights.ndim == 1 else scale[:, None])


def table_of(words: Sequence[str]) -> np.ndarray:
    """Scaled feature vectors, one column per word."""
    table = np.zeros((_FEATURES, len(words)), np.float32)
    for feature, weight in _occurrences(codes(words)):
        for column, row in enumerate(feature):
            np.add.at(table[:, column], row, weight)
    table[0] = 0
    return table / _NORMS[[len(w) for w in words]].astype(np.float32)


@dataclass
class Model:
    """`weights` by feature and `bias` of the SVM; `slope` and `shift` turn its margin into a probability."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, words: Sequence[str]) -> np.ndarray:
        out = np.full(len(words), self.bias)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(order), 8192):
            own = order[at:at + 8192]
            out[own] += expand([words[i] for i in own], self.weights)
        return out

    def probability(self, margin: float) -> float:
        return 1 / (1 + math.exp(-min(max(self.slope * margin + self.shift, -30), 30)))


class Scorer:
    """Scores texts with a model and remembers the margins of words it has met."""

    def __init__(self, model: Model, most: int = 150_000):
        self.model, self.most, self.known = model, most, {}

    def best(self, texts: Sequence[str | None]) -> list[float]:
        """The margin of the most toxic word of each text; a text without words gets that of a word the model
        knows nothing about."""
        bags = [tokens_of(t) for t in texts]
        if len(self.known) > self.most:
            self.known.clear()
        new = list(set().union(*bags).difference(self.known))
        parts = [parts_of(t) for t in new]
        flat = [p for own in parts for p in own]
        margins = iter(self.model.margins(flat).tolist())
        self.known.update((t, max(itertools.islice(margins, len(own)), default=self.model.bias)) for t, own in zip(new, parts))
        return [max(map(self.known.__getitem__, bag), default=self.model.bias) for bag in bags]

    def scores(self, texts: Sequence[str | None]) -> list[float]:
        return [self.model.probability(m) for m in self.best(texts)]


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int, rng) -> np.ndarray:
    """Linear SVM with hinge loss and a cost per row, by dual coordinate descent."""
    w, alpha, size = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(axis=1)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            slack = (1 - y[i] * (x[i] @ w)) / size[i]
            new = min(max(alpha[i] + slack, 0.0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def _inserted(word: str, rng) -> str:
    at = int(rng.integers(1, len(word)))
    return word[:at] + chr(97 + int(rng.integers(26))) + word[at:]


def train(rows: list[tuple[str, int]], landmarks: int = LANDMARKS, rounds: int = 3, cost: float = 100.0, seed: int = 7) -> Model:
    """Fit on `rows` of (text, label). With one label only, or without words typical of label 1, the model
    answers that label's share for every text."""
    rows = list(dict.fromkeys(rows))  # copies say nothing new
    labels = np.array([y for _, y in rows], bool)
    share = float(labels.mean()) if len(rows) else 0.0
    constant = Model(np.zeros(_FEATURES), 0.0, 0.0, math.log((share + 1e-3) / (1 - share + 1e-3)))
    if not 0 < share < 1:
        return constant
    bags = [sorted({p for t in tokens_of(text) for p in parts_of(t)}) for text, _ in rows]
    toxic, clean = Counter(), Counter()
    for bag, label in zip(bags, labels):
        (toxic if label else clean).update(bag)
    n_toxic, n_clean = int(labels.sum()), int((~labels).sum())

    def lift(word: str) -> float:
        return (toxic[word] / n_toxic) / ((clean[word] + 0.5) / n_clean)

    total = n_toxic / (n_toxic + n_clean)

    def evidence(word: str) -> float:
        """Log likelihood ratio of the word's own share of toxic documents against the share of all."""
        n, c = toxic[word], clean[word]
        own = n / (n + c)
        return n * math.log(own / total) + (c * math.log((1 - own) / (1 - total)) if c else 0.0)

    # Words that occur in several toxic documents and hardly in clean ones, beyond chance.
    typical = {w: e for w, n in toxic.items() if n > 1 and lift(w) > 4 and (e := evidence(w)) > EVIDENCE}
    if not typical:
        return constant
    ordered = sorted(typical, key=lambda w: (-typical[w], w))
    frequent = sorted((w for w in clean if w not in typical), key=lambda w: (-clean[w], w))
    rng = np.random.default_rng(seed)
    marks = ordered[: landmarks // 2]
    pool = frequent[: 20 * landmarks]
    marks += [pool[i] for i in sorted(rng.permutation(len(pool))[: landmarks - len(marks)])]
    table = table_of(marks)
    values, vectors = np.linalg.eigh((table.T @ table).astype(float))
    keep = values > 1e-3 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])

    def mapped(words: list[str]) -> np.ndarray:
        """Nyström features of words, and a constant."""
        found = [expand(words[i:i + 256], table) for i in range(0, len(words), 256)]
        return np.hstack([np.concatenate(found) @ root, np.ones((len(words), 1))])

    witness: Counter[str] = Counter({w: toxic[w] for w in ordered})
    negative = frequent[:1500]
    model = constant
    for turn in range(rounds):
        # A word of a single subsequence is like many others: as a witness it must be typical by itself.
        positive = [w for w in witness if len(w) > LENGTH or w in typical][: 3000]
        variants = [_inserted(w, rng) for w in positive[:200]]
        words = positive + variants + negative
        weight = np.array([math.sqrt(witness[w]) for w in positive] + [0.7 * math.sqrt(witness[w]) for w in positive[:200]]
                          + [math.sqrt(clean[w]) for w in negative])
        y = np.array([1.0] * (len(positive) + len(variants)) + [-1.0] * len(negative))
        fold = _svm(mapped(words), y, cost * weight / weight.mean(), 40, rng)
        model = Model((table @ (root @ fold[:-1])).astype(np.float64), float(fold[-1]), 1.0, 0.0)
        # The toxic word of each toxic document, and the clean words taken for one.
        vocabulary = sorted({w for bag in bags for w in bag})
        margin = dict(zip(vocabulary, model.margins(vocabulary).tolist()))
        witness = Counter(max(bag, key=margin.__getitem__) for bag, label in zip(bags, labels) if label and bag)
        witness = Counter({w: n for w, n in witness.items() if margin[w] > 0 and lift(w) > 4 and not (n < 2 and clean[w])})
        witness.update({w: toxic[w] for w in ordered if margin[w] > 0})
        hard = sorted((w for w in clean if w not in witness), key=lambda w: (-margin[w], w))[:1500]
        negative = list(dict.fromkeys([*frequent[:1500], *negative, *hard]))
        negative = [w for w in negative if w not in witness]
        if not witness:
            break
    margins = np.array([max((margin[w] for w in bag), default=model.bias) for bag in bags])
    model.slope, model.shift = _threshold(margins, labels)
    return model


def _threshold(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that give 0.5 where the margins of both labels part with the fewest errors."""
    order = np.argsort(margins, kind="stable")
    m, is_toxic = margins[order], labels[order]
    weight = np.where(is_toxic, 1.0, (labels.sum() / max(1, (~labels).sum())) ** 0.5 + 1)
    missed = np.concatenate(([0], np.cumsum(weight * is_toxic)))
    wrong = missed + np.concatenate((np.cumsum((weight * ~is_toxic)[::-1])[::-1], [0]))
    allowed = np.concatenate(([True], m[1:] > m[:-1], [True]))
    best = np.flatnonzero(allowed & (wrong <= wrong[allowed].min() + 1e-9))[-1]
    low, high = m[best - 1] if best else m[0] - 1, m[best] if best < len(m) else m[-1] + 1
    slope = 2 / max(float(m.std()), 1e-6)
    return slope, -slope * float(low + high) / 2


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    rows: int = ROWS, landmarks: int = LANDMARKS,
) -> Model:
    """Learn from documents with a label, at most `rows` of them: the ones whose ids have the smallest hashes.

    The texts of those rows come to the driver, where the model is trained; null texts and labels are left out.
    """
    # The same limit for either label, so that the rarer one is not left with a handful.
    marked = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("label")).where("label in (0, 1) and id is not null")
    chosen = [
        marked.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(rows // 2) for y in (0, 1)
    ]
    chosen = chosen[0].unionByName(chosen[1])
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).where("text is not null")
    found = chosen.join(texts, "id").toPandas().sort_values(["id", "label", "text"])
    return train(list(zip(found["text"], found["label"])), landmarks)


def scores(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and `score` (0 to 1) of every row of `docs`. A text without words scores as one whose words are clean."""
    def batch(rows: pa.RecordBatch, scorer: Scorer) -> pa.RecordBatch:
        found = scorer.scores(rows.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.float64())], names=["id", "score"])

    kind = docs.schema[id].dataType.simpleString()
    narrow = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    found = in_batches(narrow, batch, f"id {kind}, score double", lambda: Scorer(model))
    return found.withColumnRenamed("id", id)


def without_toxic(docs: DataFrame, model: Model, text: str = "text", most: float = 0.5) -> DataFrame:
    """The rows of `docs` that score below `most`, unchanged."""
    def batch(rows: pa.RecordBatch, scorer: Scorer) -> pa.RecordBatch:
        texts = rows.column(rows.schema.names.index(text))
        return rows.filter(pa.array([s < most for s in scorer.scores(texts.to_pylist())], pa.bool_()))

    return in_batches(docs, batch, docs.schema, lambda: Scorer(model))
