"""Toxicity: a counterfactually regularised linear classifier.

A text's features are its words and the prefixes of its words (PREFIX letters),
each with log(1 + count), and log(1 + number of words). A logistic regression
is fitted on labelled rows. In each labelled sentence that names a group, the
group's name is swapped with the next one of its list (which ends with a plain
word for a person), and the square of the score's change, as log-odds, is
penalised. So a name that toxic sentences often hold can't carry weight of its
own, and neutral mentions of groups stay clean.

The features are those that separate labelled rows best by a log-odds ratio
over its standard error, with counts summed in Spark over the labelled sample.

Bounds: LABELLED_ROWS rows, by a hash of their id; FEATURES features; PAIRS
swapped sentences, by a hash of the sentence. Scoring reads all rows, whole.

Defined results: null and empty texts get the score that the model gives to no
words; rows without a doc_id are scored and never learned from; of labelled
rows that share a doc_id the greater label and the least text count, once; with
no labels, or labels of one value, the score is the share of toxic labels (0 if
none) for every text; repeated rows get equal scores; an empty table gives an
empty result. Other columns are not looked at.
"""

from __future__ import annotations

import dataclasses
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrow import pieces, texts_of
from .shared import written

LABELLED_ROWS, FEATURES, PAIRS = 8192, 2048, 8192
#: Labelled rows that must hold a feature.
LEAST_ROWS = 3
PREFIX = range(3, 9)
#: Weight of the squared change of log-odds under a swap, and of squared weights.
SWAP_PENALTY, RIDGE = 5.0, 1e-4
STEPS, RATE = 400, 0.05
#: Words whose features a task remembers.
REMEMBERED = 1 << 18

#: Names of groups that are swapped with one another. The last of each list names nobody's group.
GROUPS = [
    ["women", "men", "girls", "boys", "people"], ["woman", "man", "girl", "boy", "person"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists", "people"], ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "local"],
    ["black", "white", "asian", "latino", "african", "arab", "european", "local"], ["immigrants", "refugees", "foreigners", "mexicans", "people"], ["immigrant", "refugee", "foreigner", "mexican", "person"],
    ["gay", "lesbian", "bisexual", "straight", "transgender", "queer", "local"], ["disabled", "blind", "deaf", "old", "young", "local"],
    ["frauen", "männer", "muslime", "juden", "christen", "ausländer", "menschen"], ["femmes", "hommes", "musulmans", "juifs", "chrétiens", "immigrés", "gens"], ["mujeres", "hombres", "musulmanes", "judíos", "cristianos", "inmigrantes", "personas"],
]
#: A name that stands in several lists is swapped by the first.
SWAPS = {name: group[(i + 1) % len(group)] for group in reversed(GROUPS) for i, name in enumerate(group)}
NAMES = {name for group in GROUPS for name in group[:-1]}

_WORD = re.compile(r"[^\W_]+")
_PARTS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SENTENCE = re.compile(r"[^.!?\n]+")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_PARTS).split()


def names_of(word: bytes) -> list[str]:
    """The features that a word counts for."""
    text = word.decode("utf-8", "replace")
    return ["=" + text, *(text[:n] for n in PREFIX if n <= len(text))]


def feature_counts(text: str) -> tuple[Counter[str], int]:
    """(feature -> count, number of words) of a whole text."""
    words = words_of(text)
    out: Counter[str] = Counter()
    for word, n in Counter(words).items():
        for name in names_of(word):
            out[name] += n
    return out, len(words)


def swapped(sentence: str) -> str | None:
    """sentence with each group's name swapped with the next one; None if it names no group."""
    found = [False]

    def swap(m: re.Match[str]) -> str:
        word = m[0].lower()
        found[0] |= word in NAMES
        return SWAPS[word] if word in NAMES else m[0]

    out = _WORD.sub(swap, sentence)
    return out if found[0] else None


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a row's label is not for learning: crc32 of the id as text, modulo 4, is 2."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % 4 == 2, F.lit(False))


@dataclasses.dataclass
class Model:
    """weights of the features, of log(1 + words), and of no word at all."""

    features: dict[str, int]
    weights: np.ndarray
    of_length: float
    base: float

    def scores(self, texts: Iterable[str], seen: dict[bytes, list[int]] | None = None) -> np.ndarray:
        """Probabilities from 0 to 1. seen: keeps words' features from call to call."""
        seen = {} if seen is None else seen
        out = []
        for text in texts:
            words, counts = words_of(text), Counter[int]()
            for word, n in Counter(words).items():
                mine = seen.get(word)
                if mine is None:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    mine = seen[word] = [self.features[x] for x in names_of(word) if x in self.features]
                for k in mine:
                    counts[k] += n
            at = self.base + self.of_length * math.log1p(len(words)) + sum(self.weights[k] * math.log1p(n) for k, n in counts.items())
            out.append(1 / (1 + math.exp(-max(-500.0, min(500.0, at)))))
        return np.array(out, np.float64)


def constant(share: float) -> Model:
    """Gives every text the same score."""
    share = min(max(share, 1e-12), 1 - 1e-12)
    return Model({}, np.zeros(0), 0.0, math.log(share / (1 - share)))


def learned(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, lengths: np.ndarray, toxic: np.ndarray, changes: tuple[np.ndarray, np.ndarray, np.ndarray], features: int, penalty: float = SWAP_PENALTY) -> tuple[np.ndarray, float, float]:
    """(weights, of_length, base) that minimise log loss + penalty * mean squared change of log-odds + RIDGE * squares.

    rows, columns, values: the labelled texts' features. changes: the same of the differences between sentences and their swapped versions.
    """
    pair, column, change = changes
    pairs = int(pair.max()) + 1 if len(pair) else 0
    dense = np.column_stack([np.log1p(lengths), np.ones(len(toxic))])
    w, m, v = (np.zeros(features + 2) for _ in range(3))
    for step in range(1, STEPS + 1):
        at = np.bincount(rows, values * w[columns], len(toxic)) + dense @ w[-2:]
        off = (1 / (1 + np.exp(-np.clip(at, -500, 500))) - toxic) / len(toxic)
        slope = np.concatenate([np.bincount(columns, values * off[rows], features), dense.T @ off])
        slope[:-2] += RIDGE * w[:-2]
        if pairs:
            moved = np.bincount(pair, change * w[column], pairs) * (2 * penalty / pairs)
            slope[:-2] += np.bincount(column, change * moved[pair], features)
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope * slope
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w[:-2], float(w[-2]), float(w[-1])


def labelled(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """toxic, text of at most `rows` labelled documents that are for learning, by a hash of their id."""
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # chosen has at most `rows` rows, so it is small enough to send to every task
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return written(found.groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text"), "toxicity-labelled")


def chosen_features(sample: DataFrame, toxic: int, clean: int, most: int = FEATURES) -> list[str]:
    """The features with the greatest log-odds ratio over its standard error."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                found: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
                for label, text in zip(part.column("toxic").to_pylist(), texts_of(part), strict=True):
                    found[label].update(feature_counts(text)[0].keys())
                names = list(found[0].keys() | found[1].keys())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in found)], ["feature", "clean", "toxic"])

    p, q = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(p / (toxic + 1 - p)) - F.log(q / (clean + 1 - q))
    error = F.sqrt(1 / p + 1 / q + 1 / (toxic + 1 - p) + 1 / (clean + 1 - q))
    found = sample.mapInArrow(counted, "feature string, clean bigint, toxic bigint").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    found = found.where(F.col("clean") + F.col("toxic") >= LEAST_ROWS).orderBy(F.desc(F.abs(odds / error)), "feature").limit(most)
    return [r["feature"] for r in found.select("feature").collect()]


def _sparse(found: list[dict[int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
    return rows, np.array([k for x in found for k in x], np.int64), np.array([v for x in found for v in x.values()], np.float64)


def fit(docs: DataFrame, labels: DataFrame, penalty: float = SWAP_PENALTY, rows: int = LABELLED_ROWS) -> Model:
    """The model, fitted on the driver on the features of a bounded sample."""
    sample = labelled(docs, labels, rows)
    counts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        return constant(toxic / max(toxic + clean, 1))
    names = chosen_features(sample, toxic, clean)
    number = {x: k for k, x in enumerate(names)}

    def values_of(text: str) -> tuple[dict[int, float], int]:
        found, n = feature_counts(text)
        return {number[x]: math.log1p(k) for x, k in found.items() if x in number}, n

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                found = [values_of(t) for t in texts_of(part)]
                arrays = [part.column("toxic"), pa.array([n for _, n in found], pa.int64()), pa.array([list(x) for x, _ in found], pa.list_(pa.int16())), pa.array([list(x.values()) for x, _ in found], pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(arrays, ["toxic", "n", "features", "counts"])

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                sentences, changes = [], []
                for text in texts_of(part):
                    for m in _SENTENCE.finditer(text):
                        other = swapped(m[0])
                        if other is not None:
                            a, b = values_of(m[0])[0], values_of(other)[0]
                            change = {k: a.get(k, 0.0) - b.get(k, 0.0) for k in a.keys() | b.keys()}
                            sentences.append(m[0])
                            changes.append({k: x for k, x in change.items() if x})
                arrays = [pa.array(sentences, pa.string()), pa.array([list(x) for x in changes], pa.list_(pa.int16())), pa.array([list(x.values()) for x in changes], pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(arrays, ["sentence", "features", "changes"])

    # no more than LABELLED_ROWS rows of FEATURES numbers, and PAIRS of those
    table = sample.mapInArrow(measured, "toxic int, n bigint, features array<smallint>, counts array<float>").toPandas()
    pairs = sample.select("text").mapInArrow(changed, "sentence string, features array<smallint>, changes array<float>").where("size(features) > 0")
    pairs = pairs.orderBy(F.xxhash64("sentence"), "sentence").limit(PAIRS).select("features", "changes").toPandas()
    texts = _sparse([dict(zip(a, b, strict=True)) for a, b in zip(table["features"], table["counts"], strict=True)])
    changes = _sparse([dict(zip(a, b, strict=True)) for a, b in zip(pairs["features"], pairs["changes"], strict=True)])
    weights, of_length, base = learned(*texts, table["n"].to_numpy(np.float64), table["toxic"].to_numpy(np.float64), changes, len(names), penalty)
    return Model(number, weights, of_length, base)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out and score of each row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}
        for batch in batches:
            for part in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.scores(texts_of(part), seen))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double").select("doc_id", held_out().alias("held_out"), "score")
