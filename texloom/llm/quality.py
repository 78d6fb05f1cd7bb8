"""Quality rules: an isolation forest over rule statistics of each document.

Every document gets rule statistics (symbols, repeated lines, repeated word
windows and so on). Isolation trees are grown on clean labelled rows; a
document that random splits isolate after few steps is an anomaly. The score
above which a document is rejected comes from other labelled rows, which the
trees have not seen: half of them by a hash of their id.

Defined results: a null or empty text has no words and fails the base rule;
whole texts of any length are read; repeated rows get equal results; a null
doc_id stays null; an empty table gives an empty result; scores that equal the
threshold are kept; without labelled rows of quality 1 in both halves only the
base rule rejects. Other columns of the input are
not looked at, so their names cannot clash.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrow import pieces, texts_of

#: Words of a window whose repetition counts.
WINDOW = 8
#: Most labelled rows that the forest and its threshold are fitted on.
LABELLED_ROWS = 8192
TREES, SAMPLE, SEED = 128, 256, 7
#: By how much of a feature's spread over labelled rows the range of a split is widened.
ROOM = 1.0
#: Share of clean labelled rows that may lie above the threshold.
CLEAN_LOSS = 0.002

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "capitals", "digits", "exclaims", "bars", "stops", "line_words", "stutters"]
_NOT_SYMBOL = bytes(set(range(256)) - set(b"#*$%&|<>"))
_NOT_CAPITAL = bytes(set(range(256)) - set(range(65, 91)))
_NOT_DIGIT = bytes(set(range(256)) - set(b"0123456789"))


def _repeated_words(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per document, words in windows that occur twice or more in it. codes: word ids of all documents, end to end."""
    n, docs = len(codes), len(starts)
    out = np.zeros(docs, np.int64)
    if n < WINDOW:
        return out
    doc = np.repeat(np.arange(docs), ends - starts)
    at = np.flatnonzero(np.arange(n) + WINDOW <= ends[doc])
    if not len(at):
        return out
    mix = np.random.default_rng(SEED).integers(1, 2**63, WINDOW + 1, dtype=np.uint64) | np.uint64(1)
    spread = codes.astype(np.uint64) + np.uint64(1)
    key = doc[at].astype(np.uint64) * mix[WINDOW]
    for j in range(WINDOW):
        x = spread[at + j] * mix[j]
        key += x ^ (x >> np.uint64(29))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return out
    a, b = at[order[:-1][same]], at[order[1:][same]]
    ok = doc[a] == doc[b]
    for j in range(WINDOW):
        ok &= codes[a + j] == codes[b + j]
    if ok.all():
        twice = np.unique(np.concatenate([a, b]))
    else:  # two different windows share a key: compare the windows themselves
        rows = np.column_stack([doc[at], *(codes[at + j] for j in range(WINDOW))])
        _, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        twice = at[counts[inverse.ravel()] > 1]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc[covered], minlength=docs).astype(np.int64)


def rule_statistics(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x BASE, rows x FEATURES) of whole texts."""
    base = np.zeros((len(texts), len(BASE)), np.int64)
    more = np.zeros((len(texts), 7), np.float64)
    seen: dict[bytes, int] = {}
    codes: list[int] = []
    ends = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.split()
        codes.extend([seen.setdefault(w, len(seen)) for w in words])
        ends[i] = len(codes)
        whites = len(raw) - sum(map(len, words))
        lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
        base[i] = len(words), len(text) - whites, len(raw.translate(None, _NOT_SYMBOL)), len(lines) - len(set(lines)), 0
        capitals = len(raw.translate(None, _NOT_CAPITAL))
        more[i] = len(lines), capitals, len(raw.translate(None, _NOT_DIGIT)), raw.count(b"!"), raw.count(b"|"), raw.count(b"."), len(raw)
    starts = np.concatenate([[0], ends[:-1]]) if len(texts) else ends
    flat = np.array(codes, np.int64)
    base[:, 4] = _repeated_words(flat, starts, ends)
    # words that repeat the one before them, counted by what lies between a document's first and last word
    same = np.concatenate([[0, 0], np.cumsum(flat[1:] == flat[:-1])]) if len(flat) else np.zeros(1, np.int64)
    stutters = np.where(ends > starts, same[ends] - same[np.minimum(starts + 1, len(flat))], 0)
    words, lines = np.maximum(base[:, 0], 1), np.maximum(more[:, 0], 1)
    features = np.column_stack([
        base[:, 1] / words, base[:, 2] / words, base[:, 3] / lines, base[:, 4] / words, more[:, 1] / np.maximum(base[:, 1], 1),
        more[:, 2] / np.maximum(base[:, 1], 1), more[:, 3] / words, more[:, 4] / words, more[:, 5] / words, np.log1p(words / lines), stutters / words,
    ])
    return base, features


def base_failed(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < 20) | (100 * base[:, 4] > 30 * base[:, 0])


def _mean_depth(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points in a binary search tree."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclasses.dataclass
class Forest:
    """Isolation trees as arrays (tree x node); a threshold of infinity rejects nothing."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    usual: float
    threshold: float = np.inf

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score from 0 to 1: 2 to the minus mean path length over its usual value."""
        if not len(self.feature) or not len(rows):
            return np.zeros(len(rows))
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for t in range(len(self.feature)):
            node = np.zeros(len(rows), np.int64)
            while True:
                f = self.feature[t][node]
                inner = f >= 0
                if not inner.any():
                    break
                down = np.where(rows[every, np.maximum(f, 0)] < self.cut[t][node], self.left[t][node], self.right[t][node])
                node = np.where(inner, down, node)
            total += self.depth[t][node]
        return 2.0 ** (-total / len(self.feature) / self.usual)


def grow_forest(rows: np.ndarray, spread: np.ndarray | None = None, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Forest:
    """Isolation trees over random samples of rows.

    A split is uniform over the range of a node's values, widened on both sides by ROOM of the feature's
    spread (of all rows, or as given), so that values which no row has are cut off too.
    """
    rng = np.random.default_rng(seed)
    n = min(sample, len(rows))
    if n < 2:
        return Forest(*(np.zeros((0, 1)) for _ in range(5)), usual=1.0)
    most = 2 * int(np.ceil(np.log2(n)))
    room = ROOM * (np.ptp(rows, axis=0) if spread is None else spread)
    made = []
    for _ in range(trees):
        part = rows[rng.choice(len(rows), n, replace=False)]
        nodes: list[list[float]] = []

        def grow(x: np.ndarray, deep: int) -> int:
            k = len(nodes)
            nodes.append([-1, 0.0, 0, 0, deep + float(_mean_depth(len(x)))])
            if len(x) > 1 and deep < most:
                low, high = x.min(0), x.max(0)
                can = np.flatnonzero(high + room > low - room)
                if len(can):
                    f = int(rng.choice(can))
                    cut = rng.uniform(low[f] - room[f], high[f] + room[f])
                    down = x[:, f] < cut
                    nodes[k][:4] = [f, cut, grow(x[down], deep + 1), grow(x[~down], deep + 1)]
            return k

        grow(part, 0)
        made.append(nodes)
    size = max(map(len, made))
    pad = np.array([t + [[-1, 0.0, 0, 0, 0.0]] * (size - len(t)) for t in made])
    return Forest(pad[:, :, 0].astype(np.int64), pad[:, :, 1], pad[:, :, 2].astype(np.int64), pad[:, :, 3].astype(np.int64), pad[:, :, 4], usual=float(_mean_depth(n)))


def calibrated(forest: Forest, rows: np.ndarray, quality: np.ndarray, loss: float = CLEAN_LOSS) -> Forest:
    """forest with the threshold that separates labelled rows best while at most `loss` of the clean ones lie above it."""
    good, bad = np.sort(forest.scores(rows[quality == 1])), np.sort(forest.scores(rows[quality == 0]))
    if not len(good) or not len(forest.feature):
        return dataclasses.replace(forest, threshold=np.inf)
    least = good[min(len(good) - 1, int(np.ceil(len(good) * (1 - loss))) - 1)]
    at = np.unique(np.concatenate([good[good >= least], bad[bad > least], [least]]))
    at = np.append((at[1:] + at[:-1]) / 2, at[-1] + 1e-9) if len(at) > 1 else at + 1e-9
    caught = (len(bad) - np.searchsorted(bad, at, "right")) / max(len(bad), 1)
    lost = (len(good) - np.searchsorted(good, at, "right")) / len(good)
    worth = caught - 10 * lost
    return dataclasses.replace(forest, threshold=float(at[np.flatnonzero(worth == worth.max())[-1]]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Forest:
    """Forest and threshold from at most `rows` labelled documents, chosen by a hash of their id (the documented bound of the fit)."""
    chosen = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).withColumn("held", (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1))
    names = [*FEATURES, "failed"]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                base, features = rule_statistics(texts_of(part))
                yield pa.RecordBatch.from_arrays([part.column("quality"), part.column("held"), *features.T, pa.array(base_failed(base))], ["quality", "held", *names])

    # chosen has at most `rows` rows, so it is small enough to send to every task
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = found.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.first("held").alias("held"), F.min("text").alias("text")).select("quality", "held", "text")  # repeated rows count once
    table = found.mapInArrow(measured, ", ".join(["quality int", "held boolean", *(f"{x} double" for x in FEATURES), "failed boolean"])).toPandas()
    table = table[~table["failed"]].sort_values(FEATURES)  # what the base rule rejects needs no threshold
    features, quality, held = table[FEATURES].to_numpy(np.float64), table["quality"].to_numpy(), table["held"].to_numpy(bool)
    spread = np.ptp(features[~held], axis=0) if not held.all() else None
    return calibrated(grow_forest(features[(quality == 1) & ~held], spread), features[held], quality[held])


def _judged(forest: Forest, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    base, features = rule_statistics(texts_of(part))
    failed, scores = base_failed(base), forest.scores(features)
    return base, failed, scores, ~failed & (scores <= forest.threshold)


def score_documents(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, rule statistics, base_failed, kept and the anomaly score of each row."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                base, failed, scores, kept = _judged(forest, part)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(x) for x in base.T), pa.array(failed), pa.array(kept), pa.array(scores)], ["doc_id", *BASE, "base_failed", "kept", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(judge, ", ".join([f"doc_id {kind}", *(f"{x} bigint" for x in BASE), "base_failed boolean, kept boolean, score double"]))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that the rules keep."""
    forest = fit(docs, labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                yield part.filter(pa.array(_judged(forest, part)[3]))

    return docs.mapInArrow(keep, docs.schema)
