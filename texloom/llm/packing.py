"""Packing by lexical retrieval: a sharded BM25 index finds each seed document's neighbours, which fill its window.

All texts are encoded, with an end id after each. A document's whole windows
are sequences of their own; what is left of each document is packed. Runs of
documents of a bounded size are shards. A shard has an inverted index over
token ids with BM25 weights; document frequencies and the mean length are
counted over all documents. The first unused document of a shard seeds a
window; its best unused neighbours fill it greedily, those that fit first, and
the best one that does not fit is cut to fill the rest. What is left at the
end of a partition goes into sequences whose lengths are powers of two, which
need no padding.

Nothing is shuffled but counts of the vocabulary's size, and a shard bounds
what a task holds. A hot key cannot arise, as shards are runs of rows.

Defined results: a null or empty text is one end id; repeated rows are packed
each on its own; documents of any length are cut into windows; a null doc_id
stays null; an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .arrow import pieces, texts_of
from .encoders import PIECE_BYTES, encoder
from .shared import new_path

WINDOW = 1024
#: A shard ends once it has so many ids or documents.
SHARD_TOKENS, SHARD_DOCS = 2 << 20, 2000
#: BM25; different ids of a seed at most, all looked up, and neighbours that are fetched at a time until the window is full.
K1, B, QUERY, NEIGHBOURS = 1.2, 0.75, WINDOW, 48
#: Ids in more than this share of a shard's pieces have their weights in a row for all pieces.
COMMON = 1 / 8
#: Shortest sequence that a remainder is cut to; a shorter rest is padded.
SHORTEST = 32


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> tuple[DataFrame, np.ndarray, float]:
    """(table of doc_id and ids, documents with each id, mean number of ids), counted over all documents."""
    spark, path = docs.sparkSession, new_path(docs.sparkSession, "packing-ids")
    kind = docs.schema["doc_id"].dataType
    names = ["kind", "doc_id", "ids", "token", "n"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, "byte")
        size = max(enc.tokenizer.get_vocab_size(), end_id + 1)
        having, total, rows, id_type = np.zeros(size, np.int64), 0, 0, pa.int64()
        here = np.zeros(size, bool)
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for part in pieces(batch, "text", PIECE_BYTES):
                made = []
                for ids in enc.encode_all(texts_of(part)):
                    ids = np.append(ids, np.array(end_id, ids.dtype))
                    here[ids] = True
                    once = np.flatnonzero(here)
                    having[once] += 1
                    here[once] = False
                    total, rows = total + len(ids), rows + 1
                    made.append(ids.astype("<u4" if ids.dtype.itemsize > 2 else "<u2").tobytes())
                n = len(made)
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), part.column("doc_id"), pa.array(made, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], names)
        enc.rest()
        if rows:
            at = np.flatnonzero(having)
            token, count = np.append(at, [-1, -2]), np.append(having[at], [rows, total])
            n = len(token)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.nulls(n, id_type), pa.nulls(n, pa.binary()), pa.array(token, pa.int32()), pa.array(count, pa.int64())], names)

    schema = f"kind int, doc_id {kind.simpleString()}, ids binary, token int, n bigint"
    docs.select("doc_id", "text").mapInArrow(encode, schema).write.partitionBy("kind").parquet(path)
    table = spark.read.schema(schema).parquet(path)
    counts = {r.token: r.n for r in table.where("kind = 1").groupBy("token").agg(F.sum("n").alias("n")).collect()}  # at most the vocabulary
    having = np.zeros(max([0, *counts]) + 1, np.int64)
    for k, n in counts.items():
        if k >= 0:
            having[k] = n
    return table.where("kind = 0").select("doc_id", "ids"), having, counts.get(-2, 0) / max(counts.get(-1, 0), 1)


class Index:
    """BM25 postings of one shard's pieces."""

    def __init__(self, parts: list[np.ndarray], idf: np.ndarray, usual: float):
        sizes = np.array([len(p) for p in parts])
        owner = np.repeat(np.arange(len(parts)), sizes)
        key, tf = np.unique(np.concatenate(parts).astype(np.int64) * len(parts) + owner, return_counts=True)
        token, self.doc = np.divmod(key, len(parts))
        weight = idf[token] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[self.doc] / usual))
        self.weight = weight.astype(np.float32)
        self.tokens, first, n = np.unique(token, return_index=True, return_counts=True)
        self.first, self.last = first, first + n
        # each piece's own postings, without ids that no other piece has
        mine = np.flatnonzero((n > 1)[np.searchsorted(self.tokens, token)])
        short = self.doc[mine].astype(np.uint16 if len(parts) < 1 << 16 else np.int64)  # short integers sort by radix
        self.own = mine[np.argsort(short, kind="stable")]
        self.bounds = np.searchsorted(self.doc[self.own], np.arange(len(parts) + 1))
        self.token = token
        common = np.flatnonzero(n > max(1, COMMON * len(parts)))
        self.row = np.full(len(self.tokens), -1)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), len(parts)), np.float32)
        at = np.repeat(self.row, n)
        self.rows[at[at >= 0], self.doc[at >= 0]] = self.weight[at >= 0]

    def asked(self, k: int) -> np.ndarray:
        """The ids of piece k that others have too."""
        return self.token[self.own[self.bounds[k] : self.bounds[k + 1]]]

    def scores(self, k: int, unused: np.ndarray) -> np.ndarray:
        """The BM25 score of each unused piece for all ids of piece k; 0 for the others."""
        ids = np.searchsorted(self.tokens, self.asked(k))
        row = self.row[ids]
        scores = self.rows[row[row >= 0]].sum(0)
        rare = ids[row < 0]
        n = self.last[rare] - self.first[rare]
        at = np.arange(n.sum()) + np.repeat(self.first[rare] - np.cumsum(n) + n, n)
        scores += np.bincount(self.doc[at], self.weight[at], len(unused)).astype(np.float32)
        return scores * unused

    def neighbours(self, k: int, unused: np.ndarray, most: int = NEIGHBOURS) -> np.ndarray:
        """Unused pieces that share ids with piece k, best first."""
        return best_of(self.scores(k, unused), most)


def best_of(scores: np.ndarray, most: int = NEIGHBOURS) -> np.ndarray:
    """Where the highest positive scores are, best first."""
    best = np.argpartition(-scores, most)[:most] if len(scores) > most else np.arange(len(scores))
    best = best[scores[best] > 0]
    return best[np.lexsort((best, -scores[best]))]


def pack_shard(parts: list[np.ndarray], idf: np.ndarray, usual: float, window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (piece, start in it, length); all full but the last. parts: non-empty, shorter than a window."""
    if not parts:
        return
    index = Index(parts, idf, usual)
    left, start = np.array([len(p) for p in parts]), np.zeros(len(parts), np.int64)
    unused, seed = np.ones(len(parts), bool), 0
    sequence: list[tuple[int, int, int]] = []
    room = window

    def take(k: int) -> None:
        nonlocal room
        n = min(int(left[k]), room)
        sequence.append((k, int(start[k]), n))
        start[k] += n
        left[k] -= n
        unused[k] = left[k] > 0
        room -= n

    while True:
        while seed < len(parts) and not unused[seed]:
            seed += 1
        if seed == len(parts):
            break
        take(seed)
        if room:
            scores = index.scores(seed, unused)
            while room and len(best := best_of(scores)):
                scores[best] = 0
                for k in best:
                    if left[k] <= room:
                        take(k)
                        if not room:
                            break
                if room:
                    for k in best:
                        if unused[k]:
                            take(k)
                            if not room:
                                break
        if not room:
            yield sequence
            sequence, room = [], window
    if sequence:
        yield sequence


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of each piece."""
    table, having, usual = tokenized(docs, tokenizer, end_id)
    many = max(int(having.max(initial=0)), 1)
    idf = np.log1p((many - having + 0.5) / (having + 0.5)).astype(np.float32)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, rest = TaskContext.get().partitionId() << 34, 0, []
        held: list[tuple[object, np.ndarray]] = []
        id_type = pa.int64()

        def rows(pieces_: list[tuple[object, np.ndarray, int, int]], number: int) -> Iterator[tuple]:
            offset = 0
            for doc_id, ids, at, n in pieces_:
                yield doc_id, at, n, zlib.crc32(ids[at : at + n].astype("<u4").tobytes()), len(ids), base + number, offset
                offset += n

        def flush(last: bool) -> Iterator[tuple]:
            nonlocal made, rest, held
            tails = []
            for k, (doc_id, ids) in enumerate(held):
                whole = len(ids) // window * window
                for at in range(0, whole, window):
                    yield from rows([(doc_id, ids, at, window)], made)
                    made += 1
                if whole < len(ids):
                    tails.append((k, whole))
            todo = [(*held[k], at, len(held[k][1]) - at) for k, at in tails]
            todo = rest + todo  # what the shard before left over comes first
            rest = []
            for sequence in pack_shard([ids[at : at + n] for _, ids, at, n in todo], idf, usual, window):
                found = [(todo[k][0], todo[k][1], todo[k][2] + start, n) for k, start, n in sequence]
                if sum(x[3] for x in found) == window:
                    yield from rows(found, made)
                    made += 1
                else:
                    rest = found
            held = []
            if last and rest:
                for cut in _powers(rest):
                    yield from rows(cut, made)
                    made += 1

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            kinds = [id_type, *[pa.int64()] * 6]
            values = zip(*found, strict=True) if found else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(values, kinds, strict=True)], columns)

        total = 0
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                ids = np.frombuffer(raw, dtype)
                held.append((doc_id, ids))
                total += len(ids)
                if total >= SHARD_TOKENS or len(held) >= SHARD_DOCS:
                    yield batch_of(list(flush(False)))
                    total = 0
        yield batch_of(list(flush(True)))

    from tokenizers import Tokenizer

    dtype = np.dtype("<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4")
    return table.mapInArrow(packed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in columns[1:]))


def _powers(rest: list[tuple]) -> Iterator[list[tuple]]:
    """The pieces of a sequence that is not full, cut into sequences of powers of two, the longest first; under SHORTEST as it is."""
    total = sum(x[3] for x in rest)
    while total:
        want = 1 << (total.bit_length() - 1) if total >= SHORTEST else total
        cut, rest_ = [], []
        for doc_id, ids, at, n in rest:
            k = min(n, want)
            if k:
                cut.append((doc_id, ids, at, k))
            if n > k:
                rest_.append((doc_id, ids, at + k, n - k))
            want -= k
        yield cut
        rest, total = rest_, sum(x[3] for x in rest_)
