"""Ranked lexical search: MaxScore over inverted indexes, one for each shard of documents.

Documents are cut into shards of bounded size in the order that tasks read
them, and a shard's inverted index is one row: terms, the number of documents
of each, and their postings. N, L and the terms' document frequencies are sums
over all shards, so they cover all documents.

For an item a shard's terms are sorted by upper bound (weight times the
shard's largest impact). While the bounds of the least ones add up to less than
the tenth best score so far, documents that hold only those can't qualify:
those terms are non-essential. Documents of the essential lists are scored;
then the non-essential ones are probed, highest bound first, and only for the
documents that can still qualify. The best scores go on from shard to shard of
a task, and each task gives ten documents an item at most, of which a ranked
window keeps ten. No step holds more than a shard, a block of items, or ten
documents for each of its items.

Items come in blocks of bounded size, each sent to all tasks.

Defined results: a document or an item of null or empty text has no terms, and
neither appears; a document of no terms counts in neither N nor L; whole texts
of any length are read; repeated rows are documents of their own, and of equal
scores and ids all are ranked; rows of one item_id, null included, are one
item with the terms of all; documents without an id come after others of equal
score. An empty table of either kind gives an empty result. Other columns are
not looked at.
"""

from __future__ import annotations

import dataclasses
import heapq
import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from .arrow import pieces
from .shared import written

#: Text bytes and documents of a shard; one document's text lies in one shard, however long.
SHARD_BYTES, SHARD_DOCS = 4 << 20, 1 << 13
#: Bytes of a block of items' terms.
BLOCK_BYTES = 8 << 20
#: Bytes of a long text that are cut into words at a time.
CUT_BYTES = 1 << 20
BEST = 10
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def cut_terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, as lists of bounded size."""
    flat = raw.translate(_FOLDED)
    if len(flat) <= CUT_BYTES:
        yield flat.split()
        return
    start = 0
    while start < len(flat):
        stop = flat.find(b" ", start + CUT_BYTES) if start + CUT_BYTES < len(flat) else -1
        stop = len(flat) if stop < 0 else stop
        yield flat[start:stop].split()
        start = stop


class _Shard:
    """Documents taken so far, and their inverted index."""

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.codes: list[np.ndarray] = []
        self.ids: list[Any] = []
        self.lengths: list[int] = []
        self.bytes = 0

    def add(self, doc_id: Any, raw: bytes) -> None:
        seen, n = self.vocabulary, 0
        for words in cut_terms(raw):
            self.codes.append(np.array([seen.setdefault(w, len(seen)) for w in words], np.int32))
            n += len(words)
        if n:
            self.ids.append(doc_id)
            self.lengths.append(n)
        self.bytes += len(raw)

    def full(self) -> bool:
        return self.bytes >= SHARD_BYTES or len(self.ids) >= SHARD_DOCS

    def row(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        docs = len(self.ids)
        key = np.concatenate(self.codes).astype(np.int64) * docs + np.repeat(np.arange(docs), self.lengths)
        key, tfs = np.unique(key, return_counts=True)
        counts = np.bincount(key // docs, minlength=len(self.vocabulary))
        one = lambda values, of: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, of))
        arrays = [pa.array([docs]), pa.array([sum(self.lengths)]), one(self.ids, kind), one(self.lengths, pa.int64()), one([w.decode() for w in self.vocabulary], pa.string()), one(counts, pa.int32()), one(key % docs, pa.int32()), one(tfs, pa.int32())]
        yield pa.RecordBatch.from_arrays(arrays, ["n_docs", "n_terms", "ids", "lengths", "terms", "counts", "postings", "tfs"])


def index(docs: DataFrame) -> DataFrame:
    """A row for each shard, written to the shared folder."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, kind = _Shard(), pa.int64()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in pieces(batch, "text"):
                for i, raw in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    shard.add(i, raw or b"")
                    if shard.full():
                        yield from shard.row(kind)
                        shard = _Shard()
        yield from shard.row(kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"n_docs bigint, n_terms bigint, ids array<{kind}>, lengths array<bigint>, terms array<string>, counts array<int>, postings array<int>, tfs array<int>"
    return written(docs.select("doc_id", "text").mapInArrow(built, schema), "search-index", large_rows=True)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                for k, raw in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                    found = sorted({w for words in cut_terms(raw or b"") for w in words})
                    ids = pa.array([part.column("item_id")[k].as_py()] * len(found), part.schema.field("item_id").type)
                    yield pa.RecordBatch.from_arrays([ids, pa.array([w.decode() for w in found], pa.string())], ["item_id", "term"])

    return items.select("item_id", "text").mapInArrow(run, f"item_id {items.schema['item_id'].dataType.simpleString()}, term string").distinct()


@dataclasses.dataclass
class Block:
    """Items and their terms, as numbers of `terms`."""

    items: list[Any]
    terms: list[str]
    of: list[np.ndarray]
    weights: np.ndarray | None = None


def blocks(items: DataFrame) -> Iterator[Block]:
    """All items, in blocks of BLOCK_BYTES by a hash of their id; an item lies in one block."""
    table = written(item_terms(items), "search-items", compact=True)
    total = table.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    for b in range(n if total else 0):
        rows = table.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b).collect()
        numbers: dict[str, int] = {}
        of: dict[Any, list[int]] = {}
        for item, term in rows:
            of.setdefault(item, []).append(numbers.setdefault(term, len(numbers)))
        if of:
            yield Block(list(of), list(numbers), [np.array(x) for x in of.values()])


def _places(block_terms: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of a block's terms that a shard holds, their places in it)."""
    at = pa.compute.index_in(block_terms, value_set=terms).to_numpy(zero_copy_only=False)
    here = np.flatnonzero(~np.isnan(at)) if at.dtype.kind == "f" else np.arange(len(at))
    return here, at[here].astype(np.int64)


def weighed(table: DataFrame, block: Block, n_docs: int) -> Block:
    """block with its terms' weights: floor(1000 * ln((2 N + 2) / (2 df + 1))), with df over all documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, found = pa.array(block.terms, pa.string()), np.zeros(len(block.terms), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                here, at = _places(mine, batch.column("terms")[k].values)
                found[here] += batch.column("counts")[k].values.to_numpy()[at]
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], ["term", "df"])

    df = np.zeros(len(block.terms), np.int64)
    for term, n in table.select("terms", "counts").mapInArrow(counted, "term bigint, df bigint").groupBy("term").agg(F.sum("df")).collect():
        df[term] = n
    return dataclasses.replace(block, weights=np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], np.int64))


def impacts(tfs: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m), m = 10 + (90 n N) div L."""
    m = 10 + (90 * lengths * n_docs) // n_terms
    return (1_000_000_000 * tfs) // (1000 * tfs + 8 * m)


def _ranked(found: list[tuple[int, Any]]) -> list[tuple[int, Any]]:
    return heapq.nsmallest(BEST, found, key=lambda x: (-x[0], x[1] is None, 0 if x[1] is None else x[1]))


def max_score(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of all that score `least` or more, and could be among the BEST.

    lists: (documents in ascending order, weight times impact) of each of an item's terms.
    """
    none = np.empty(0, np.int64)
    bounds = np.array([int(x.max()) for _, x in lists], np.int64)
    order = np.argsort(bounds, kind="stable")
    reach = np.cumsum(bounds[order])
    skipped = int(np.searchsorted(reach, least))  # reach of those before it is below `least`
    if skipped == len(order):
        return none, none
    scores = np.zeros(n_docs, np.int64)
    for k in order[skipped:]:
        scores[lists[k][0]] += lists[k][1]
    some = np.flatnonzero(scores)
    for place in range(skipped - 1, -1, -1):
        if len(some) > BEST:  # scores so far are lower bounds of the whole ones
            least = max(least, int(np.partition(scores[some], len(some) - BEST)[len(some) - BEST]))
        some = some[scores[some] + reach[place] >= least]
        if not len(some):
            return none, none
        docs, values = lists[order[place]]
        at = np.minimum(np.searchsorted(docs, some), len(docs) - 1)
        hit = docs[at] == some
        scores[some[hit]] += values[at[hit]]
    if len(some) > BEST:
        least = max(least, int(np.partition(scores[some], len(some) - BEST)[len(some) - BEST]))
    some = some[scores[some] >= least]
    return some, scores[some]


def best_of_shards(table: DataFrame, block: Block, n_docs: int, n_terms: int, item_kind: str) -> DataFrame:
    """item_id, doc_id, score: at most BEST documents an item from each task."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, best, kind = pa.array(block.terms, pa.string()), [[] for _ in block.items], pa.int64()
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for k in range(batch.num_rows):
                here, at = _places(mine, batch.column("terms")[k].values)
                counts = batch.column("counts")[k].values.to_numpy()
                stops = np.cumsum(counts, dtype=np.int64)
                lengths = batch.column("lengths")[k].values.to_numpy()
                postings, tfs = (batch.column(x)[k].values.to_numpy() for x in ("postings", "tfs"))
                ids, lists = batch.column("ids")[k].values, {}
                for t, a in zip(here.tolist(), at.tolist(), strict=True):
                    docs = postings[stops[a] - counts[a] : stops[a]]
                    lists[t] = docs, block.weights[t] * impacts(tfs[stops[a] - counts[a] : stops[a]].astype(np.int64), lengths[docs], n_docs, n_terms)
                for j, terms in enumerate(block.of):
                    some = [lists[t] for t in terms.tolist() if t in lists]
                    if some:
                        docs, scores = max_score(some, len(lengths), best[j][-1][0] if len(best[j]) == BEST else 1)
                        if len(docs):
                            best[j] = _ranked(best[j] + list(zip(scores.tolist(), ids.take(pa.array(docs)).to_pylist(), strict=True)))
        rows = [(block.items[j], i, s) for j, found in enumerate(best) for s, i in found]
        items, docs, scores = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(items, item_type), pa.array(docs, kind), pa.array(scores, pa.int64())], ["item_id", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    item_type = to_arrow_type(_parse_datatype_string(item_kind))
    doc_kind = table.schema["ids"].dataType.elementType.simpleString()
    return table.select("ids", "lengths", "terms", "counts", "postings", "tfs").mapInArrow(searched, f"item_id {item_kind}, doc_id {doc_kind}, score bigint")


def rank(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: the BEST documents of each item with a score above 0."""
    table = index(docs)
    n_docs, n_terms = table.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    kind = items.schema["item_id"].dataType.simpleString()
    found = docs.sparkSession.createDataFrame([], f"item_id {kind}, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score bigint")
    for block in blocks(items) if n_docs else ():
        found = found.union(best_of_shards(table, weighed(table, block, n_docs), n_docs, n_terms, kind))
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= BEST).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def oracle() -> str:
    """DuckDB SQL of rank()."""
    terms = r"list_transform(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z\x{80}-\x{10FFFF}]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"
    return f"""
with docs as (select row_number() over () as r, doc_id, {terms} as w from documents),
sizes as (select r, doc_id, len(w) as n from docs where len(w) > 0),
whole as (select count(*) as big_n, sum(n) as big_l from sizes),
wanted as (select distinct item_id, unnest({terms}) as term from benchmark),
tfs as (select r, term, count(*) as tf from (select r, unnest(w) as term from docs) where term in (select term from wanted) group by r, term),
dfs as (select term, count(*) as df from tfs group by term),
parts as (select item_id, r, cast(floor(1000 * ln(cast(2 * big_n + 2 as double) / (2 * df + 1))) as bigint) * ((1000000000 * tf) // (1000 * tf + 8 * cast(10 + (90 * n * big_n) // big_l as bigint))) as part
 from wanted join tfs using (term) join dfs using (term) join sizes using (r), whole),
scores as (select item_id, r, cast(sum(part) as bigint) as score from parts group by item_id, r having sum(part) > 0)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from scores join sizes using (r) qualify rank <= {BEST}"""
