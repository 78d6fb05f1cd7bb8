"""Benchmark decontamination: a prefix-filtered set join of documents with benchmark windows.

An item's windows are its runs of 13 words (all its words if it has fewer). A
window holds the word shingles of SHINGLE words (one shingle if it is shorter);
a document contains it only if it contains them all, one behind the other.

1. All shingle hashes of the benchmark are set in a Bloom filter of a fixed size.
2. One pass over the documents keeps the runs of consecutive shingles that the
   filter knows and that are long enough for a window (length bound), with
   their words. Nothing else of a document goes on.
3. Over the runs of all documents each shingle is counted. Windows with a
   shingle that no document has are gone. The rarest shingle of each other
   window is its prefix: a document that lacks it cannot hold the window.
4. Prefixes and runs are joined by hash. The shingle's place in the window
   gives the window's place in the run, which must lie within (positional bound).
5. There the words are compared with the window's.
6. Texts that hold the same windows have the same items: the ids of a set of
   windows are gathered and hashed once, whatever number of texts hold it.

Memory: the filter has FILTER_BITS bits at most, whatever the benchmark's size
(more shingles let more runs pass, and change no result); everything else is a
distributed table. Equal texts are one key from step 3 on, so copies are joined
once. Prefixes are sent to all tasks only up to BROADCAST_BYTES; beyond it they
are joined by a shuffle in which the runs' side is salted, the more the larger it is.
Ids of items go with windows, never with the places where they stand.

Defined results: null and empty texts have no words, no hits and are clean;
whole texts of any length are read; items without words or without an id have
no windows; repeated items count once by id; of equally rare shingles the first
is the prefix, which changes no result; repeated documents get equal rows; a
null doc_id stays null; empty tables give empty results or clean documents;
extra columns are not looked at, those of drop_contaminated are kept and its
own are named _td_*.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .arrow import pieces, texts_of
from .files import new_file, open_file
from .shared import new_path, table_bytes, written

WINDOW, SHINGLE = 13, 5
#: Bits of the filter for each shingle, and at most and least in all (powers of two).
BITS_EACH, FILTER_BITS, LEAST_BITS = 16, 1 << 29, 1 << 16
#: Bits set for a shingle.
PROBES = 3
#: Tables up to this size are sent to every task.
BROADCAST_BYTES = 16 << 20
#: Salts of a shuffled join at least, and bytes of runs from which there are more, one for each such part.
SALTS, SALT_BYTES = 8, 64 << 20
#: Words whose hashes a task remembers (about 100 bytes each).
REMEMBERED = 1 << 17

#: A-Z become lower case; all other ASCII but digits and letters parts words.
_FOLD = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
_MIX = np.random.default_rng(13).integers(1, 1 << 63, (WINDOW + 1, WINDOW), np.uint64) | np.uint64(1)

RESULT = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
_RUNS = "array<struct<start:int,size:int,words:string,hashes:array<bigint>>>"


def words_of(text: str) -> list[bytes]:
    """Maximal runs of a-z, 0-9 and non-ASCII characters, after lower-casing A-Z."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class _Hashes(dict):
    """word -> hash, for the words met last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_HASHES = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words, from the words' hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, _MIX[size, -1])
    for j in range(size):
        out ^= hashes[j : j + n] * _MIX[size, j]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def benchmark_shingles(benchmark: DataFrame) -> DataFrame:
    """no, item_id, text, n (words), size and hashes of the shingles of each item with words, each (id, text) once."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = []
                for name, text in zip(part.column("item_id").to_pylist(), texts_of(part), strict=True):
                    words = words_of(text)
                    if words:
                        size = min(SHINGLE, len(words))
                        rows.append((name, text, len(words), size, shingle_hashes(word_hashes(words), size).view(np.int64)))
                kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], ["item_id", "text", "n", "size", "hashes"])

    found = items.mapInArrow(run, "item_id string, text string, n int, size int, hashes array<bigint>")
    return written(found.withColumn("no", F.monotonically_increasing_id()), "benchmark-shingles")


def _places(h: Column, bits: int) -> Column:
    """The bits of a hash in a filter of `bits` (a power of two)."""
    return F.array(*(F.shiftrightunsigned(h, k * 17).bitwiseAND(F.lit(bits - 1)) for k in range(PROBES)))


def write_filter(items: DataFrame, most_bits: int = FILTER_BITS) -> tuple[str, dict[int, int]]:
    """(URI of the filter's bytes, by shingle size the fewest consecutive shingles of a window)."""
    spark = items.sparkSession
    sizes = items.groupBy("size").agg(F.min(F.least("n", F.lit(WINDOW)) - F.col("size") + 1).alias("runs"), F.sum(F.size("hashes")).alias("many")).collect()  # SHINGLE rows at most
    bits = min(most_bits, max(LEAST_BITS, 1 << max(0, int(BITS_EACH * sum(r.many for r in sizes)) - 1).bit_length()))
    at = items.select(F.explode("hashes").alias("h")).select(F.explode(_places(F.col("h"), bits)).alias("p"))
    words = at.groupBy(F.shiftright("p", 6).cast("int").alias("k")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("v"))
    made = np.zeros(bits // 64, np.int64)
    if sizes:
        found = words.toArrow()  # bits / 64 rows at most
        made[found.column("k").to_numpy()] = found.column("v").to_numpy()
    with new_file(new_path(spark, "benchmark-filter"), "bits") as (out, uri):
        out.write(made.astype("<i8").tobytes())
    return uri, {r["size"]: r["runs"] for r in sizes}


@functools.lru_cache(maxsize=1)
def _filter(uri: str) -> np.ndarray:
    with open_file(uri) as f:
        return np.frombuffer(f.read(), "<u8")


def known(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold."""
    ok = np.ones(len(hashes), bool)
    for k in range(PROBES):
        p = (hashes >> np.uint64(17 * k)) & np.uint64(64 * len(bits) - 1)
        ok &= (bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return ok


def runs_of(texts: list[list[bytes]], bits: np.ndarray, least: dict[int, int]) -> list[list[tuple[int, int, str, np.ndarray]]]:
    """For each text, a list of words, (start, shingle size, words, hashes) of the runs of known shingles that are long enough for a window."""
    out: list[list] = [[] for _ in texts]
    ends = np.cumsum([len(w) + 1 for w in texts])  # texts lie end to end, with a place between them that no run spans
    between = ends - 1
    starts = np.append(0, ends[:-1])
    laid = itertools.chain.from_iterable(itertools.chain(w, (b"",)) for w in texts)
    hashed = np.fromiter(map(_HASHES.__getitem__, laid), np.uint64, ends[-1] if len(texts) else 0)
    for size, fewest in least.items():
        hashes = shingle_hashes(hashed, size)
        ok = known(hashes, bits)
        for j in range(size):
            at = between - j
            ok[at[(at >= 0) & (at < len(ok))]] = False
        edge = np.diff(np.concatenate([[0], ok.view(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = last - first >= fewest
        first, last = first[long], last[long]
        owner = np.searchsorted(ends, first, "right")
        for k, a, b in zip(owner.tolist(), first.tolist(), last.tolist(), strict=True):
            at = int(starts[k])
            out[k].append((a - at, size, b" ".join(texts[k][a - at : b - at + size - 1]).decode("utf-8", "surrogatepass"), hashes[a:b].view(np.int64)))
    return out


def with_runs(docs: DataFrame, uri: str, least: dict[int, int]) -> DataFrame:
    """doc_id, n_words, key (of the text) and runs of every document; without runs both are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _filter(uri)
        run_type = pa.struct([("start", pa.int32()), ("size", pa.int32()), ("words", pa.string()), ("hashes", pa.list_(pa.int64()))])
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = texts_of(part)
                words = list(map(words_of, texts))
                found = runs_of(words, bits, least)
                n = list(map(len, words))
                keys = [hashlib.md5(t.encode("utf-8", "surrogatepass")).hexdigest() if r else None for t, r in zip(texts, found, strict=True)]
                runs = [[dict(zip(("start", "size", "words", "hashes"), x, strict=True)) for x in r] or None for r in found]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.string()), pa.array(runs, pa.list_(run_type))], ["doc_id", "n_words", "key", "runs"])
        _HASHES.clear()  # the worker's next task may be another's

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words bigint, key string, runs {_RUNS}")


def windows_of(items: DataFrame, counts: DataFrame) -> DataFrame:
    """hash, at, length, words, item_id of each window of each item all of whose shingles occur in documents, by its rarest shingle. counts: hash, n."""
    spread = items.select("no", F.posexplode("hashes").alias("at", "hash"))
    seen = spread.join(counts, "hash").groupBy("no").agg(F.collect_list(F.struct("at", "n")).alias("seen"))  # an item's length bounds it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["hash", "at", "length", "words", "item_id"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = []
                for r in part.to_pylist():
                    words = words_of(r["text"])
                    length = min(WINDOW, len(words))
                    many = length - r["size"] + 1
                    n = {x["at"]: x["n"] for x in r["seen"]}
                    for start in range(len(words) - length + 1):
                        here = range(start, start + many)
                        if all(k in n for k in here):
                            rarest = min(here, key=lambda k: (n[k], k))
                            rows.append((r["hashes"][rarest], rarest - start, length, b" ".join(words[start : start + length]).decode("utf-8", "surrogatepass"), r["item_id"]))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], names)

    found = items.join(seen, "no").select("item_id", "text", "size", "hashes", "seen").mapInArrow(run, "hash bigint, at int, length int, words string, item_id string")
    return found.distinct()


def _candidates(runs: DataFrame, prefix: DataFrame, broadcast_bytes: int) -> DataFrame:
    """key, run, at, length, words: where a window may stand in a run, within its bounds."""
    hits = runs.select("key", F.posexplode("runs").alias("run", "r")).select("key", "run", F.size("r.hashes").alias("many"), F.col("r.size").alias("size"), F.posexplode("r.hashes").alias("place", "hash"))
    if table_bytes(prefix) <= broadcast_bytes:
        joined = hits.join(F.broadcast(prefix), "hash")
    else:  # a passage of many documents is dealt out
        salts = max(SALTS, table_bytes(runs) // SALT_BYTES)
        salted = prefix.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = hits.withColumn("salt", F.pmod(F.xxhash64("key", "place"), F.lit(salts)).cast("int")).join(salted, ["hash", "salt"])
    start = F.col("place") - F.col("at")
    fits = (start >= 0) & (start + F.col("length") <= F.col("many") + F.col("size") - 1)
    return joined.where(fits).select("key", "run", start.alias("at"), "length", "words")


def _verified(runs: DataFrame, candidates: DataFrame) -> DataFrame:
    """key, n_hit and windows (their words, each once, sorted) of the texts that hold a window, word for word."""
    found = candidates.groupBy("key").agg(F.collect_list(F.struct("run", "at", "length", "words")).alias("found"))  # a text's length bounds it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                words = [x["words"].split(" ") for x in r["runs"]]
                spans, windows = set(), set()
                for c in r["found"]:
                    if " ".join(words[c["run"]][c["at"] : c["at"] + c["length"]]) == c["words"]:
                        start = r["runs"][c["run"]]["start"] + c["at"]
                        spans.add((start, start + c["length"]))
                        windows.add(c["words"])
                hit = upto = 0
                for a, b in sorted(spans):
                    hit += max(0, b - max(a, upto))
                    upto = max(upto, b)
                if hit:
                    rows.append((r["key"], hit, sorted(windows)))
            kinds = [pa.string(), pa.int64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 3, kinds, strict=True)], ["key", "n_hit", "windows"])

    return runs.select("key", "runs").join(found, "key").mapInArrow(run, "key string, n_hit bigint, windows array<string>")


def _with_items(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """key, n_hit, n_items, items_sha256. hits: key, n_hit, windows; windows: words, item_id.

    Texts are grouped by the set of windows that they hold, so the items of a passage are gathered once and not for each text.
    """
    sets = hits.select("windows").distinct()
    items = sets.select("windows", F.explode("windows").alias("words")).join(windows.select("words", "item_id"), "words")
    items = items.select("windows", "item_id").distinct().groupBy("windows").agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item_id")), ",").cast("binary"), 256).alias("items_sha256"))
    return hits.join(items, "windows").select("key", "n_hit", "n_items", "items_sha256")


_NONE = hashlib.sha256(b"").hexdigest()


def _matched(docs: DataFrame, benchmark: DataFrame, most_bits: int, broadcast_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_words, key of every document; key, n_hit, n_items, items_sha256 of those with hits), both tables."""
    items = benchmark_shingles(benchmark)
    uri, least = write_filter(items, most_bits)
    rows = written(with_runs(docs, uri, least), "decontamination-runs")
    # equal texts are one; a shingle counts for each of them
    runs = written(rows.where("key is not null").groupBy("key").agg(F.first("runs").alias("runs"), F.count("*").alias("copies")), "decontamination-texts", compact=True)
    each = runs.select("copies", F.explode(F.array_distinct(F.flatten(F.transform("runs", lambda r: r["hashes"])))).alias("hash"))
    windows = written(windows_of(items, each.groupBy("hash").agg(F.sum("copies").alias("n"))), "decontamination-windows", compact=True)
    prefix = written(windows.select("hash", "at", "length", "words").distinct(), "decontamination-prefixes", compact=True)
    hits = written(_verified(runs, _candidates(runs, prefix, broadcast_bytes)), "decontamination-windows-held", compact=True)
    return rows, written(_with_items(hits, windows), "decontamination-hits", compact=True)


def match(docs: DataFrame, benchmark: DataFrame, most_bits: int = FILTER_BITS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id and RESULT for every row of docs."""
    rows, hits = _matched(docs, benchmark, most_bits, broadcast_bytes)
    side = F.broadcast(hits) if table_bytes(hits) <= broadcast_bytes else hits
    spread = F.concat(F.lit("-"), F.xxhash64("doc_id", "n_words").cast("string"))  # texts without runs are no hot key
    joined = rows.select("doc_id", "n_words", F.coalesce("key", spread).alias("key")).join(side, "key", "left").fillna(0, ["n_hit", "n_items"])
    bad = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return joined.select("doc_id", "n_words", "n_hit", "n_items", F.coalesce("items_sha256", F.lit(_NONE)).alias("items_sha256"), bad.alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, most_bits: int = FILTER_BITS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, that are not contaminated."""
    rows, hits = _matched(docs, benchmark, most_bits, broadcast_bytes)
    words = rows.where("key is not null").groupBy("key").agg(F.first("n_words").alias("n_words"))
    bad = written(hits.join(words, "key").where("20 * n_hit >= n_words").select(F.col("key").alias("_td_key")), "contaminated", compact=True)
    side = F.broadcast(bad) if table_bytes(bad) <= broadcast_bytes else bad
    return docs.withColumn("_td_text", F.md5(F.col("text").cast("binary"))).join(side, F.col("_td_text") == F.col("_td_key"), "left_anti").drop("_td_text")
