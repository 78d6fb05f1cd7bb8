"""SimHash near-dedup by one-wildcard segment variants.

A fingerprint has 64 bits from the hashes of a text's word shingles. To link
fingerprints at k or fewer differing bits they are cut into k // 2 + 1
segments: if every segment differed at two bits or more there would be more
than k, so one differs at one bit at most. Each segment is indexed under its
variants with one bit blotted out; fingerprints that share a variant are
joined by equality and verified.

A bucket of two fingerprints is one pair. In a larger bucket pairs would grow
with its square, so its members are keyed again, by each value at most k // 2
bits away from them; members that share such a centre differ at no more than k
bits, and are linked with the least of them. For k = 2 that is exact: two values
at two or fewer bits always share a centre within one bit. Components come
from alternating large-star and small-star rounds, written to the shared folder.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; texts of fewer words than a shingle hash as a whole; whole
texts of any length are read; repeated rows get equal results; rows without a
doc_id belong to their component but never name it; an empty table gives an
empty result; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .arrow import pieces, texts_of
from .shared import table_bytes, written

BITS, SHINGLE, DISTANCE, SEED = 64, 3, 2, 42
#: Components of fingerprints with company are sent to every task up to this size, so that no fingerprint of many rows is one task's.
BROADCAST_BYTES = 16 << 20


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """A hash of each shingle of a whole text, with repeats: lower-cased A-Z, words parted by ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist() or [len(flat)]
    one = xxhash.xxh64_intdigest
    return np.array([one(flat[a:b], SEED) for a, b in zip(starts, stops, strict=False)], np.uint64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a whole text."""
    return fingerprint_of(shingle_hashes(text, shingle))


def fingerprint_of(hashes: np.ndarray) -> int:
    """The SimHash of shingle hashes: a bit is set if it is in over half of them."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[k : k + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the 64 bits as a bigint) of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                made = np.array([fingerprint(t, shingle) for t in texts_of(part)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(made)], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(hashed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _variants(distance: int) -> tuple[list[tuple[int, int]], int]:
    """(mask that keeps a segment less one bit, number of the variant), and the count of segments."""
    parts = distance // 2 + 1
    bounds = [round(i * BITS / parts) for i in range(parts + 1)]
    out = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        whole = ((1 << b) - 1) ^ ((1 << a) - 1)
        out += [_signed(whole & ~(1 << i)) for i in range(a, b)]
    return [(m, k) for k, m in enumerate(out)], parts


def _keys(distinct: DataFrame, distance: int) -> DataFrame:
    """variant, value, fp: every fingerprint under each of its 64 variants."""
    variants, _ = _variants(distance)
    table = F.array(*(F.struct(F.lit(k).cast("tinyint").alias("variant"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for m, k in variants))
    return distinct.select("fp", F.explode(table).alias("key")).select("key.variant", "key.value", "fp")


def _apart(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """u, v: links between different fingerprints whose closure is that of all pairs within `distance`. distinct: fp, each once."""
    if distance not in (1, 2):
        raise ValueError("links are exact for a distance of 1 or 2")
    # one shuffle of the keys; of what most of them are, alone in their bucket, nothing is kept
    bucket = Window.partitionBy("variant", "value")
    shared = written(_keys(distinct, distance).withColumn("n", F.count("*").over(bucket)).where("n > 1"), "simhash-buckets", compact=True)
    pairs = shared.where("n = 2").groupBy("variant", "value").agg(F.min("fp").alias("u"), F.max("fp").alias("v")).select("u", "v")
    # members of larger buckets, keyed again by every value within one bit of them
    members = shared.where("n > 2").select("fp").distinct()
    if distance == 2:
        flips = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(BITS)))
    else:
        flips = F.array(*(F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_signed(((1 << BITS) - 1) ^ (1 << i))))) for i in range(BITS)))
    centres = members.select("fp", F.explode(flips).alias("centre"))
    stars = centres.groupBy("centre").agg(F.count("*").alias("n"), F.collect_list("fp").alias("fps")).where("n > 1")  # a centre has BITS + 1 neighbours at most
    stars = stars.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).where("u <> v")
    return pairs.union(stars).where(_apart(F.col("u"), F.col("v")) <= distance).distinct()


def _is_forest(state: DataFrame) -> bool:
    """Whether each node points to one other at most, and none that is pointed to points on."""
    ends = state.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(state.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or out = 1 and into = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of each component with a link, for every node of edges (u, v)."""
    state = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _is_forest(state):
        # large star: each node's greater neighbours go to its least one
        both = state.select("u", "v").union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: each node's lesser neighbours, and it itself, go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        state = written(small, "stars")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the least doc_id that links reach."""
    rows = written(fingerprints(docs, shingle), "fingerprints", compact=True)
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("many")), "distinct-fingerprints", compact=True)
    grouped = components(links(distinct.select("fp"), distance))
    roots = distinct.join(grouped, F.col("fp") == F.col("node")).select("fp", "root", "least")
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(named, "root").select("fp", "component_id")
    # a fingerprint that one row has and no other is linked with names its own component
    every = distinct.join(named, "fp", "left").where("many > 1 or component_id is not null").select("fp", F.coalesce("component_id", "least").alias("component_id"), F.lit(True).alias("shared"))
    every = written(every, "components", compact=True)
    side = F.broadcast(every) if table_bytes(every) <= BROADCAST_BYTES else every
    component = F.when(F.col("shared"), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(side, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))


def keep_one(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """The rows of docs, with all their columns, that stand for their group: those with the least doc_id of each component. Rows without a doc_id stay."""
    drop = near_duplicates(docs, distance, shingle).where("doc_id <> component_id").select(F.col("doc_id").alias("_other_id")).distinct()
    return docs.join(written(drop, "near-duplicates", compact=True), F.col("doc_id") == F.col("_other_id"), "left_anti")
