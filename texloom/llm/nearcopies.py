"""SimHash near-dedup at a similarity: groups of texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from the SimHash operator (simhash.links: fingerprints of
5-word shingles at two or fewer differing bits, by one-wildcard variants). At a
similarity of 0.8 fingerprints differ at about ten bits, where segments would be
too short to select; so MinHash bands give candidates too. Two texts of
similarity s agree in a band of ROWS minima with probability s ** ROWS: one
pair in 38,000 of similarity 0.8 meets in none of the BANDS, and fewer above.
Each candidate is verified on the whole sets, and verified ones are linked.

Pairs of a bucket would grow with its square, so each bucket has a centre, the
same text wherever it lies, and each text is first compared with FIRST of its
buckets' centres. What that has linked needs no further look: only buckets that
still hold several groups go on. One of up to SMALL different texts gives all
its pairs of different groups. Larger ones are joined exactly, by a prefix
filter over the sets' differences from a centre (exact_pairs). So each pair of
similar texts that share a bucket is linked, by itself or through others, and
the number of jobs depends on no data but the depth of the links.

Texts are told apart by 64-bit hashes: among 1e10 different ones about three
pairs are taken as equal.

Defined results: null and empty texts are alike; texts of fewer words than a
shingle are one shingle; whole texts of any length are read; repeated rows and
equal texts are of one group; of a group the row with the least doc_id stands;
rows without a doc_id belong to their group but never name it; an empty table
gives an empty result; extra columns are kept and not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .arrow import pieces, texts_of
from .shared import written
from .simhash import DISTANCE, components, fingerprint_of, links as fingerprint_links, shingle_hashes

BANDS, ROWS, SHINGLE, LEAST = 20, 4, 5, 0.8
#: Centres that a text is compared with at first.
FIRST = 4
#: Different texts in a bucket up to which all its pairs are compared.
SMALL = 32
#: Two sets have a similarity of LEAST or more if they have APART times as many members as their symmetric difference.
APART = round((1 + LEAST) / (1 - LEAST))
_MULTIPLY, _ADD = np.random.default_rng(42).integers(0, 1 << 63, (2, BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str) -> np.ndarray:
    """The set of shingle hashes, sorted."""
    return np.unique(shingle_hashes(text, SHINGLE))


def bands(found: np.ndarray) -> list[int]:
    """A signed hash of each band's minima."""
    least = np.full((BANDS * ROWS, 1), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(found), 1 << 12):
        np.minimum(least, (found[k : k + (1 << 12)] * _MULTIPLY + _ADD).min(1, keepdims=True), out=least)
    return [xxhash.xxh64_intdigest(row.tobytes()) - (1 << 63) for row in least.reshape(BANDS, ROWS)]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets have a similarity of LEAST or more."""
    if min(len(a), len(b)) < LEAST * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= LEAST * (len(a) + len(b) - common)


def _sig():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, sig (a hash of the text), fp (its SimHash), n (its different shingles) and bands of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                fps, sizes, rows = [], [], []
                for text in texts_of(part):
                    hashes = shingle_hashes(text, SHINGLE)
                    found = np.unique(hashes)
                    fps.append(fingerprint_of(hashes))
                    sizes.append(len(found))
                    rows.append(bands(found))
                made = [pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(rows, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("sig"), *made], ["doc_id", "sig", "fp", "n", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", _sig().alias("sig")).mapInArrow(run, f"doc_id {kind}, sig bigint, fp bigint, n int, bands array<bigint>")


_NODE = "struct(sig, n) as t"


def fingerprint_candidates(distinct: DataFrame) -> DataFrame:
    """u, v (structs of sig and n): texts of equal fingerprints with the first of them, and the first ones of fingerprints that SimHash links."""
    firsts = written(distinct.groupBy("fp").agg(F.min(F.struct("sig", "n")).alias("first")), "nearcopies-fingerprints")
    same = distinct.join(firsts, "fp").where("sig <> first.sig").selectExpr("first as u", "struct(sig, n) as v")
    found = fingerprint_links(firsts.select("fp"), DISTANCE)
    for end in ("u", "v"):
        found = found.join(firsts.select(F.col("fp").alias(end), F.col("first").alias(f"{end}_")), end)
    return same.union(found.selectExpr("u_ as u", "v_ as v"))


def band_buckets(distinct: DataFrame) -> DataFrame:
    """t, band, value, many and centre of every text in each bucket of two and more."""
    keys = distinct.select(F.expr(_NODE), F.posexplode("bands").alias("band", "value"))
    return written(_with_centres(keys, ["band", "value"]), "nearcopies-buckets", compact=True)


def _with_centres(keys: DataFrame, by: list[str]) -> DataFrame:
    buckets = keys.groupBy(*by).agg(F.count("*").alias("many"), F.min_by("t", F.xxhash64("t.sig")).alias("centre")).where("many > 1")
    return keys.join(buckets, by)


def _to_centres(members: DataFrame) -> DataFrame:
    """u, v: each text with the least FIRST, by a hash, of its buckets' centres; it has one bucket a band."""
    centres = members.where("t.sig <> centre.sig").groupBy("t").agg(F.array_sort(F.collect_set(F.struct(F.xxhash64("centre.sig").alias("place"), "centre"))).alias("cs"))
    return centres.select(F.col("t").alias("u"), F.explode(F.slice("cs", 1, FIRST)).alias("c")).selectExpr("u", "c.centre as v")


def mixed_buckets(members: DataFrame, roots: DataFrame) -> DataFrame:
    """t, band, value, root, many of the members of buckets that hold more than one group. roots: node, root of linked texts."""
    by = ["band", "value"]
    grouped = members.select("t", *by).join(roots, F.col("t.sig") == F.col("node"), "left").selectExpr("t", *by, "coalesce(root, t.sig) as root")
    several = grouped.groupBy(*by).agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("many")).where("a <> b").select(*by, "many")
    return written(grouped.join(several, by), "nearcopies-mixed", compact=True)


def _pairs(members: DataFrame) -> DataFrame:
    """u, v of different groups in each bucket; a bucket has SMALL members at most."""
    whole = members.groupBy("band", "value").agg(F.collect_list(F.struct("t", "root")).alias("ts"))
    return whole.select("ts", F.explode("ts").alias("u")).select("u", F.explode("ts").alias("v")).where("u.t.sig < v.t.sig and u.root <> v.root").selectExpr("u.t as u", "v.t as v")


def _with_texts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """u, v, text, other: pairs of sigs with the texts of both."""
    needed = written(pairs.select(F.col("u").alias("sig")).union(pairs.select("v")).distinct(), "nearcopies-needed")
    some = docs.select(_sig().alias("sig"), "text").join(needed, "sig", "left_semi")
    texts = written(some.groupBy("sig").agg(F.first("text").alias("text")), "nearcopies-texts")
    both = pairs.join(texts.withColumnRenamed("sig", "u"), "u").join(texts.select(F.col("sig").alias("v"), F.col("text").alias("other")), "v")
    return both.select("u", "v", "text", "other")


def verified(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """u, v: the sigs of candidates whose whole sets are similar."""
    close = F.least("u.n", "v.n") >= LEAST * F.greatest("u.n", "v.n")
    pairs = candidates.where(close).select(F.least("u.sig", "v.sig").alias("u"), F.greatest("u.sig", "v.sig").alias("v")).where("u <> v").distinct()
    pairs = written(pairs, "nearcopies-candidates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                same = [similar(shingles(a), shingles(b)) for a, b in zip(texts_of(part), texts_of(part, "other"), strict=True)]
                yield part.select(["u", "v"]).filter(pa.array(same, pa.bool_()))

    return written(_with_texts(docs, pairs).mapInArrow(run, "u bigint, v bigint"), "nearcopies-links", compact=True)


def _centred(members: DataFrame) -> DataFrame:
    """t, root, c, main of members: c, of root main, is the text of the largest group of t's bucket whose buckets hold the most. Members of buckets with one largest group have one c."""
    by = [c for c in members.columns if c not in ("t", "root", "many")]
    groups = members.groupBy(*by, "root").agg(F.count("*").alias("size"))
    main = groups.groupBy(*by).agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.sum("size").alias("all"))
    main = written(main, "nearcopies-main-groups")
    weights = members.join(main, by).groupBy("t", "root").agg(F.sum("all").alias("weight"))
    centres = weights.groupBy(F.col("root").alias("main")).agg(F.max_by("t", F.struct("weight", "t.sig")).alias("c"))
    # a bucket is one row when it meets its centre: a group may have most of the members
    named = main.join(centres, "main").select(*by, "main", "c")
    return written(members.join(named, by).select("t", "root", "c", "main").distinct(), "nearcopies-centred")


def exact_pairs(docs: DataFrame, members: DataFrame) -> DataFrame:
    """u, v: pairs of different groups among the texts of members, that all pairs of a bucket that are similar are linked by; an exact prefix filter.

    Texts are looked at as what tells them from a centre c: D(x), the shingles in one of x and c only. x and y are similar if and only if
    x ^ y = D(x) ^ D(y) has (|x| + |y|) / APART shingles at most, so D(x) and D(y) share a number that grows with their sizes.
    Texts similar to c are linked with it. Of any other pair D(x) and D(y) share one at least: with their shingles in one order, the
    rarest first, and i and j the places of the first that they share, 1 + min(|D(x)| - i, |D(y)| - j) is what they can share.
    What near copies have in common stands in no D, so the shingles that meet are those that few of them lost or got.
    """
    some = _centred(members)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = [np.setxor1d(shingles(a), shingles(b), assume_unique=True).view(np.int64) for a, b in zip(texts_of(part), texts_of(part, "other"), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("u"), part.column("v"), pa.array(rows, pa.list_(pa.int64()))], ["u", "v", "tokens"])

    apart = _with_texts(docs, some.selectExpr("t.sig as u", "c.sig as v")).mapInArrow(run, "u bigint, v bigint, tokens array<bigint>")
    rows = some.join(apart, (F.col("t.sig") == F.col("u")) & (F.col("c.sig") == F.col("v"))).withColumn("size", F.size("tokens"))
    rows = rows.withColumn("near", APART * F.col("size") <= F.col("t.n") + F.col("c.n")).select("t", "root", "c", "main", "size", "near", "tokens")
    rows = written(rows, "nearcopies-apart", compact=True)
    # the least that D(t) shares with another D, whatever that is: one of a pair is not near
    excess = APART * F.col("size") + F.when(F.col("near"), F.col("c.n") - F.col("t.n")).otherwise(-F.col("c.n") - F.col("t.n"))
    need = F.greatest(F.lit(1), F.ceil(excess / (2 * APART)))
    tokens = rows.select("t", "root", F.col("c.sig").alias("c"), "size", "near", need.alias("need"), F.explode("tokens").alias("token"))
    ranked = tokens.join(tokens.groupBy("c", "token").agg(F.count("*").alias("df")), ["c", "token"])
    ranked = ranked.withColumn("place", F.row_number().over(Window.partitionBy("c", "t").orderBy("df", "token"))).where("df > 1 and place <= size - need + 1")
    first = written(ranked.select("c", "token", "t", "root", "near", F.col("size").alias("a"), (F.col("size") - F.col("place")).alias("left")), "nearcopies-prefixes", compact=True)
    far = first.where("not near").select("c", "token", F.col("t").alias("u"), *(F.col(k).alias(f"_{k}") for k in ("root", "a", "left")))
    can = 2 * APART * (1 + F.least("_left", "left")) >= APART * (F.col("_a") + F.col("a")) - F.col("u.n") - F.col("t.n")
    close = F.least("u.n", "t.n") >= LEAST * F.greatest("u.n", "t.n")
    found = far.join(first, ["c", "token"]).where(can & close).where("root <> _root and (near or u.sig < t.sig)").select("u", F.col("t").alias("v"))
    return found.union(rows.where("near and root <> main").select("t", "c")).distinct()


def links(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """u, v: verified pairs whose closure is that of all candidates'."""
    members = band_buckets(distinct)
    found = verified(docs, _to_centres(members).union(fingerprint_candidates(distinct)))
    roots = components(found)
    mixed = mixed_buckets(members, roots)
    if mixed.isEmpty():
        return found
    new = verified(docs, _pairs(mixed.where(F.col("many") <= SMALL)).union(exact_pairs(docs, mixed.where(F.col("many") > SMALL))))
    # what was found before is kept as a link to its group's root
    return roots.where("node <> root").selectExpr("node as u", "root as v").union(new)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, with the least doc_id of each group that links connect. Rows without a doc_id stay."""
    rows = written(signed(docs), "nearcopies-signed")
    grouped = rows.groupBy("sig").agg(F.min("doc_id").alias("least"), F.count("*").alias("many"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    distinct = written(grouped, "nearcopies-distinct")
    roots = components(links(docs, distinct))
    company = distinct.join(roots, F.col("sig") == F.col("node"), "left").where("many > 1 or root is not null")
    named = written(company.select("sig", "least", F.coalesce("root", "sig").alias("root")), "nearcopies-named")
    least = named.groupBy("root").agg(F.min("least").alias("_least"))
    drop = rows.select("doc_id", "sig").join(named.join(least, "root").select("sig", "_least"), "sig").where("doc_id <> _least").select(F.col("doc_id").alias("_other_id")).distinct()
    return docs.join(written(drop, "nearcopies-dropped"), F.col("doc_id") == F.col("_other_id"), "left_anti")
