"""Vector code compression: product quantisation with codebooks of whole numbers.

A component x becomes the integer floor(4096 * x); a vector is cut into PARTS
equal consecutive parts, each with a codebook of ENTRIES that starts as that
part of the first vectors by id. ROUNDS times every part goes to its nearest
entry, and each entry becomes the floor of its parts' mean.

Nearest entries are found by screening: one float32 matrix product gives
|c|^2 - 2 x.c for all entries, with an interval that holds the true value
whatever the order of the sums (conversions, products and sums are each off by
a factor of 1 + 2^-24 at most). Entries whose interval overlaps the best one's
are evaluated again in int64, and ties go to the lowest index. Where squares
could pass 63 bits the product is made in float64 and what overlaps is
evaluated in integers of any size.

A round is one pass over the vectors: tasks send a count and a sum of each
entry, as four limbs, so nothing overflows; the driver holds the codebooks and
nothing else. A sum's rows are as many as tasks times codebook numbers.

Defined results: rows whose vector is null, or holds a null or a component that
is not finite, are dropped; so are vectors whose length isn't that of the first
kept one (by id, then vector). A length that PARTS doesn't divide is filled up
with zeros. Rows without an id are encoded, and count as one last id where
codebooks start; of rows that share an id the least vector starts an entry, and
all are encoded. With fewer ids than ENTRIES codebooks are that short. Errors
beyond 64 bits are given as the largest bigint. Of labels, null ones belong
together. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import dataclasses
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import table_bytes, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components that a task works on at a time.
PIECE_VALUES = 1 << 20
#: Sums by label are sent to every task up to this size.
BROADCAST_BYTES = 16 << 20
MOST = (1 << 63) - 1
#: Bits of a limb, and limbs of a sum: 2 ** 140 is the largest component of a float vector, times the rows of a task.
LIMB, LIMBS = 40, 4


@dataclasses.dataclass
class Codebooks:
    """entries[part][entry][position]: whole numbers of any size. width: the vectors' length."""

    width: int
    entries: list[list[list[int]]]

    @property
    def depth(self) -> int:
        return -(-self.width // PARTS)

    def digest(self) -> str:
        """SHA-256 of the numbers by part, entry and position, without the zeros that fill up the last parts."""
        kept = [str(n) for p, book in enumerate(self.entries) for entry in book for i, n in enumerate(entry) if p * self.depth + i < self.width]
        return hashlib.sha256(",".join(kept).encode()).hexdigest()


def safe_limit(depth: int) -> int:
    """Components below it give sums of squared differences that fit int64, over all parts."""
    return math.isqrt((1 << 59) // max(depth, 1)) // 2


def whole_numbers(values: np.ndarray, width: int) -> np.ndarray:
    """floor(SCALE * x) as float64, which holds it exactly, cut into parts: rows x PARTS x depth."""
    depth = -(-width // PARTS)
    out = np.zeros((len(values), PARTS * depth))
    out[:, :width] = np.floor(values.astype(np.float64) * SCALE)
    return out.reshape(len(values), PARTS, depth)


def overlapping(x: np.ndarray, c: np.ndarray, kind: type = np.float32) -> np.ndarray:
    """rows x entries: whether an entry's interval for |c|^2 - 2 x.c reaches below the least upper end. x, c: float64."""
    unit = float(np.finfo(kind).eps) / 2
    terms = x.shape[1] + 4  # two conversions, a product, and the sums
    bound = terms * unit / (1 - terms * unit)
    fine = terms * 2.0**-53 * 4
    squares = (c * c).sum(1)
    sizes = np.sqrt((x * x).sum(1)) * (1 + fine), np.sqrt(squares) * (1 + fine)
    reach = np.outer(*sizes)
    value = squares - 2 * (x.astype(kind) @ c.astype(kind).T).astype(np.float64)
    error = 2 * bound * reach + fine * (squares + 2 * reach)
    return value - error <= (value + error).min(1, keepdims=True)


def nearest(x: np.ndarray, book: list[list[int]], limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each row's nearest entry; distances are int64, or objects where they could be larger. x: whole numbers as float64."""
    c = np.array([[float(n) for n in entry] for entry in book]).reshape(len(book), x.shape[1])
    small_rows = (np.abs(x) < limit).all(1)
    small_entries = (np.abs(c) < limit).all(1)
    safe = bool(small_rows.all() and small_entries.all())
    rows, cols = np.nonzero(overlapping(x, c, np.float32 if safe else np.float64))
    if safe:
        whole, codes = x.astype(np.int64), np.array(book, np.int64).reshape(c.shape)
        distance = ((whole[rows] - codes[cols]) ** 2).sum(1)
    else:
        distance = np.array([sum((int(a) - b) ** 2 for a, b in zip(x[r].tolist(), book[k], strict=True)) for r, k in zip(rows.tolist(), cols.tolist(), strict=True)] or [0], object)[: len(rows)]
    starts = np.searchsorted(rows, np.arange(len(x)))
    best = np.minimum.reduceat(distance, starts)
    index = np.where(distance == best[rows], cols, len(book))
    return np.minimum.reduceat(index, starts), best


def _vectors(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their whole numbers."""
    step = max(1, PIECE_VALUES // max(width, 1))
    for k in range(0, batch.num_rows, step):
        part = batch.slice(k, step)
        yield part, whole_numbers(part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width), width)


def _limbs(n: int) -> list[int]:
    out = []
    for _ in range(LIMBS - 1):
        out.append(n & ((1 << LIMB) - 1))
        n >>= LIMB
    return [*out, n]


def next_round(kept: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks after one assignment of all vectors."""
    limit, depth = safe_limit(books.depth), books.depth

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        counts: dict[tuple[int, int], int] = {}
        for batch in batches:
            for _, x in _vectors(batch, books.width):
                small = bool((np.abs(x) < limit).all())
                for p, book in enumerate(books.entries):
                    index, _ = nearest(x[:, p], book, limit)
                    for k in np.unique(index).tolist():
                        mine = x[index == k, p]
                        total = mine.astype(np.int64).sum(0).astype(object) if small else np.array([[int(v) for v in row] for row in mine.tolist()], object).reshape(mine.shape).sum(0)
                        sums[p, k] = sums[p, k] + total if (p, k) in sums else total
                        counts[p, k] = counts.get((p, k), 0) + len(mine)
        rows = [(p, k, i, counts[p, k], *_limbs(int(n))) for (p, k), total in sums.items() for i, n in enumerate(total)]
        if rows:
            names = ["part", "entry", "position", "n", *(f"limb{j}" for j in range(LIMBS))]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names)

    schema = ", ".join(f"{x} bigint" for x in ["part", "entry", "position", "n", *(f"limb{j}" for j in range(LIMBS))])
    # the result is no larger than the codebooks
    found = kept.select("embedding").mapInArrow(summed, schema).groupBy("part", "entry", "position").agg(*(F.sum(x).alias(x) for x in ["n", *(f"limb{j}" for j in range(LIMBS))])).collect()
    entries = [[list(entry) for entry in book] for book in books.entries]
    for r in found:
        if r["position"] < depth:
            entries[r["part"]][r["entry"]][r["position"]] = sum(r[f"limb{j}"] << (LIMB * j) for j in range(LIMBS)) // r["n"]
    return Codebooks(books.width, entries)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and embedding of the rows whose vectors are whole and finite, and of one length."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.select("vec_id", "label", "embedding").where(F.col("embedding").isNotNull() & finite)
    kept = kept.withColumn("embedding", F.col("embedding").cast("array<float>")).where(finite)
    kept = written(kept, "vectors")
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").select(F.size("embedding").alias("width")).first()
    return kept.where(F.size("embedding") == (first["width"] if first else 0))


def starting(kept: DataFrame) -> Codebooks | None:
    """Codebooks from the vectors of the first ENTRIES ids; None for an empty table."""
    ids = [r["vec_id"] for r in kept.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(ENTRIES).collect()]
    if not ids:
        return None
    named = [i for i in ids if i is not None]
    among = F.col("vec_id").isin(named) if named else F.lit(False)
    rows = kept.where(F.col("vec_id").isNull() | among if None in ids else among).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).collect()
    found = {r["vec_id"]: r["embedding"] for r in rows}
    width = len(found[ids[0]])
    x = whole_numbers(np.array([found[i] for i in ids], np.float32).reshape(len(ids), width), width)
    return Codebooks(width, [[[int(n) for n in x[k, p].tolist()] for k in range(len(ids))] for p in range(PARTS)])


def train(kept: DataFrame, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after `rounds` rounds; a round that changes nothing is the last."""
    books = starting(kept)
    for _ in range(rounds if books else 0):
        before, books = books, next_round(kept, books)
        if books.entries == before.entries:
            break
    return books


def encode(kept: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, codes (an index for each part) and error of each vector."""
    limit = safe_limit(books.depth)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _vectors(batch, books.width):
                found = [nearest(x[:, p], book, limit) for p, book in enumerate(books.entries)]
                codes = np.column_stack([index for index, _ in found]).astype(np.uint8)
                errors = sum((best.astype(object) for _, best in found), np.zeros(len(x), object)) if any(best.dtype == object for _, best in found) else sum(best for _, best in found)
                digits = [row.tobytes().hex() for row in codes]
                errors = [min(int(e), MOST) for e in errors.tolist()]
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(digits, pa.string()), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    return kept.mapInArrow(encoded, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each usable vector."""
    kept = usable(vectors)
    books = train(kept)
    if books is None:
        return kept.selectExpr("vec_id", "'' as code", "0L as error", "0L as label_error", "'' as codebooks_sha256")
    rows = written(encode(kept, books), "vector-codes")
    whole = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("bigint")
    by_label = written(rows.groupBy(F.col("label").alias("of_label")).agg(whole.alias("label_error")), "label-errors", compact=True)
    side = F.broadcast(by_label) if table_bytes(by_label) <= BROADCAST_BYTES else by_label
    joined = rows.join(side, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def oracle() -> str:
    """DuckDB SQL of compress() for vectors of one length that PARTS divides."""
    book, steps = "c0", []
    for k in range(ROUNDS + 1):
        steps.append(f"""d{k} as materialized (select r, p, k, sum((v - c) * (v - c)) as d from parts join {book} using (p, i) group by r, p, k),
a{k} as materialized (select r, p, min({{'d': d, 'k': k}}) as best from d{k} group by r, p)""")
        if k < ROUNDS:
            steps.append(f"""u{k} as materialized (select p, best.k as k, i, sum(v) as s, count(*) as n from a{k} join parts using (r, p) group by p, best.k, i),
c{k + 1} as materialized (select o.p, o.k, o.i, coalesce((s - (((s % n) + n) % n)) // n, c) as c from {book} o left join u{k} u on o.p = u.p and o.k = u.k and o.i = u.i)""")
            book = f"c{k + 1}"
    return f"""
with kept as materialized (select vec_id, label, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as q, len(embedding) // {PARTS} as depth,
 row_number() over () as r, dense_rank() over (order by vec_id) - 1 as seed from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
flat as (select r, seed, depth, unnest(q) as v, unnest(range(len(q))) as j from kept),
parts as materialized (select r, seed, cast(v as hugeint) as v, j // depth as p, j % depth as i from flat),
c0 as materialized (select p, seed as k, i, min(v) as c from parts where seed < {ENTRIES} group by p, seed, i),
{", ".join(steps)},
coded as (select r, string_agg(printf('%02x', best.k), '' order by p) as code, sum(best.d) as error from a{ROUNDS} group by r),
books as (select sha256(string_agg(cast(c as varchar), ',' order by p, k, i)) as digest from {book})
select vec_id, code, cast(error as bigint) as error, cast(sum(error) over (partition by label) as bigint) as label_error, digest as codebooks_sha256 from kept join coded using (r), books"""
