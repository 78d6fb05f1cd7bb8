import hashlib
import math
import random

import numpy as np
import pytest

from texloom.llm import veccodes

SCHEMA = "vec_id bigint, label int, embedding array<float>, code string, error bigint"


def brute(rows):
    """rows: (vec_id, label, vector). Returns sorted (vec_id, code, error, label_error, digest), in whole numbers only."""
    kept = [(i, l, [math.floor(4096 * x) for x in np.array(v, np.float32).astype(float).tolist()]) for i, l, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    last = lambda i: (i is None, i or 0)
    kept.sort(key=lambda r: (last(r[0]), r[2]))
    width = len(kept[0][2])
    kept = [r for r in kept if len(r[2]) == width]
    depth = -(-width // 8)
    cut = lambda q, p: [*q, *[0] * (8 * depth - width)][p * depth : (p + 1) * depth]
    first = {}
    for i, _, q in kept:
        first.setdefault(i, q)
    seeds = [first[i] for i in sorted(first, key=last)[:16]]
    books = [[cut(q, p) for q in seeds] for p in range(8)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest(q, p):
        return min((far(cut(q, p), c), k) for k, c in enumerate(books[p]))

    for _ in range(6):
        new = []
        for p in range(8):
            groups = {}
            for _, _, q in kept:
                groups.setdefault(nearest(q, p)[1], []).append(cut(q, p))
            new.append([[sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else c for k, c in enumerate(books[p])])
        books = new
    digest = hashlib.sha256(",".join(str(n) for p, book in enumerate(books) for c in book for j, n in enumerate(c) if p * depth + j < width).encode()).hexdigest()
    out, by = [], {}
    for i, l, q in kept:
        found = [nearest(q, p) for p in range(8)]
        error = min(sum(d for d, _ in found), (1 << 63) - 1)
        by[l] = by.get(l, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, l))
    return sorted(((i, c, e, min(by[l], (1 << 63) - 1), digest) for i, c, e, l in out), key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(i, l, v, "clash", 5) for i, l, v in rows], SCHEMA)
    return sorted((tuple(r) for r in veccodes.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_equals_brute_force_with_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, i % 3 or None, [rng.gauss(0, 0.1) for _ in range(16)]) for i in range(60)]
    rows += [(7, 1, rows[7][2]), (7, 1, rows[8][2]), (None, 1, rows[9][2]), (None, None, rows[10][2])]  # repeated ids, none at all
    rows += [(100, 1, None), (101, 1, [None] * 16), (102, 1, [float("nan")] * 16), (103, 1, [float("inf")] + [0.0] * 15), (104, 1, [0.0] * 4), (105, 1, [])]
    rows += [(106 + k, 2, [0.0] * 16) for k in range(30)]  # equal vectors, equal distances
    assert run(spark, rows) == brute(rows)


def test_widths_that_parts_do_not_divide_and_few_rows(spark):
    rng = random.Random(6)
    rows = [(i, 0, [rng.uniform(-1, 1) for _ in range(11)]) for i in range(9)]
    assert run(spark, rows) == brute(rows)


def test_components_beyond_int64(spark):
    rng = random.Random(7)
    rows = [(i, i % 2, [rng.choice([1e-3, 3.0, 1e20, -2e30, 3e38]) * rng.random() for _ in range(8)]) for i in range(40)]
    assert run(spark, rows) == brute(rows)


def test_empty_tables(spark):
    assert run(spark, []) == [] and run(spark, [(1, 1, None)]) == []
    assert run(spark, [(1, None, []), (2, None, [])]) == brute([(1, None, []), (2, None, [])])


@pytest.mark.parametrize("size", [3, 1000, 1 << 26])
def test_intervals_hold_the_nearest(size):
    """No entry that is nearest lies outside the overlapping ones, for numbers that float32 can't hold."""
    rng = np.random.default_rng(size)
    x, c = rng.integers(-size, size + 1, (4000, 8)), rng.integers(-size, size + 1, (16, 8))
    x[::3] = c[rng.integers(0, 16, len(x[::3]))] + rng.integers(-1, 2, x[::3].shape)
    book = c.tolist()
    index, best = veccodes.nearest(x.astype(float), book, veccodes.safe_limit(8))
    want = ((x[:, None, :] - c[None]) ** 2).sum(2)
    assert (index == want.argmin(1)).all() and (best == want.min(1)).all()
    near = veccodes.overlapping(x.astype(float), c.astype(float))
    assert near[np.arange(len(x)), want.argmin(1)].all() and near.mean() < 0.5
