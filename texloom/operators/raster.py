"""Boxes of what differs between two renderings of a page: connected components of changed pixels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Difference of a pixel's value, from 0 to 1, that counts as a change.
THRESHOLD = 0.3
SCHEMA = "doc_id bigint, page_index bigint, box bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint, error string"


def component_boxes(changed: np.ndarray) -> np.ndarray:
    """(n, 4) boxes x0, y0, x1, y1 (ends exclusive) of the 8-connected components of a mask, by first pixel in row order.

    Runs of a row are joined with the runs that they touch in the row before, so the work follows the number of runs.
    """
    padded = np.pad(changed.astype(np.int8), ((0, 0), (1, 1)))
    edges = np.diff(padded, axis=1)
    rows, starts = np.nonzero(edges == 1)
    _, stops = np.nonzero(edges == -1)
    n = len(rows)
    parent = np.arange(n)

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    first = np.searchsorted(rows, np.arange(changed.shape[0] + 1))
    for y in range(1, changed.shape[0]):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if starts[i] <= stops[j] and starts[j] <= stops[i]:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
            if stops[i] < stops[j]:
                i += 1
            else:
                j += 1
    roots = np.array([root(k) for k in range(n)], np.int64)
    kept, owner = np.unique(roots, return_inverse=True)
    boxes = np.zeros((len(kept), 4), np.int64)
    for k, (values, f) in enumerate(((starts, np.minimum), (rows, np.minimum), (stops, np.maximum), (rows + 1, np.maximum))):
        boxes[:, k] = np.iinfo(np.int64).max if f is np.minimum else 0
        f.at(boxes[:, k], owner, values)
    return boxes


def changed_boxes(pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, page_index, box number and box of each changed region, and error; equal pages have no rows.

    pairs: doc_id, page_index, height, width, channels, drawn, blank (uint8 pixels, row by row). A pair that lacks a side, or whose
    sides do not have the size that it states, is one row with its error and no box.
    """

    def fault(r: dict) -> str | None:
        if r["drawn"] is None or r["blank"] is None:
            return "a rendering is missing"
        if None in (r["height"], r["width"], r["channels"]):
            return "no size"
        want = r["height"] * r["width"] * r["channels"]
        return None if len(r["drawn"]) == len(r["blank"]) == want else f"sizes differ: {len(r['drawn'])}, {len(r['blank'])}, not {want}"

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k in range(batch.num_rows):  # a page pair at a time
                r = batch.slice(k, 1).to_pylist()[0]
                if error := fault(r):
                    out.append((r["doc_id"], r["page_index"], *[None] * 5, error))
                elif r["drawn"] != r["blank"]:
                    a, b = (np.frombuffer(r[c], np.uint8).reshape(r["height"], r["width"], r["channels"]).astype(np.int16) for c in ("drawn", "blank"))
                    changed = (np.abs(a - b) > threshold * 255).any(axis=2)
                    out += [(r["doc_id"], r["page_index"], k, *map(int, box), None) for k, box in enumerate(component_boxes(changed))]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string() if n == "error" else pa.int64()) for n, c in zip(names, zip(*out, strict=True) if out else [[]] * 8, strict=True)], names)

    return pairs.select("doc_id", "page_index", "height", "width", "channels", "drawn", "blank").mapInArrow(boxes, SCHEMA)
