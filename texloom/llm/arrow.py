"""Small helpers for functions that run under mapInArrow."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute

#: Text bytes that are worked on at a time, so that memory does not follow the row count of a batch.
PIECE_BYTES = 1 << 20


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of batch with about `most` bytes of `column` each, and at least one row."""
    if not batch.num_rows:
        return
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + (n or 0) > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's values, null as the empty string."""
    return [x or "" for x in batch.column(column).to_pylist()]
