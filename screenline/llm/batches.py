"""Arrow batches in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at a time; a longer text is a piece of its own.
PIECE = 4 << 20


def by_bytes(batch: pa.RecordBatch, column: int, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Successive rows of a batch, about ``size`` bytes of a string or binary
    column at a time (a null has none)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(lengths, dtype=np.int64) // size
    edges = np.append(np.flatnonzero(np.diff(piece, prepend=-1)), len(piece))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield batch.slice(a, b - a)


def texts(column: pa.Array) -> list[str]:
    """A string column as text, null as the empty text."""
    return [(raw or b"").decode("utf-8", "replace") for raw in column.cast(pa.binary()).to_pylist()]
