"""Vectors of Arrow list columns as matrices, and rows that were sorted by shard and kind."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Batches = Iterator[pa.RecordBatch]


def finite_rows(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows whose vectors have `dims` components, all finite, and these as a matrix of
    doubles. Null vectors and vectors with a null component are left out."""
    sizes = pc.fill_null(pc.list_value_length(column), -1)
    fits = np.flatnonzero(sizes.to_numpy(zero_copy_only=False) == dims)
    if not len(fits) or not dims:
        return fits[:0], np.zeros((0, dims))
    flat = column.take(pa.array(fits)).flatten().cast(pa.float64())
    matrix = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dims)
    good = np.isfinite(matrix).all(axis=1)
    return fits[good], matrix[good]


def as_binary(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    matrix = np.ascontiguousarray(matrix)
    width = matrix.dtype.itemsize * matrix.shape[1]
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(
        pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(matrix)]
    )


def from_binary(column: pa.Array, dtype: type, dims: int) -> np.ndarray:
    """The matrix that `as_binary` wrote."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, dims)


def by_shard(
    build: Callable[[pa.Table], object], search: Callable[[object, pa.RecordBatch], Batches]
) -> Callable[[Batches], Batches]:
    """For rows sorted by `shard` and `kind`: the rows of kind 0 of a shard are built into an index,
    and those of kind 1 meet it, one batch after the other, so that only the index is held."""

    def run(batches: Batches) -> Batches:
        shard, parts, index = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch["shard"].to_numpy(zero_copy_only=False)
            kind = batch["kind"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((of[1:] != of[:-1]) | (kind[1:] != kind[:-1])) + 1
            edges = [0, *cuts.tolist(), batch.num_rows]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if of[lo] != shard:
                    shard, parts, index = of[lo], [], None
                rows = batch.slice(lo, hi - lo)
                if kind[lo] == 0:
                    parts.append(rows)
                elif parts or index is not None:
                    if index is None:
                        index, parts = build(pa.Table.from_batches(parts)), []
                    yield from search(index, rows)

    return run
