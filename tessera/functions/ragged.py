"""Small numpy helpers for arrays of variable-length rows (values plus offsets)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def take_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every range, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def list_parts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of an integer list array; null lists are empty and null items are 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten()
    values = flat.fill_null(0).to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, np.int32)
    lengths = np.asarray(col.value_lengths().fill_null(0))
    return values, lengths.astype(np.int64)


def concat_lists(parts: list[tuple[np.ndarray, np.ndarray]], drop: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise concatenation of list columns, without the items equal to ``drop``: (values, lengths)."""
    total = sum(length for _, length in parts)
    out = np.zeros(int(total.sum()), np.int64)
    at = np.cumsum(total) - total
    for values, length in parts:
        out[take_ranges(at, length)] = values
        at = at + length
    if drop is None:
        return out, total
    keep = out != drop
    row = np.repeat(np.arange(len(total)), total)
    return out[keep], np.bincount(row[keep], minlength=len(total)).astype(np.int64)


def binary_array(data: bytes, lengths: np.ndarray) -> pa.Array:
    """Binary array whose rows are consecutive pieces of ``data``."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def int_list_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32), pa.int32()))
