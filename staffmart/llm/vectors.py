"""Vectors as exact integers, floor(scale * x), kept as doubles: a double holds every one of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LAST = 2**63 - 1


def as_long(x: int) -> int:
    """``x`` held at a long's ends."""
    return max(-LAST, min(LAST, x))


def scaled(lists: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers and lengths of the vectors that take part, and their integer components one
    after the other. Vectors that are null, empty, or hold a null or non-finite component (also
    after scaling) take no part."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    with np.errstate(all="ignore"):
        x = np.floor(values.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64) * scale) + 0.0
    owner = np.repeat(np.arange(len(lengths)), lengths)
    ok = (lengths > 0) & (np.bincount(owner, weights=~np.isfinite(x), minlength=len(lengths)) == 0)
    return np.flatnonzero(ok), lengths[ok], x[ok[owner]]


def to_binary(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths * 8))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(flat.astype("<f8").tobytes())])


def matrix(parts: list[bytes]) -> np.ndarray:
    """Vectors of one length, a row each."""
    return np.frombuffer(b"".join(parts), "<f8").reshape(len(parts), -1)


def integers(vector: np.ndarray) -> np.ndarray:
    """Python integers of integer-valued doubles."""
    return np.array([int(x) for x in vector.ravel()] + [None], object)[:-1].reshape(vector.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``: doubles where every sum is exact in
    them, else Python integers held at a long's ends."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return a @ b.T
    exact = integers(a) @ integers(b).T
    return np.array([as_long(x) for x in exact.ravel()] + [None], object)[:-1].reshape(exact.shape)


def by_size(vectors: np.ndarray) -> list[np.ndarray]:
    """Row numbers of vectors whose products with each other stay exact in doubles, and of the
    others: a few very large vectors then leave the rest on the fast path."""
    small = np.abs(vectors).max(axis=1) < (2.0**53 / vectors.shape[1]) ** 0.5 if len(vectors) else np.zeros(0, bool)
    return [x for x in (np.flatnonzero(small), np.flatnonzero(~small)) if len(x)]
