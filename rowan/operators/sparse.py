"""Blocks of Spark ML vectors as matrices of rows, for use inside tasks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


# A slot of a whole row costs so much less than a stored one.
_DENSE = 16


@dataclass
class SparseRows:
    """Feature vectors as a matrix of rows, only the stored slots held."""

    starts: np.ndarray
    slots: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of(cls, vectors: pa.StructArray, width: int, dtype: type = np.float32) -> SparseRows:
        """From the storage form of Spark ML's vectors, sparse or dense."""
        lists = vectors.field("values")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        slots = np.arange(starts[-1]) - np.repeat(starts[:-1], sizes)
        sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
        given = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
        slots[np.repeat(sparse, sizes)] = given
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
        return cls(starts, slots, values, width)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def __getitem__(self, rows: slice) -> SparseRows:
        at, to, _ = rows.indices(len(self))
        first, last = self.starts[at], self.starts[to]
        starts = self.starts[at : to + 1] - first
        return SparseRows(starts, self.slots[first:last], self.values[first:last], self.width)

    @classmethod
    def joined(cls, parts: Sequence[SparseRows]) -> SparseRows:
        sizes = np.concatenate([np.diff(p.starts) for p in parts])
        return cls(
            np.concatenate([[0], np.cumsum(sizes)]),
            np.concatenate([p.slots for p in parts]),
            np.concatenate([p.values for p in parts]),
            parts[0].width,
        )

    @property
    def is_dense(self) -> bool:
        """Whether whole rows are cheaper to multiply than their stored slots."""
        return self.width * len(self) <= _DENSE * len(self.slots)

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        if self.is_dense:
            return self.dense() @ w
        out = np.zeros((len(self), w.shape[1]), w.dtype)
        filled = np.diff(self.starts) > 0
        if filled.any():
            terms = w[self.slots] * self.values[:, None]
            out[filled] = np.add.reduceat(terms, self.starts[:-1][filled], axis=0)
        return out

    def dense(self) -> np.ndarray:
        out = np.zeros((len(self), self.width), self.values.dtype)
        out[np.repeat(np.arange(len(self)), np.diff(self.starts)), self.slots] = self.values
        return out

    def squared(self) -> SparseRows:
        return SparseRows(self.starts, self.slots, self.values**2, self.width)

    @property
    def T(self) -> _Transposed:  # noqa: N802  (as numpy names it)
        return _Transposed(self)


@dataclass
class _Transposed:
    rows: SparseRows

    def __matmul__(self, delta: np.ndarray) -> np.ndarray:
        x = self.rows
        if x.is_dense:
            return x.dense().T @ delta
        out = np.zeros((x.width, delta.shape[1]), delta.dtype)
        if len(x.slots):
            row = np.repeat(np.arange(len(x)), np.diff(x.starts))
            order = np.argsort(x.slots, kind="stable")
            slots = x.slots[order]
            first = np.flatnonzero(np.diff(slots, prepend=-1))
            terms = delta[row[order]] * x.values[order, None]
            out[slots[first]] = np.add.reduceat(terms, first, axis=0)
        return out
