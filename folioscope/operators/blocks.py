"""Block kernels on Arrow batches, shared by similarity search and exact silhouettes.

Feature rows come in two layouts, told apart by their columns: sparse (``term_idx``, ``weight``) and dense
(``embedding``). Both carry ``id`` and ``seq``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# numbers held at once by a scoring step (32 MB of doubles)
STEP = 4_000_000
# parts in which results of tasks are merged before they meet
SALTS = 32


def is_sparse(features: DataFrame) -> bool:
    if {"term_idx", "weight"} <= set(features.columns):
        return True
    if "embedding" in features.columns:
        return False
    raise ValueError("features need either (term_idx, weight) or (embedding)")


def vector_columns(features: DataFrame) -> list[str]:
    return ["term_idx", "weight"] if is_sparse(features) else ["embedding"]


def distinct_columns(df: DataFrame) -> DataFrame:
    """The same rows under new column identities, so that a table can meet itself."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def entries(features: DataFrame) -> Column:
    """Numbers stored in one row, at least one so that empty rows count too."""
    return F.greatest(F.size(vector_columns(features)[-1]), F.lit(1))


def _flat(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column end to end, and the length of each list (null and empty lists have none)."""
    lengths = pc.fill_null(pc.list_value_length(column), 0)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False), lengths.to_numpy(
        zero_copy_only=False
    )


@dataclass
class Rows:
    """Vectors of one block. ``index`` is None for dense rows."""

    ids: np.ndarray
    seq: np.ndarray
    value: np.ndarray
    length: np.ndarray
    index: np.ndarray | None = None

    @staticmethod
    def read(table: pa.RecordBatch | pa.Table, id_col: str = "id") -> Rows:
        def column(name: str) -> pa.Array:
            c = table.column(name)
            return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c

        names = table.schema.names
        ids = column(id_col).to_numpy(zero_copy_only=False)
        seq = column("seq").to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        if "embedding" in names:
            value, length = _flat(column("embedding"), np.float64)
            width = int(length.max(initial=0))
            if (length != width).any():
                raise ValueError("embeddings of different width in one table")
            return Rows(ids, seq, value.reshape(len(ids), width), length)
        index, length = _flat(column("term_idx"), np.int64)
        value, _ = _flat(column("weight"), np.float64)
        return Rows(ids, seq, value, length, index)

    def __len__(self) -> int:
        return len(self.ids)

    def norms(self) -> np.ndarray:
        if self.index is None:
            return np.sqrt((self.value**2).sum(axis=1))
        return np.sqrt(np.bincount(np.repeat(np.arange(len(self)), self.length), self.value**2, minlength=len(self)))

    def unit(self) -> Rows:
        """Rows scaled to length one; zero rows stay zero."""
        norm = self.norms()
        safe = np.where(norm > 0, norm, 1.0)
        if self.index is None:
            value = self.value / safe[:, None]
        else:
            value = self.value / np.repeat(safe, self.length)
        return Rows(self.ids, self.seq, value, self.length, self.index)

    def part(self, start: int, stop: int) -> Rows:
        if self.index is None:
            return Rows(self.ids[start:stop], self.seq[start:stop], self.value[start:stop], self.length[start:stop])
        stop = min(stop, len(self))
        cut = slice(int(self.length[:start].sum()), int(self.length[:stop].sum()))
        return Rows(
            self.ids[start:stop], self.seq[start:stop], self.value[cut], self.length[start:stop], self.index[cut]
        )

    def steps(self, width: int):
        """Consecutive parts whose product with ``width`` columns stays within STEP numbers."""
        allowed = max(1, STEP // max(width, 1))
        cost = np.cumsum(np.maximum(self.length, 1))
        start = 0
        while start < len(self):
            spent = cost[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(cost, spent + allowed, side="right")))
            yield self.part(start, stop)
            start = stop


class Scorer:
    """Dot products of corpus rows with a fixed block of query rows."""

    def __init__(self, queries: Rows):
        self.queries = queries
        self.halves: list[Rows] = []
        if queries.index is None:
            self.matrix = queries.value.T
        else:
            # only terms that occur in a query get a row of the query matrix
            self.known, compact = np.unique(queries.index, return_inverse=True)
            if len(self.known) * len(queries) > STEP and len(queries) > 1:
                # too many cells: halves share fewer terms, and their matrices live one at a time
                half = len(queries) // 2
                self.halves = [queries.part(0, half), queries.part(half, len(queries))]
                return
            self.matrix = np.zeros((len(self.known), len(queries)))
            self.matrix[compact, np.repeat(np.arange(len(queries)), queries.length)] = queries.value

    def __call__(self, rows: Rows) -> np.ndarray:
        """Scores with one line per row and one column per query."""
        if rows.index is None:
            return rows.value @ self.matrix
        if self.halves:
            return np.concatenate([Scorer(half)(rows) for half in self.halves], axis=1)
        out = np.zeros((len(rows), len(self.queries)))
        if not len(self.known):
            return out
        place = np.minimum(np.searchsorted(self.known, rows.index), len(self.known) - 1)
        shared = self.known[place] == rows.index
        owner = np.repeat(np.arange(len(rows)), rows.length)[shared]
        if len(owner):
            weighted = self.matrix[place[shared]] * rows.value[shared][:, None]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            out[owner[first]] = np.add.reduceat(weighted, first, axis=0)
        return out
