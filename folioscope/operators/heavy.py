"""Frequent terms of a corpus from summaries of bounded size.

A summary is a table ``(term, n)`` of at most ``capacity`` terms and one row without a term that holds its error. Two
summaries are merged by adding their counts; if more than ``capacity`` terms are left, the count of the first one too
many is taken off all of them and added to the error (Misra and Gries 1982; Agarwal et al., Mergeable Summaries, 2012).
A term with count ``n`` in a summary with error ``e`` occurs at least ``n`` and at most ``n + e`` times, one that is
not there at most ``e`` times, and ``e`` is at most (all occurrences) / (``capacity`` + 1), however the rows were
spread and in whatever order the summaries were merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators.blocks import SALTS

_ROWS = "term string, n long"


@dataclass(frozen=True)
class Summary:
    """Terms with lower bounds of their counts, the highest first; ``error`` is what every count may lack."""

    terms: list[str]
    at_least: np.ndarray
    error: int

    def candidates(self, size: int) -> list[str]:
        """All summarised terms that may be among the ``size`` most frequent ones."""
        if len(self.terms) <= size:
            return self.terms
        reach = self.at_least + self.error >= self.at_least[size - 1]
        return self.terms[: int(reach.sum())]


def _merged(parts: list[pa.Table], capacity: int) -> pa.Table:
    sums = pa.concat_tables(parts).group_by("term", use_threads=False).aggregate([("n", "sum")])
    sums = sums.select(["term", "n_sum"]).rename_columns(["term", "n"])
    unnamed = pc.is_null(sums["term"])
    kept, error = sums.filter(pc.invert(unnamed)), sums.filter(unnamed)
    if len(kept) <= capacity:
        return sums
    counts = kept["n"].to_numpy()
    first_too_many = len(counts) - capacity - 1
    cut = int(np.partition(counts, first_too_many)[first_too_many])
    left = kept.set_column(1, "n", pa.array(counts - cut)).filter(pa.array(counts > cut))
    lost = cut + (pc.sum(error["n"]).as_py() or 0)
    return pa.concat_tables([left, pa.table({"term": pa.array([None], pa.string()), "n": pa.array([lost], pa.int64())})])


def _merge(tables: Iterator[pa.Table], capacity: int) -> Iterator[pa.RecordBatch]:
    """One summary of all rows ``(term, n)`` that reach a task, which holds at most about two summaries."""
    held: list[pa.Table] = []
    waiting = 0
    for table in tables:
        held.append(table)
        waiting += len(table)
        if waiting >= capacity:
            held, waiting = [_merged(held, capacity)], 0
    if held:
        yield from _merged(held, capacity).combine_chunks().to_batches(max_chunksize=50_000)


def summarise(lists: DataFrame, capacity: int) -> Summary:
    """The summary of all entries of ``terms``, an array column of ``lists``; nulls do not count.

    One pass; every task hands on at most ``capacity + 1`` rows, which are merged in two levels, so that no task gets
    those of every other one. The driver gets one summary.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = (pc.drop_null(batch["terms"].flatten()) for batch in batches)
        yield from _merge((pa.table({"term": e, "n": pa.array(np.ones(len(e), np.int64))}) for e in entries), capacity)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _merge((pa.table({"term": b["term"], "n": b["n"]}) for b in batches), capacity)

    parts = lists.select("terms").mapInArrow(first, _ROWS).withColumn("salt", F.spark_partition_id() % SALTS)
    parts = parts.repartition("salt").drop("salt").mapInArrow(again, _ROWS)
    table = parts.repartition(1).mapInArrow(again, _ROWS).toArrow()
    unnamed = pc.is_null(table["term"])
    error = pc.sum(table.filter(unnamed)["n"]).as_py() or 0
    counted = table.filter(pc.invert(unnamed)).sort_by([("n", "descending"), ("term", "ascending")])
    return Summary(counted["term"].to_pylist(), counted["n"].to_numpy(), error)
