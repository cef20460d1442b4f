"""Periodic runs of words, as the maximal pairs of an LCP-interval tree.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends and that holds at least
``exponent`` periods. Its first two periods start a maximal pair: two equal stretches ``q`` words apart that differ in
the word before and in the word after. The intervals of the longest-common-prefix table are the inner nodes of the suffix
tree; closed from the bottom up, each joins the position lists of its children, and a pair from two children has exactly
the interval's common length, so nothing has to be extended or compared word by word.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import map_batches, ready

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
MULTIPLIER = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class RunParams:
    """A run has ``shortest`` words at least and ``exponent`` times its period (2 or more)."""

    shortest: int = 6
    exponent: int = 4

    @property
    def overlap(self) -> int:
        """Least common length of the pair that starts a run, whatever its period."""
        return min(max(self.shortest - q, (self.exponent - 1) * q) for q in range(1, self.shortest + 1))


def word_ids(words: list[str]) -> np.ndarray:
    """Words as whole numbers from 1, equal words alike."""
    seen: dict[str, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen) + 1) for w in words), dtype=np.int64, count=len(words))


def repeats_stretch(ids: np.ndarray, length: int) -> bool:
    """False when no stretch of ``length`` words occurs twice (equal hashes only cost a needless look)."""
    runs = len(ids) - length + 1
    if runs < 2:
        return False
    hashes = np.zeros(runs, dtype=np.uint64)
    for k in range(length):
        hashes = hashes * np.uint64(MULTIPLIER) + ids[k : k + runs].astype(np.uint64)
    hashes.sort()
    return bool((hashes[1:] == hashes[:-1]).any())


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the compared length; only suffixes still tied are sorted again."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    # a rank is the first place of its group in the order
    rank = np.searchsorted(rank[order], rank).astype(np.int64)
    step = 1
    while True:
        sorted_ranks = rank[order]
        tied = np.zeros(n, dtype=bool)
        tied[1:] = sorted_ranks[1:] == sorted_ranks[:-1]
        tied[:-1] |= tied[1:]
        places = np.flatnonzero(tied)
        if not len(places):
            return order
        loose = order[places]
        beyond = np.where(loose + step < n, rank[np.minimum(loose + step, n - 1)], -1)
        by = np.lexsort((beyond, rank[loose]))
        loose, beyond = loose[by], beyond[by]
        order[places] = loose
        heads = np.ones(len(loose), dtype=bool)
        heads[1:] = (rank[loose][1:] != rank[loose][:-1]) | (beyond[1:] != beyond[:-1])
        rank[loose] = places[np.maximum.accumulate(np.where(heads, np.arange(len(loose)), 0))]
        step *= 2


def common_prefixes(ids: np.ndarray, order: np.ndarray) -> list[int]:
    """Words that neighbours in the suffix order share, the first entry being 0 (Kasai et al., 2001)."""
    n = len(ids)
    words, places = ids.tolist(), order.tolist()
    before = [-1] * n
    for at in range(1, n):
        before[places[at]] = places[at - 1]
    shared, length = [0] * n, 0
    for i in range(n):
        j = before[i]
        if j < 0:
            length = 0
            continue
        top = n - max(i, j)
        while length < top and words[i + length] == words[j + length]:
            length += 1
        shared[i] = length
        if length:
            length -= 1
    return [shared[i] for i in places]


def _close(children: list[list[int]], common: int, left: list[int], params: RunParams, found: list[tuple[int, int, int]]) -> list[int]:
    """Join the children of an interval of ``common`` words into the largest list; note the runs their pairs start.

    A child is the list of its positions in order; ``left`` has the class of each, the word before it (0: the text starts here).

    Of two positions ``q <= common / (exponent - 1)`` apart only direct neighbours count: a third occurrence between them
    means that ``q`` is not the smallest period, as two periods that fit the common stretch have their divisor as a period.
    Pairs of one left class could be extended and are none; pairs from one child share more than ``common`` words.
    """
    places = max(children, key=len)
    child_of = {p: k for k, child in enumerate(children) if child is not places for p in child}
    for place in child_of:
        insort(places, place)
    farthest = common // (params.exponent - 1)
    for place, child in child_of.items():
        at = bisect_left(places, place)
        pairs = []
        if at + 1 < len(places) and child_of.get(places[at + 1], -1) != child:
            pairs.append((place, places[at + 1]))
        # a pair of two small children is seen from its first place
        if at and places[at - 1] not in child_of:
            pairs.append((places[at - 1], place))
        for a, b in pairs:
            period = b - a
            if period <= farthest and period + common >= params.shortest and left[a] != left[b]:
                found.append((a, period + common, period))
    return places


def find_runs(words: list[str], params: RunParams = RunParams()) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period) in words, by start, then period.

    Intervals whose common length cannot meet the length constraints for any period are not built.
    """
    ids = word_ids(words)
    least = params.overlap
    if not repeats_stretch(ids, least):
        return []
    order = suffix_order(ids)
    shared = common_prefixes(ids, order)
    left = [0, *ids[:-1].tolist()]
    places = order.tolist()
    found: list[tuple[int, int, int]] = []
    # open intervals: common length and the lists of the children seen so far
    lengths: list[int] = []
    lists: list[list[list[int]]] = []
    for at in range(1, len(places) + 1):
        common = shared[at] if at < len(places) else 0
        if common < least and not lengths:
            continue
        last = [places[at - 1]]
        while lengths and lengths[-1] > common:
            children = lists.pop()
            children.append(last)
            last = _close(children, lengths.pop(), left, params, found)
        if lengths and lengths[-1] == common:
            lists[-1].append(last)
        elif common >= least:
            lengths.append(common)
            lists.append([last])
    return sorted(found, key=lambda run: (run[0], run[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods, counted exactly; ties go to the smaller start, then the smaller period."""
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def without_copies(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words outside all runs and the first period of each run that no other run drops."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()] if runs else words


def periodic_runs(docs: DataFrame, params: RunParams = RunParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, runs, best, collapsed`` of every row.

    ``runs`` lists (start, length, period) by start, then period; ``best`` is the run with most periods (null without
    a run); ``collapsed`` is the text without the repeated periods, its words joined by one blank. Words are what lies
    between blanks and ASCII control white space. Null and empty texts have no words, no runs and collapse to the empty
    text; null keys stay null, repeated rows give repeated rows, no rows give no rows. Other columns are not read.

    Texts never meet: the table is only scanned, whatever its keys. A text is handled whole in memory that grows with its words.
    """
    ready(docs.sparkSession)
    given = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    run = "start: bigint, length: bigint, period: bigint"
    schema = f"key {given.schema['key'].dataType.simpleString()}, n_words long, runs array<struct<{run}>>, best struct<{run}>, collapsed string"

    def named(r: tuple[int, int, int]) -> dict[str, int]:
        return dict(zip(("start", "length", "period"), r))

    def convert(batch: pa.RecordBatch):
        counts, runs, best, collapsed = [], [], [], []
        for value in batch.column(1).to_pylist():
            words = WORDS.findall(value or "")
            own = find_runs(words, params)
            top = strongest(own)
            counts.append(len(words))
            runs.append([named(r) for r in own])
            best.append(top and named(top))
            collapsed.append(" ".join(without_copies(words, own)))
        return batch.column(0), counts, runs, best, collapsed

    return map_batches(given, convert, schema).withColumnRenamed("key", key)
