"""Merging Burrows-Wheeler transforms of text shards by iterative interleave refinement.

Every shard is sorted on its own. The shards' rows are then interleaved: refinement h sorts the merged rows by their first
h symbols with one stable pass over the transforms (Holt and McMillan, 2014), and the step in which two neighbours part
gives their common prefix length (Egidi and Manzini, 2020). No suffixes of different shards are compared.

A symbol is a group of ``group`` bytes, and a row's transform symbol is the group before it, so that all suffixes are
present and a refinement moves on by ``group`` bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Shard:
    """Rows of one shard in suffix order; the short suffixes that close the texts come first.

    ``bwt`` is the number of the symbol before each suffix (-1 where less than a symbol is before it), ``back`` the row
    of the suffix that is longer by this symbol, ``text`` and ``offset`` say where the suffix starts.
    """

    bwt: np.ndarray
    back: np.ndarray
    text: np.ndarray
    offset: np.ndarray


def symbols_of(texts: list[bytes], group: int) -> np.ndarray:
    """The ``group`` bytes from each byte on as one number, over all texts one after the other."""
    data = np.frombuffer(b"".join(texts) + b"\x00" * (group - 1), dtype=np.uint8)
    n = len(data) - group + 1
    value = np.zeros(n, dtype=np.int64)
    for k in range(group):
        value = (value << 8) | data[k : k + n]
    return value


def _narrow(values: np.ndarray) -> np.ndarray:
    """Numbers that fit 16 bits are sorted by counting."""
    return values.astype(np.uint16) if values.max(initial=0) < 65_536 else values


def build_shard(texts: list[bytes], symbols: np.ndarray, group: int, depth: int) -> Shard:
    """All suffixes of the texts, sorted by at least ``depth`` bytes; ``symbols`` are numbers in byte order.

    Prefix doubling: ranks by the first 2^k symbols give ranks by the first 2^(k+1), and only suffixes that still share
    a rank are sorted again. Every text ends in one byte of padding; a suffix of less than a symbol before it closes
    its text and differs from every other; equal suffixes keep the order of their texts.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    n = int(lengths.sum())
    places = np.arange(n)
    text = np.repeat(np.arange(len(texts)), lengths)
    offset = places - (np.cumsum(lengths) - lengths)[text]
    closing = offset >= lengths[text] - group
    first = np.where(closing, np.cumsum(closing) - 1, symbols + int(closing.sum()))
    order = np.argsort(_narrow(first), kind="stable")
    # a rank is the row at which the suffixes of this rank begin
    head = np.concatenate(([True], first[order[1:]] != first[order[:-1]]))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, places, 0))
    open_ = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    width = group
    while width < depth and len(open_):
        # past its closing suffix a suffix is already told apart
        ahead = offset[open_] + width < lengths[text[open_]]
        second = np.where(ahead, rank[np.minimum(open_ + width, n - 1)] + 1, 0)
        key = rank[open_] * (n + 2) + second
        sort = np.argsort(key)
        key, open_ = key[sort], open_[sort]
        old = rank[open_]
        at = np.arange(len(open_))
        begin = np.maximum.accumulate(np.where(np.concatenate(([True], old[1:] != old[:-1])), at, 0))
        head = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1])), at, 0))
        rank[open_] = old + head - begin
        open_ = open_[np.bincount(head, minlength=len(at))[head] > 1]
        width *= 2
    order = np.argsort(_narrow(rank), kind="stable")
    row_of = np.empty(n, dtype=np.int64)
    row_of[order] = places
    has = offset[order] >= group
    before = np.where(has, order - group, order)
    return Shard(np.where(has, symbols[before], -1), row_of[before], text[order], offset[order])


def merge_shards(shards: list[Shard], steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(common, rows, interval)``: for every row (shards numbered through) how many symbols it has in common with its
    closest neighbour in the merged order, at most ``steps``; and the rows that reach ``steps``, interval by interval.

    A refinement moves every row to the row that is longer by the symbol before it: in the order of these symbols, rows
    of one interval stay together as long as the symbols agree. A row that is alone in its interval is settled, and so
    are all that would come from it, so each step touches the unsettled rows only.
    """
    first = np.concatenate(([0], np.cumsum([len(s.bwt) for s in shards])[:-1]))
    bwt = np.concatenate([s.bwt for s in shards])
    back = np.concatenate([s.back + f for s, f in zip(shards, first)]).astype(np.int32)
    bwt = _narrow(bwt + 1)  # 0: no symbol before
    common = np.zeros(len(bwt), dtype=np.int32)
    rows = np.arange(len(bwt), dtype=np.int32)
    block = np.zeros(len(bwt), dtype=np.int32)
    for step in range(1, steps + 1):
        symbol = bwt[rows]
        order = np.argsort(symbol, kind="stable")
        order = order[np.searchsorted(symbol[order], 1) :]
        symbol, block, rows = symbol[order], block[order], back[rows[order]]
        begins = np.ones(len(rows) + 1, dtype=bool)
        begins[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        kept = ~(begins[:-1] & begins[1:])
        rows, block = rows[kept], np.cumsum(begins[:-1], dtype=np.int32)[kept]
        common[rows] = step
        if not len(rows):
            break
    return common, rows, block


def repeated_places(texts: list[bytes], weights: np.ndarray, depth: int, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, offset)`` of every substring of ``depth`` bytes that starts at two places or more.

    ``weights[t]`` is how often text t occurs as a whole.
    """
    if not texts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    texts = [t + b"\x00" for t in texts]
    lengths = np.array([len(t) for t in texts])
    group = next(g for g in (4, 2, 1) if depth % g == 0)
    _, symbols = np.unique(symbols_of(texts, group), return_inverse=True)
    at = np.cumsum(lengths) - lengths
    cuts = np.flatnonzero(np.diff(at // max(shard_bytes, 1), prepend=-1)).tolist() + [len(texts)]
    bounds = list(zip(cuts[:-1], cuts[1:]))
    shards = [build_shard(texts[a:b], symbols[at[a] : at[b - 1] + lengths[b - 1]], group, depth) for a, b in bounds]
    _, rows, _ = merge_shards(shards, depth // group)
    text = np.concatenate([s.text + a for s, (a, _) in zip(shards, bounds)])[rows]
    offset = np.concatenate([s.offset for s in shards])[rows]
    # the texts that occur twice or more repeat with all their windows
    often = np.flatnonzero(weights >= 2)
    windows = np.maximum(lengths[often] - depth, 0)
    text = np.concatenate((text, np.repeat(often, windows)))
    offset = np.concatenate((offset, np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)))
    whole = np.unique(text * (int(lengths.max()) + 1) + offset)
    return whole // (int(lengths.max()) + 1), whole % (int(lengths.max()) + 1)
