"""Removal of repeated byte strings by merged Burrows-Wheeler transforms.

A string of ``length`` bytes is a window. Every window has one anchor, the least (by hash) of its substrings of
``anchor`` bytes, so equal windows have equal anchors at equal places: windows can be compared anchor by anchor, and
anchors spread the corpus over tasks. Consecutive windows with the same anchor form a run, whose text is the union of its
windows.

1. Anchors that occur once in the corpus cannot lie in a repeated window; most of the corpus ends here.
2. Where all runs of an anchor have the same text, this text is an interval of its own, and all its windows repeat.
3. The different texts of the other anchors, each with its number of occurrences, are sorted in shards, the shards'
   transforms are merged, and intervals with a common prefix of ``length`` bytes give the repeated windows.
4. Anchors with very many different texts are compared window by window, spread by the windows' digests.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.bwt import repeated_places
from folioscope.llm.common import map_batches, ready, stored, told_apart_by_place

MULTIPLIER = np.uint64(0xD1342543DE82EF95)  # odd, so that it has an inverse modulo 2**64
# bits of a window's rank that hold the place, to take the leftmost of equal anchors
PLACE_BITS = 26
WRAP = (1 << 64) - 1


@dataclass(frozen=True)
class RepeatParams:
    """``bucket_bytes`` of texts are merged in one unit of work, from shards of ``shard_bytes``, and a task has about
    ``task_buckets`` of them; an anchor with more than ``merged_texts`` different texts is compared by window digests.
    Anchors of a longer text are looked for in parts of ``part_bytes`` windows, which bounds memory."""

    length: int = 200
    anchor: int = 100
    shard_bytes: int = 60_000
    bucket_bytes: int = 400_000
    task_buckets: int = 4
    merged_texts: int = 1_000
    part_bytes: int = 1 << 22


class _Hashes:
    """Polynomial hashes of all substrings of one length, from running sums modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)
        values = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
        self.values = values * np.uint64(2) + np.uint64(1)

    def of(self, data: np.ndarray, length: int) -> np.ndarray:
        n = len(data)
        if len(self.up) <= n:
            inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
            for name, step in (("up", MULTIPLIER), ("down", inverse)):
                powers = np.full(n + 1, step, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.down[:n], out=sums[1:])
        hashes = (sums[length:] - sums[:-length]) * self.up[: n - length + 1]
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0x9FB21C651E98DF25)
        hashes ^= hashes >> np.uint64(29)
        return hashes


_HASHES = _Hashes()


def anchor_runs(texts: list[bytes], length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """``(text number, first window, windows, anchor hash)`` of all runs, in order."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return empty, empty, empty, empty
    hashes = _HASHES.of(data, anchor)
    least = (hashes & np.uint64(WRAP ^ ((1 << PLACE_BITS) - 1))) | np.arange(len(hashes), dtype=np.uint64)
    wanted, width = length - anchor + 1, 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[: -(wanted - width)], least[wanted - width :])
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
    start = np.flatnonzero(np.arange(len(least)) + length <= ends[owner])  # windows within one text
    if not len(start):
        return empty, empty, empty, empty
    place = (least[start] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    change = np.concatenate(([0], np.flatnonzero((place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)) + 1))
    first = start[change]
    count = np.diff(np.append(change, len(start)))
    which = owner[first]
    return which, first - (ends - sizes)[which], count, hashes[place[change]].view(np.int64)



def pieces(texts: list[bytes], most: int) -> Iterator[list[int]]:
    """Numbers of texts to be looked at together, about ``most`` bytes at a time."""
    group, total = [], 0
    for i, t in enumerate(texts):
        if group and total + len(t) > most:
            yield group
            group, total = [], 0
        group.append(i)
        total += len(t)
    if group:
        yield group


def corpus_runs(texts: DataFrame, params: RepeatParams) -> DataFrame:
    """``row, first, windows, anchor, digest`` of all runs of ``texts`` (``row, body``)."""
    length, anchor, step = params.length, params.anchor, params.part_bytes

    def convert(batch: pa.RecordBatch):
        # every window lies in the part in which it starts
        bodies, rows, begin = [], [], []
        for row, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for at in range(0, max(len(body or b"") - length + 1, 1), step):
                bodies.append((body or b"")[at : at + step + length - 1])
                rows.append(row)
                begin.append(at)
        rows, begin = np.array(rows), np.array(begin)
        parts = []
        for group in pieces(bodies, 1 << 20):
            own = [bodies[i] for i in group]
            which, first, count, key = anchor_runs(own, length, anchor)
            spans = zip(which.tolist(), first.tolist(), (first + count + length - 1).tolist())
            digest = np.array([xxhash.xxh3_64_intdigest(own[w][a:b]) for w, a, b in spans], dtype=np.uint64).view(np.int64)
            number = np.array(group)[which]
            parts.append((rows[number], begin[number] + first, count, key, digest))
        yield from (np.concatenate(c) for c in zip(*parts))

    return map_batches(texts, convert, "row long, first int, windows int, anchor long, digest long")


def run_texts(asked: DataFrame, params: RepeatParams) -> DataFrame:
    """``anchor, digest, n, piece`` from rows of ``body`` with the list ``runs`` of the runs whose text is wanted."""
    length = params.length

    def convert(batch: pa.RecordBatch):
        anchors, digests, counts, found = [], [], [], []
        for body, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for r in runs:
                anchors.append(r["anchor"])
                digests.append(r["digest"])
                counts.append(r["n"])
                found.append(body[r["first"] : r["first"] + r["windows"] + length - 1])
        yield from (anchors, digests, counts, found)

    return map_batches(asked, convert, "anchor long, digest long, n long, piece binary")


def merged_windows(texts: DataFrame, params: RepeatParams) -> DataFrame:
    """``anchor, digest, at, windows``: stretches of repeated windows of the texts, found in merged transforms.

    All texts of an anchor are in one bucket, which holds about ``bucket_bytes``.
    """
    length, shard_bytes = params.length, params.shard_bytes

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["anchor", "digest"], ignore_index=True)
        text, offset = repeated_places(frame["piece"].tolist(), frame["n"].to_numpy(dtype=np.int64), length, shard_bytes)
        order = np.lexsort((offset, text))
        text, offset = text[order], offset[order]
        begin = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (offset[1:] != offset[:-1] + 1)))) if len(text) else text
        count = np.diff(np.append(begin, len(text)))
        rows = text[begin]
        return pd.DataFrame({
            "anchor": frame["anchor"].to_numpy()[rows], "digest": frame["digest"].to_numpy()[rows],
            "at": offset[begin].astype(np.int32), "windows": count.astype(np.int32),
        })

    total = texts.agg(F.sum(F.octet_length("piece")).alias("n")).first()["n"] or 0
    buckets = total // params.bucket_bytes + 1
    dealt = texts.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    dealt = dealt.repartition(buckets // params.task_buckets + 1, "bucket")
    return dealt.groupBy("bucket").applyInPandas(solve, "anchor long, digest long, at int, windows int")


def counted_windows(texts: DataFrame, params: RepeatParams) -> DataFrame:
    """The same as ``merged_windows`` for anchors with very many texts, by 128-bit digests of single windows."""
    length = params.length

    def convert(batch: pa.RecordBatch):
        anchor, digest, n, at, high, low = [], [], [], [], [], []
        for a, d, c, p in zip(*(col.to_pylist() for col in batch.columns)):
            for i in range(len(p) - length + 1):
                value = xxhash.xxh3_128_digest(p[i : i + length])
                for column, x in zip((anchor, digest, n, at), (a, d, c, i)):
                    column.append(x)
                high.append(int.from_bytes(value[:8], "big", signed=True))
                low.append(int.from_bytes(value[8:], "big", signed=True))
        yield from (anchor, digest, n, at, high, low)

    windows = map_batches(texts, convert, "anchor long, digest long, n long, at int, high long, low long")
    often = windows.groupBy("high", "low").agg(F.sum("n").alias("total")).where("total >= 2")
    return windows.join(often, ["high", "low"]).select("anchor", "digest", "at", F.lit(1).alias("windows"))


def repeated_runs(texts: DataFrame, params: RepeatParams) -> DataFrame:
    """``row, first, windows``: stretches of repeated windows of ``texts`` (``row, body``)."""
    runs = corpus_runs(texts, params)
    anchors = runs.groupBy("anchor").agg(F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"))
    # stored, so that the join below deals both sides anew and Spark can split an anchor with very many runs
    often = stored(anchors.where("n >= 2").select("anchor", (F.col("low") != F.col("high")).alias("mixed")), "anchors")
    met = stored(runs.join(often, "anchor"), "repeat-runs")

    mixed = met.where("mixed")
    place = F.struct("row", "first", "windows")
    pieces_ = mixed.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    sizes = pieces_.groupBy("anchor").agg(F.count("*").alias("texts"))
    asked = pieces_.select("place.*", "anchor", "digest", "n").groupBy("row").agg(
        F.collect_list(F.struct("first", "windows", "anchor", "digest", "n")).alias("runs")  # runs of one document
    )
    fetched = run_texts(texts.join(asked, "row").select("body", "runs"), params)
    fetched = stored(fetched.join(sizes, "anchor"), "repeat-texts")
    names = ["anchor", "digest", "n", "piece"]
    few = merged_windows(fetched.where(F.col("texts") <= params.merged_texts).select(*names), params)
    many = counted_windows(fetched.where(F.col("texts") > params.merged_texts).select(*names), params)
    hits = few.unionByName(many).select("anchor", "digest", F.struct("at", "windows").alias("hit"))
    partial = mixed.select("row", "first", "anchor", "digest").join(hits, ["anchor", "digest"])
    partial = partial.select("row", (F.col("first") + F.col("hit.at")).alias("first"), "hit.windows")
    return met.where("not mixed").select("row", "first", "windows").unionByName(partial)


def cut_out(body: bytes, stretches: list[dict], length: int) -> tuple[int, int, bytes]:
    """``(bytes removed, maximal runs removed, what is left)`` of a text with repeated windows."""
    spans = sorted((s["first"], s["first"] + s["windows"] + length - 1) for s in stretches)
    merged: list[list[int]] = []
    for a, b in spans:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    left, at = [], 0
    for a, b in merged:
        left.append(body[at:a])
        at = b
    left.append(body[at:])
    return sum(b - a for a, b in merged), len(merged), b"".join(left)


def remove_repeats(docs: DataFrame, params: RepeatParams = RepeatParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, kept (binary), n_bytes, n_removed, n_spans`` of every row.

    A byte is removed when it lies in a string of ``length`` bytes that starts at another place too, in the same row or in
    another; strings are judged on the input and never cross rows. Null counts as empty, shorter texts lose nothing,
    repeated rows lose what they share, null keys stay null, no rows give no rows. What is left may end within a
    character and is therefore binary. Rows are told apart by their place in the scan, so ``docs`` has to be a stored
    table; one that a shuffle deals out is refused.
    """
    ready(docs.sparkSession)
    length = params.length
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = told_apart_by_place(docs).select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), body.alias("body"))
    hits = stored(repeated_runs(rows.select("row", "body"), params), "repeat-hits")
    listed = hits.groupBy("row").agg(F.collect_list(F.struct("first", "windows")).alias("stretches"))  # of one document
    joined = rows.join(listed, "row", "left").select("key", "body", "stretches")
    kind = joined.schema["key"].dataType.simpleString()

    def convert(batch: pa.RecordBatch):
        bodies = batch.column(1).to_pylist()
        cut = [cut_out(b, s, length) if s else (0, 0, b) for b, s in zip(bodies, batch.column(2).to_pylist())]
        yield batch.column(0)
        yield [c[2] for c in cut]
        yield [len(b) for b in bodies]
        yield [c[0] for c in cut]
        yield [c[1] for c in cut]

    return map_batches(joined, convert, f"`{key}` {kind}, kept binary, n_bytes long, n_removed long, n_spans long")
