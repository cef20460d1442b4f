"""Near-duplicate vectors: sign hashing by random hyperplanes, exact cosine verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import ready, stored
from folioscope.llm.components import connected_components

# pairs whose cosines are computed at once inside a task
PAIR_CHUNK = 100_000


@dataclass(frozen=True)
class VectorParams:
    """Hashing follows from the table: ``bits`` signs a table, one for each doubling of the vectors under one label and
    ``least_bits`` at least, so that unlike vectors share buckets about as often at every size; and as many ``tables`` as
    find a pair at the threshold with probability ``recall`` (17 of 16 bits, 27 of 22, 54 of 32 at cosine 0.98). Values given
    for either stay. ``block`` rows of a bucket meet ``block`` others in one unit of work."""

    threshold: float = 0.98
    recall: float = 0.999
    least_bits: int = 16
    tables: int | None = None
    bits: int | None = None
    block: int = 512
    seed: int = 42

    def settled(self, vectors: int) -> VectorParams:
        """The parameters for labels of at most so many different vectors."""
        bits = self.bits or min(max(self.least_bits, ceil(log2(max(vectors, 2)))), 62)
        together = (1 - acos(self.threshold) / pi) ** bits
        return replace(self, bits=bits, tables=self.tables or ceil(log(1 - self.recall) / log(1 - together)))


def planes(width: int, params: VectorParams) -> np.ndarray:
    return np.random.default_rng([params.seed, width]).standard_normal((width, params.tables * params.bits))


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row offsets of a list column without null lists."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = array.offsets.to_numpy()
    return array.values.to_numpy(zero_copy_only=False), offsets


def sign_vectors(distinct: DataFrame, params: VectorParams) -> DataFrame:
    """``id, label, n, embedding, signs, width``: a row per vector; ``signs`` holds its bucket in every table."""
    size, tables = params.bits, params.tables
    schema = "id long, label string, n long, embedding array<double>, signs array<long>, width int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            values, offsets = _matrix(batch.column(3))
            widths = np.diff(offsets)
            signs = np.zeros((batch.num_rows, tables), dtype=np.int64)
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                if width not in known:
                    known[width] = planes(width, params)
                rows = values[offsets[at][:, None] + np.arange(width)]
                on = (rows @ known[width] >= 0).reshape(len(at), tables, size)
                signs[at] = on @ (1 << np.arange(size))
            lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * tables, signs.ravel())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists, pa.array(widths, pa.int32())], names=[*batch.schema.names, "signs", "width"]
            )

    return distinct.mapInArrow(run, schema)


def work_units(signed: DataFrame, params: VectorParams) -> DataFrame:
    """Vectors of buckets with two or more, dealt to units of at most two blocks of a bucket.

    Buckets are counted and cut into units with the vectors' ids alone; only vectors that are not alone in a bucket are
    sent, and once for each unit.

    A bucket of g vectors has ceil(g / block) blocks, and every pair of blocks is a unit, so that a bucket with a third
    of all vectors is spread over many units. ``side`` says which of the unit's blocks a row comes from.
    """
    bucket = ["label", "width", "tab", "sig"]
    rows = signed.select("id", "label", "width", F.posexplode("signs").alias("tab", "sig"))
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("g")).where("g > 1")
    blocks = F.ceil(F.col("g") / params.block).cast("int")
    placed = rows.join(sizes, bucket).withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    unit = F.xxhash64(*bucket, low, high)
    dealt = spread.select(
        unit.alias("unit"), *bucket, low.alias("low"), high.alias("high"), (F.col("own") > F.col("other")).cast("int").alias("side"), "id"
    )
    return dealt.join(signed.select("id", "n", "embedding", "signs"), "id")


def _linked(frame: dict[str, np.ndarray], begin: np.ndarray, params: VectorParams) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (i, j) of the same unit within the threshold, each pair of vectors only in its first common table.

    Within a unit of two different blocks only pairs across the blocks count.
    """
    n = len(begin)
    first, second = [], []
    longest = int(np.max(frame["end"] - np.arange(n))) if n else 0
    rows = np.arange(n)
    for step in range(1, longest):
        rows = rows[rows + step < frame["end"][rows]]
        a, b = rows, rows + step
        wanted = (frame["low"][a] == frame["high"][a]) | (frame["side"][a] != frame["side"][b])
        a, b = a[wanted], b[wanted]
        for at in range(0, len(a), PAIR_CHUNK):
            i, j = a[at : at + PAIR_CHUNK], b[at : at + PAIR_CHUNK]
            equal = frame["signs"][i] == frame["signs"][j]
            new = np.argmax(equal, axis=1) == frame["tab"][i]
            i, j = i[new], j[new]
            width = frame["embedding"].shape[1]
            dot = np.einsum("ij,ij->i", frame["embedding"][i], frame["embedding"][j]) if width else np.zeros(len(i))
            close = dot / (frame["norm"][i] * frame["norm"][j]) >= params.threshold
            first.append(i[close])
            second.append(j[close])
    return (np.concatenate(first), np.concatenate(second)) if first else (np.zeros(0, int), np.zeros(0, int))


def _roots(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Least id reachable from every row over the pairs."""
    label = ids.copy()
    while len(i):
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        if np.array_equal(before, label):
            break
    return label


def verify(units: DataFrame, params: VectorParams) -> DataFrame:
    """``(id, links, root)``: partial numbers of linked vectors, and a vector of the same component, by unit.

    Rows of a unit arrive next to each other; links are counted where they are found, so a dense group gives a row per
    member and not one per pair.
    """
    unit = ["unit", "label", "width", "tab", "sig", "low", "high"]
    # bounded: a batch plus one unit, and a unit holds about two blocks
    ordered = units.repartition("unit").sortWithinPartitions(*unit)

    def solve(rows: pa.Table) -> pa.RecordBatch:
        keys = [rows.column(k).to_numpy() for k in unit]
        changed = np.zeros(rows.num_rows, dtype=bool)
        changed[0] = True
        for k in keys:
            changed[1:] |= k[1:] != k[:-1]
        begin = np.maximum.accumulate(np.where(changed, np.arange(rows.num_rows), 0))
        starts = np.flatnonzero(changed)
        end = np.append(starts[1:], rows.num_rows)[np.cumsum(changed) - 1]
        frame = {"end": end, "side": rows.column("side").to_numpy(), "low": keys[5], "high": keys[6], "tab": keys[3]}
        ids, n = rows.column("id").to_numpy(), rows.column("n").to_numpy()
        values, offsets = _matrix(rows.column("embedding"))
        signs, _ = _matrix(rows.column("signs"))
        frame["signs"] = signs.reshape(rows.num_rows, -1)
        links, roots = np.zeros(len(ids), dtype=np.int64), ids.copy()
        for width in np.unique(np.diff(offsets)).tolist():
            at = np.flatnonzero(np.diff(offsets) == width)  # whole units: the width is part of the unit
            sub = {k: v[at] for k, v in frame.items()}
            sub["end"] = np.searchsorted(at, sub["end"])
            sub["embedding"] = values[offsets[at][:, None] + np.arange(width)]
            sub["norm"] = np.sqrt(np.einsum("ij,ij->i", sub["embedding"], sub["embedding"]))
            i, j = _linked(sub, begin[at], params)
            i, j = at[i], at[j]
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            roots = np.minimum(roots, _roots(len(ids), i, j, ids))
        keep = links > 0
        return pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(links[keep]), pa.array(roots[keep])], names=["id", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held)
            last = rows.slice(rows.num_rows - 1, 1)
            same = np.ones(rows.num_rows, dtype=bool)
            for k in unit:
                same &= rows.column(k).to_numpy() == last.column(k).to_numpy()[0]
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield solve(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))

    return ordered.mapInArrow(run, "id long, links long, root long")


def vector_groups(
    vectors: DataFrame, params: VectorParams = VectorParams(), key: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Vectors are compared when their labels are equal and not null. A vector that is null, empty, zero, or holds a
    null, NaN or infinite component links with nothing, and vectors of different length never link. Equal vectors
    are collapsed with their number before hashing. Repeated rows are rows of their own: each links to the others.
    A row with a null key takes part but names no component; no rows give no rows.
    """
    spark = vectors.sparkSession
    ready(spark)
    doubles = F.col(embedding).cast("array<double>")
    given = vectors.select(F.col(key).cast("long").alias("key"), doubles.alias("embedding"), F.col(label).cast("string").alias("label"))
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("label").isNotNull() & F.forall("embedding", good) & F.exists("embedding", lambda x: x != 0)
    marked = given.withColumn("usable", F.coalesce(usable, F.lit(False)))
    digests = [F.xxhash64("label", "embedding").alias("k1"), F.xxhash64("embedding", F.lit(1), "label").alias("k2")]
    alive = marked.where("usable")
    collapsed = alive.groupBy(*digests).agg(
        F.min("key").alias("least"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    # a power of two brings the largest component near one: no norm leaves the range of doubles, no other bit changes
    largest = F.array_max(F.transform("embedding", F.abs))
    scaled = collapsed.withColumn("unit", F.pow(F.lit(2.0), F.floor(F.log2(largest)))).withColumn(
        "embedding", F.transform("embedding", lambda x: x / F.col("unit"))
    )
    distinct = stored(scaled.drop("unit").withColumn("id", F.monotonically_increasing_id()), "vectors")
    params = params.settled(distinct.groupBy("label").count().agg(F.max("count")).first()[0] or 0)
    signed = stored(sign_vectors(distinct.select("id", "label", "n", "embedding"), params), "signs")
    found = stored(verify(work_units(signed, params), params), "links")
    roots = connected_components(found, "id", "root")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = distinct.select("id", "k1", "k2", "least", "n").join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    named = named.withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), "component_id"
    )
    keyed = marked.select("key", *[F.when(F.col("usable"), d).alias(k) for d, k in zip(digests, ("k1", "k2"))])
    joined = keyed.join(named, ["k1", "k2"], "left")
    component = F.when(F.col("k1").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
