"""SimHash near-duplicates by generalised pigeonhole search.

The 64 bits are divided into partitions of correlated bits. A query's distance bound is shared out over the
partitions so that the bounds sum to ``max_bits - parts + 1`` (-1 skips a partition); a dynamic programme takes the
shares of least expected work, from counts over all fingerprints. Fingerprints within the bound of a partition are
probed there and every candidate is verified on the whole fingerprint.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import free_name, map_batches, ready, stored, told_apart_by_place
from folioscope.llm.components import connected_components

BITS = 64
SLOT_BITS = 16


@dataclass(frozen=True)
class SimhashParams:
    shingle: int = 3
    seed: int = 42
    max_bits: int = 2
    parts: int = 2


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the shingles' XXH64 as an unsigned number; 0 for a null text or one without words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z fold, only ASCII blanks separate
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle, len(words)) - 1
    pairs = zip(starts[: len(words) - span].tolist(), ends[span:].tolist())
    hashes = np.array([xxhash.xxh64_intdigest(joined[i:j], seed) for i, j in pairs], dtype=np.uint64)
    counts = np.zeros(BITS, dtype=np.int64)
    for part in np.array_split(hashes, len(hashes) // 65_536 + 1):
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keys: list[str], text: str, params: SimhashParams) -> DataFrame:
    """``keys`` and ``fp`` (the fingerprint as a signed long) of every row."""
    shingle, seed = params.shingle, params.seed
    given = docs.select(*keys, F.col(text).cast("string").alias("_text"))
    kinds = {f.name: f.dataType.simpleString() for f in given.schema}

    def convert(batch: pa.RecordBatch):
        values = [fingerprint(t, shingle, seed) for t in batch.column(len(keys)).to_pylist()]
        yield from (batch.column(i) for i in range(len(keys)))
        yield np.array(values, dtype=np.uint64).view(np.int64)

    return map_batches(given, convert, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", fp long")


def _unsigned(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def _unpack(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Partitions of equal size, each grown from the most correlated free pair by the most correlated next bit.

    ``together[i, j]`` counts the fingerprints with both bits set.
    """
    p = together / max(n, 1)
    mean = np.diag(p)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    tie = np.abs((p - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(tie, -1)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        wanted = (BITS - sum(map(len, groups))) // (parts - k)
        sub = tie[np.ix_(free, free)]
        group = [free[np.unravel_index(np.argmax(sub), sub.shape)[0]]] if len(free) > 1 else list(free)
        while len(group) < wanted:
            rest = [b for b in free if b not in group]
            group.append(max(rest, key=lambda b: (tie[b, group].sum(), -b)))
        free = [b for b in free if b not in group]
        groups.append(sorted(group))
    return groups


@dataclass
class Layout:
    """Partitions of the bits, and the counts the expected work is read from."""

    groups: list[list[int]]
    max_bits: int
    n: int = 0
    # slot -> counts by value, over all fingerprints
    counts: dict[int, np.ndarray] | None = None

    @cached_property
    def slots(self) -> list[tuple[int, list[int]]]:
        """(partition, bits) of the pieces of at most SLOT_BITS bits that are counted."""
        return [(k, g[i : i + SLOT_BITS]) for k, g in enumerate(self.groups) for i in range(0, len(g), SLOT_BITS)]

    @staticmethod
    def take(values: np.ndarray, bits: list[int]) -> np.ndarray:
        out = np.zeros(len(values), dtype=np.uint64)
        for place, bit in enumerate(bits):
            out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
        return out

    @cached_property
    def balls(self) -> list[list[np.ndarray]]:
        """For each slot, the share of fingerprints at distance exactly 0, 1, ... of each value."""
        found = []
        for s, (_, bits) in enumerate(self.slots):
            counts = self.counts[s] / max(self.n, 1)
            values = np.arange(1 << len(bits))
            shares = [
                sum((counts[values ^ sum(1 << b for b in c)] for c in combinations(range(len(bits)), d)), 0 * counts)
                for d in range(self.max_bits + 1)
            ]
            found.append(shares)
        return found

    def expected(self, values: np.ndarray) -> np.ndarray:
        """(rows, partitions, max_bits + 2): expected probes plus candidates for the bounds -1, 0, ..., max_bits."""
        out = np.zeros((len(values), len(self.groups), self.max_bits + 2))
        for k, group in enumerate(self.groups):
            exact = None
            for s, (owner, bits) in enumerate(self.slots):
                if owner == k:
                    at = [share[self.take(values, bits).astype(np.int64)] for share in self.balls[s]]
                    exact = at if exact is None else [
                        sum(exact[i] * at[d - i] for i in range(d + 1)) for d in range(self.max_bits + 1)
                    ]
            probes = np.cumsum([len(list(combinations(group, d))) for d in range(self.max_bits + 1)])
            out[:, k, 1:] = probes + self.n * np.cumsum(np.array(exact).T, axis=1)
        return out

    def shares(self, values: np.ndarray) -> np.ndarray:
        """(rows, partitions): the bounds of least expected work that sum to max_bits - parts + 1."""
        work = self.expected(values)
        parts, top = len(self.groups), self.max_bits + 1
        total = self.max_bits + 1  # every bound counts from -1, so the shifted bounds sum to max_bits + 1
        best = np.full((len(values), total + 1), np.inf)
        best[:, 0] = 0
        chosen = []
        for k in range(parts):
            options = np.stack(
                [
                    np.concatenate([np.full((len(values), e), np.inf), best[:, : total + 1 - e]], axis=1) + work[:, k, e, None]
                    for e in range(top + 1)
                ]
            )
            chosen.append(np.argmin(options, axis=0))
            best = np.min(options, axis=0)
        left = np.full(len(values), total)
        out = np.zeros((len(values), parts), dtype=np.int64)
        rows = np.arange(len(values))
        for k in reversed(range(parts)):
            out[:, k] = chosen[k][rows, left] - 1
            left -= out[:, k] + 1
        return out


def learn_layout(distinct: DataFrame, params: SimhashParams) -> Layout:
    """Bit groups and slot counts over all distinct fingerprints; what reaches the driver has a fixed size."""

    def together(batches):
        total = np.zeros((BITS, BITS))
        n = 0
        for batch in batches:
            bits = _unpack(_unsigned(batch)).astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        yield pa.RecordBatch.from_pydict({"place": np.arange(BITS * BITS + 1), "n": np.append(total.ravel(), n).astype(np.int64)})

    def added(df: DataFrame, by: list[str]):
        return df.groupBy(*by).agg(F.sum("n").alias("n")).toPandas()

    sums = np.zeros(BITS * BITS + 1)
    rows = added(distinct.mapInArrow(together, "place long, n long"), ["place"])
    sums[rows["place"].to_numpy(dtype=np.int64)] = rows["n"]
    layout = Layout(group_bits(sums[:-1].reshape(BITS, BITS), int(sums[-1]), params.parts), params.max_bits, int(sums[-1]))
    slots = layout.slots

    def histogram(batches):
        counts = [np.zeros(1 << len(bits), dtype=np.int64) for _, bits in slots]
        for batch in batches:
            values = _unsigned(batch)
            for s, (_, bits) in enumerate(slots):
                counts[s] += np.bincount(Layout.take(values, bits).astype(np.int64), minlength=len(counts[s]))
        for s, c in enumerate(counts):
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_pydict({"slot": np.full(len(at), s), "value": at, "n": c[at]})

    layout.counts = {s: np.zeros(1 << len(bits), dtype=np.int64) for s, (_, bits) in enumerate(slots)}
    rows = added(distinct.mapInArrow(histogram, "slot long, value long, n long"), ["slot", "value"])
    for s, mine in rows.groupby("slot"):
        layout.counts[s][mine["value"].to_numpy(dtype=np.int64)] = mine["n"]
    return layout


def near_pairs(distinct: DataFrame, params: SimhashParams) -> DataFrame:
    """``(a, b)``, a < b: all pairs of different fingerprints within ``max_bits`` bits, each once."""
    layout = learn_layout(distinct, params)
    layout.balls  # computed once, on the driver
    shared = distinct.sparkSession.sparkContext.broadcast(layout)

    def index(batch: pa.RecordBatch):
        values = _unsigned(batch)
        groups = shared.value.groups
        yield np.repeat(np.arange(len(groups)), len(values))
        yield np.concatenate([Layout.take(values, g) for g in groups]).view(np.int64)
        yield np.tile(values, len(groups)).view(np.int64)

    def probe(batch: pa.RecordBatch):
        values, plan = _unsigned(batch), shared.value
        bounds = plan.shares(values)
        part, key, fp = [], [], []
        for k, group in enumerate(plan.groups):
            own = Layout.take(values, group)
            for d in range(plan.max_bits + 1):
                rows = bounds[:, k] >= d
                if rows.any():
                    flips = [sum(1 << b for b in c) for c in combinations(range(len(group)), d)]
                    flips = np.array(flips, dtype=np.uint64)
                    key.append((own[rows, None] ^ flips[None, :]).ravel())
                    fp.append(np.repeat(values[rows], len(flips)))
                    part.append(np.full(len(fp[-1]), k))
        yield np.concatenate(part)
        yield np.concatenate(key).view(np.int64)
        yield np.concatenate(fp).view(np.int64)

    schema = "part int, key long, fp long"
    held = map_batches(distinct, index, schema)
    asked = map_batches(distinct, probe, schema.replace("fp", "probe"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("probe"))) <= params.max_bits
    met = asked.join(held, ["part", "key"]).where(close & (F.col("fp") != F.col("probe")))
    return met.select(F.least("fp", "probe").alias("a"), F.greatest("fp", "probe").alias("b")).distinct()


def link_fingerprints(marked: DataFrame, params: SimhashParams) -> DataFrame:
    """``(fp, root)``: every distinct fingerprint and the least (signed) fingerprint reachable over links."""
    distinct = stored(marked.select("fp").distinct(), "fps")
    roots = connected_components(near_pairs(distinct, params), "a", "b")
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, params: SimhashParams = SimhashParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` (least key reachable) of every row.

    Copies share a fingerprint and are linked through it, so only different fingerprints are compared. A null or
    wordless text has fingerprint zero and is linked like any other; rows with a null key take part, the least key
    ignores them (null if a group has no other). Repeated rows give repeated rows; no rows give no rows.
    """
    ready(docs.sparkSession)
    marked = stored(fingerprints(docs, [key], text, params), "fingerprints")
    roots = link_fingerprints(marked, params)
    least = marked.groupBy("fp").agg(F.min(key).alias("least"))
    rooted = least.join(roots, "fp")
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(groups, "root").select("fp", "component_id"), "components")
    return marked.join(named, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, params: SimhashParams = SimhashParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row left of every group: the one with the least key (nulls last), then the first read.

    All columns are kept as they are, whatever their names. The rows are told apart by their place in the scan, so
    ``docs`` has to be a stored table; one that a shuffle deals out is refused.
    """
    ready(docs.sparkSession)
    placed = told_apart_by_place(docs).select(docs[key].alias("_key"), docs[text].alias("_text"), F.monotonically_increasing_id().alias("_row"))
    marked = stored(fingerprints(placed, ["_key", "_row"], "_text", params), "fingerprints")
    order = F.struct(F.col("_key").isNull(), "_key", "_row")
    first = marked.groupBy("fp").agg(F.min(order).alias("first"))
    kept = first.join(link_fingerprints(marked, params), "fp").groupBy("root").agg(F.min("first").alias("first"))
    place = free_name("_kept_row", docs.columns)
    kept = stored(kept.select(F.col("first._row").alias(place)), "kept")
    # the kept rows grow with the corpus: never broadcast, the same join at every size
    numbered = docs.withColumn(place, F.monotonically_increasing_id())
    return numbered.join(kept.hint("merge"), place, "left_semi").drop(place)
