"""Benchmark decontamination by greedy string tiling.

Word runs that a document shares with a benchmark item seed the comparison; greedy string tiling then marks the longest
matches that do not overlap, found by running Karp-Rabin hashes, until no match of the minimum length is left. The share
of the item's words under tiles decides, so passages in another order are found as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from folioscope.llm.common import ready

WORD = re.compile(r"[^\W_]+")
# Letters of scripts written without blanks (Thai to Lao, Burmese, Khmer, Kana, Han).
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")
MIXED = re.compile(rf"(?=[{UNSPACED}])[^\W_]|(?:(?![{UNSPACED}])[^\W_])+")
MULTIPLIER = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class TilingParams:
    """Tiles have ``tile`` words at least; an item counts as found when ``coverage`` of its words lie under tiles.
    An item of fewer words is one tile of its own length. Items are broadcast in blocks of about ``block_words`` words."""

    tile: int = 5
    coverage: float = 0.8
    block_words: int = 500_000


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits; of scripts without blanks every letter is a word."""
    lower = (text or "").lower()
    return (MIXED if not lower.isascii() and HAS_UNSPACED.search(lower) else WORD).findall(lower)


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes (mod 2**64) of all runs of ``length`` ids."""
    runs = len(ids) - length + 1
    out = np.zeros(max(runs, 0), dtype=np.uint64)
    for k in range(length):
        out = out * np.uint64(MULTIPLIER) + (ids[k : k + len(out)].astype(np.uint64) + np.uint64(1))
    return out


def _free_runs(marked: np.ndarray, length: int) -> np.ndarray:
    """Starts of runs of ``length`` places without a mark."""
    sums = np.concatenate(([0], np.cumsum(marked)))
    return np.flatnonzero(sums[length:] == sums[:-length]) if len(marked) >= length else np.zeros(0, dtype=np.int64)


def _matches(item: np.ndarray, text: np.ndarray, item_marks: np.ndarray, text_marks: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Maximal unmarked matches (length, item place, text place) of ``length`` words or more."""
    hashes = rolling(text, length)
    places: dict[int, list[int]] = {}
    for t in _free_runs(text_marks, length).tolist():
        places.setdefault(int(hashes[t]), []).append(t)
    wanted = rolling(item, length)
    found = []
    for i in _free_runs(item_marks, length).tolist():
        for t in places.get(int(wanted[i]), ()):
            if i and t and item[i - 1] == text[t - 1] and not item_marks[i - 1] and not text_marks[t - 1]:
                continue  # part of the match that starts one word earlier
            k = 0
            while (
                i + k < len(item) and t + k < len(text) and item[i + k] == text[t + k] and not item_marks[i + k] and not text_marks[t + k]
            ):
                k += 1
            if k >= length:
                found.append((k, i, t))
    return found


def greedy_tiles(item: np.ndarray, text: np.ndarray, minimum: int) -> list[tuple[int, int, int]]:
    """Tiles (item place, text place, length) of running Karp-Rabin greedy string tiling (Wise, 1993).

    The search length starts long and falls to ``minimum``; at each length the longest matches are marked first, what
    an earlier tile has cut off stays in play. Ties go to the earlier item place, then the earlier text place.
    Negative ids match nothing.
    """
    item_marks, text_marks = item < 0, text < 0
    tiles = []
    length = max(minimum, min(len(item), len(text)))
    while True:
        queue = _matches(item, text, item_marks, text_marks, length)
        while queue:
            longest = max(k for k, _, _ in queue)
            again = []
            for k, i, t in sorted(queue, key=lambda m: (-m[0], m[1], m[2])):
                taken = item_marks[i : i + k] | text_marks[t : t + k]
                if not taken.any() and k == longest:
                    item_marks[i : i + k] = text_marks[t : t + k] = True
                    tiles.append((i, t, k))
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate(([1], taken.astype(np.int8), [1]))))
                again += [(int(b - a), i + int(a), t + int(a)) for a, b in zip(edges[::2], edges[1::2]) if b - a >= length]
            queue = again
        if length == minimum:
            return tiles
        length = max(minimum, length // 2)


def without_spare_copies(text: np.ndarray, n: int, tile: int) -> np.ndarray:
    """``text`` without stretches that no tiling with an item of ``n`` words can use; -1 stands where some were.

    At most ``n // tile`` tiles are laid, each of at most ``n`` words. Places whose surroundings are equal over ``n`` words on
    both sides offer the same matches, and one tile touches only one of two such places that are ``2 n`` apart. So of each
    kind the first places at that distance, one more than there can be tiles, are enough: one of them is always free, and comes
    before those left out.
    """
    enough, span = n // tile + 1, 2 * n + 1
    if len(text) <= 2 * enough * span:
        return text
    padded = np.concatenate((np.full(n, -1), text, np.full(n, -1))).astype(np.int64).astype(np.uint64) + np.uint64(2)
    powers = np.cumprod(np.full(len(padded), MULTIPLIER, dtype=np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(padded * powers)))
    backwards = np.cumprod(np.full(len(text), pow(MULTIPLIER, -1, 1 << 64), dtype=np.uint64))
    kinds = (sums[span:] - sums[:-span]) * backwards
    order = np.argsort(kinds, kind="stable")
    heads = np.flatnonzero(np.concatenate(([True], kinds[order][1:] != kinds[order][:-1])))
    tails = np.append(heads[1:], len(order))
    kept = np.ones(len(text), dtype=bool)
    for head, tail in zip(heads, tails):
        if tail - head <= enough:
            continue
        places = order[head:tail]
        kept[places] = False
        at = 0
        for _ in range(enough):
            if at == len(places):
                break
            kept[places[at]] = True
            at = int(np.searchsorted(places, places[at] + 2 * n))
    # with the surroundings of what is kept
    change = np.zeros(len(text) + 1, dtype=np.int64)
    anchors = np.flatnonzero(kept)
    np.add.at(change, np.maximum(anchors - n, 0), 1)
    np.add.at(change, np.minimum(anchors + n + 1, len(text)), -1)
    inside = np.cumsum(change[:-1]) > 0
    return _with_gaps(text, np.flatnonzero(inside))


def _with_gaps(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The ids at some places in order, with -1 between places that are not neighbours."""
    return np.insert(ids[places], np.flatnonzero(np.diff(places) > 1) + 1, -1)


class ItemBlock:
    """A block of benchmark items, ready to be compared with texts. Items of equal words are compared once."""

    def __init__(self, rows: list[Row], params: TilingParams):
        self.params = params
        self.keys, self.vocabulary = [], {}
        numbers: dict[tuple[int, ...], list[int]] = {}
        for row in rows:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(row["text"]))
            if ids:
                numbers.setdefault(ids, []).append(len(self.keys))
                self.keys.append(row["item"])
        whole = {ids: rows for ids, rows in numbers.items() if len(ids) >= params.tile}
        self.ids, self.rows = [np.array(ids, dtype=np.int64) for ids in whole], list(whole.values())
        self.sizes = np.array([len(ids) for ids in self.ids], dtype=np.int64)
        # items shorter than a tile by their length
        self.short: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for ids, own in numbers.items():
            if len(ids) < params.tile:
                self.short.setdefault(len(ids), {})[ids] = own
        seeds = [rolling(ids, params.tile) for ids in self.ids]
        owner = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds]).astype(np.int64)
        place = np.concatenate([np.arange(len(s)) for s in seeds]) if seeds else np.zeros(0, dtype=np.int64)
        hashes = np.concatenate(seeds) if seeds else np.zeros(0, dtype=np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.seeds, self.first, counts = np.unique(hashes[order], return_index=True, return_counts=True)
        self.last = self.first + counts
        self.owner, self.place = owner[order], place[order]

    def found(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """(item number, words of the item, words under tiles, tiles) of the items found in a whole text."""
        known = self.vocabulary.get
        ids = np.array([known(w, -1) for w in words_of(text)], dtype=np.int64)
        if (ids < 0).all():
            return
        yield from self._short_items(ids)
        yield from self._whole_items(ids)

    def _runs(self, ids: np.ndarray, length: int) -> np.ndarray:
        """Starts of runs of known words."""
        if len(ids) < length:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(np.convolve(ids < 0, np.ones(length, dtype=np.int64), "valid") == 0)

    def _short_items(self, ids: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        for length, items in self.short.items():
            starts = self._runs(ids, length)
            runs = np.unique(ids[starts[:, None] + np.arange(length)], axis=0) if len(starts) else np.zeros((0, length), dtype=np.int64)
            for run in map(tuple, runs.tolist()):
                for k in items.get(run, ()):
                    yield k, length, length, 1

    def _whole_items(self, ids: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        tile, coverage = self.params.tile, self.params.coverage
        inside = self._runs(ids, tile)
        if not len(inside) or not len(self.seeds):
            return
        hashes = rolling(ids, tile)[inside]
        at = np.minimum(np.searchsorted(self.seeds, hashes), len(self.seeds) - 1)
        hit = self.seeds[at] == hashes
        at, inside = at[hit], inside[hit]
        if not len(at):
            return
        by_seed = np.argsort(at, kind="stable")
        places, (met, head) = inside[by_seed], np.unique(at[by_seed], return_index=True)
        tail = np.append(head[1:], len(places))
        # each seed counts once, however often the text has it: no more than the block's own places
        counts = self.last[met] - self.first[met]
        posting = np.repeat(self.first[met] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        seed = np.repeat(np.arange(len(met)), counts)
        by_item = np.lexsort((self.place[posting], self.owner[posting]))
        owner, place, seed = self.owner[posting][by_item], self.place[posting][by_item], seed[by_item]
        # tiles lie within seeds, so what the seeds cover bounds what tiles can cover
        step = np.full(len(owner), tile)
        same = owner[1:] == owner[:-1]
        step[:-1][same] = np.minimum(np.diff(place), tile)[same]
        reach = np.bincount(owner, step, minlength=len(self.sizes))
        able = np.flatnonzero((reach > 0) & (reach >= coverage * self.sizes))
        begin, end = np.searchsorted(owner, able), np.searchsorted(owner, able, side="right")
        for k, a, b in zip(able.tolist(), begin, end):
            item = self.ids[k]
            starts = np.concatenate([places[head[s] : tail[s]] for s in np.unique(seed[a:b])])
            part = _with_gaps(ids, np.unique(starts[:, None] + np.arange(tile)))
            tiles = greedy_tiles(item, without_spare_copies(part, len(item), tile), tile)
            covered = sum(t[2] for t in tiles)
            if covered >= coverage * len(item):
                for number in self.rows[k]:
                    yield number, len(item), covered, len(tiles)


def item_blocks(benchmark: DataFrame, params: TilingParams, key: str, text: str) -> Iterator[ItemBlock]:
    """The benchmark in blocks of bounded size, each fetched when it is needed; any benchmark is compared whole."""
    rows = benchmark.select(F.col(key).alias("item"), F.col(text).cast("string").alias("text"))
    # characters bound words
    total = rows.agg(F.sum(F.char_length("text")).alias("n")).first()["n"] or 0
    n = total // (4 * params.block_words) + 1
    for block in range(n):
        yield ItemBlock(rows.where(F.pmod(F.xxhash64("text", "item"), F.lit(n)) == block).collect(), params)


def contaminated_pairs(
    docs: DataFrame,
    benchmark: DataFrame,
    params: TilingParams = TilingParams(),
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``key, item, item_words, covered_words, tiles, coverage``: every item found in every whole document.

    Texts are compared as lower-case runs of letters and digits, letter by letter in scripts without blanks. Null and empty
    texts contain nothing, and items without a word are in nothing; items of fewer words than a tile have to occur as they
    are. Repeated rows of documents or items give repeated pairs, null keys stay null, and
    empty tables give no rows. Documents are only scanned: nothing is shuffled and no document meets another.
    """
    spark = docs.sparkSession
    ready(spark)
    given = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kinds = given.schema["key"].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"`{key}` {kinds[0]}, `{item}` {kinds[1]}, item_words long, covered_words long, tiles long, coverage double"
    parts = []
    for block in item_blocks(benchmark, params, item, item_text):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                hits = [(r, *f) for r, t in enumerate(batch.column(1).to_pylist()) for f in block.found(t)]
                if hits:
                    rows, numbers, words, covered, tiles = (np.array(c) for c in zip(*hits))
                    keys = batch.column(0).take(pa.array(rows))
                    items = pa.array([block.keys[k] for k in numbers.tolist()])
                    out = [keys, items, pa.array(words), pa.array(covered), pa.array(tiles), pa.array(covered / words)]
                    yield pa.RecordBatch.from_arrays(out, names=[key, item, "item_words", "covered_words", "tiles", "coverage"])

        parts.append(given.mapInArrow(run, schema))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, params: TilingParams = TilingParams(), text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` without the rows in which an item is found; all columns and all other rows stay as they are."""
    spark = docs.sparkSession
    ready(spark)
    for block in item_blocks(benchmark, params, item, item_text):
        docs = docs.where(_clean(spark.sparkContext.broadcast(block))(docs[text].cast("string")))
    return docs


def _clean(shared: Broadcast[ItemBlock]):
    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([next(shared.value.found(t.as_py()), None) is None for t in texts], pa.bool_())

    return clean
