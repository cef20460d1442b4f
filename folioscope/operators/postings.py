"""Exact top-K over sparse rows by an inverted index: impact-ordered postings with bounds, read only where they can matter.

A query touches the postings of its terms instead of the corpus. A few blocks with the highest impact give a first list,
whose K-th score is a floor for the result. Terms that together cannot reach the floor are left out, blocks and rows
are dropped by their bounds, and the remaining rows are scored in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.operators.blocks import SALTS, STEP, Rows, vector_columns
from folioscope.operators.carry import carrier
from folioscope.operators.similarity import CANDIDATES, PUSHED_IDS, RANK_DIGITS, _query_rows
from folioscope.settings import LIMITS, TOP_K, Limits
from folioscope.sources.tables import scratch_path, write_parquet

# entries of a block, impact levels of a term (two an octave)
BLOCK_ROWS = 1_024
LEVELS = 32
# postings a query reads for its first list, per wanted result
PROBES = 100
# share of the floor that terms left out may add: a larger one reads fewer postings and scores more rows
IDLE_SHARE = 0.25
# scores closer than this are told apart by place
TIE = 10.0**-RANK_DIGITS


@dataclass(frozen=True)
class SparseIndex:
    """``postings`` (term_idx, level, part, n, low, high, entries), ``terms`` (term_idx, n, top) and the indexed rows."""

    postings: DataFrame
    terms: DataFrame
    features: DataFrame


def _unit_entries(rows: DataFrame, key: str) -> DataFrame:
    """``(key, term_idx, weight)``: the entries of rows scaled to length one that are not zero."""
    squares = F.aggregate("weight", F.lit(0.0), lambda a, w: a + w * w)
    # the length is a column below the entries: inside a lambda it would be added up again for each of them
    measured = rows.select(key, F.arrays_zip("term_idx", "weight").alias("entries"), F.sqrt(squares).alias("long"))
    pairs = measured.select(key, "long", F.explode("entries").alias("e"))
    scaled = F.when(F.col("long") > 0, F.col("e.weight") / F.col("long")).otherwise(F.lit(0.0))
    return pairs.select(key, "e.term_idx", scaled.alias("weight")).where("weight <> 0")


def build_index(features: DataFrame, path: str, limits: Limits = LIMITS) -> SparseIndex:
    """Write the index of rows ``(id, seq, term_idx, weight)`` below ``path`` and return it.

    Weights are scaled to unit rows and must not be negative. The postings of a term are cut by impact level, and a
    level with many rows into parts by a hash of the row, so that no term, however common, is sorted or grouped in one task.
    """
    spark = features.sparkSession
    level = F.least(F.floor(F.log2("weight") * -2).cast("int"), F.lit(LEVELS - 1))
    entries = _unit_entries(features, "seq").select("seq", "term_idx", "weight", F.greatest(level, F.lit(0)).alias("level"))
    entries = entries.where(F.when(F.col("weight") > 0, True).otherwise(F.raise_error(F.lit("postings need weights that are not negative"))))
    sizes = entries.groupBy("term_idx", "level").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("parts"))
    write_parquet(sizes, f"{path}/levels")
    sizes = spark.read.parquet(f"{path}/levels")
    ship = carrier(sizes, limits)
    part = F.pmod(F.xxhash64("seq"), F.col("parts")).cast("int")
    dealt = entries.join(ship(sizes), ["term_idx", "level"]).withColumn("part", part)
    blocks = dealt.groupBy("term_idx", "level", "part").agg(
        F.count("*").alias("n"), F.min("weight").alias("low"), F.max("weight").alias("high"), F.collect_list(F.struct("seq", "weight")).alias("entries")
    )
    # in the order of terms, so that a scan for some terms skips the rest of a file
    write_parquet(blocks.repartitionByRange("term_idx", "level", "part").sortWithinPartitions("term_idx", "level", "part"), f"{path}/postings")
    postings = spark.read.parquet(f"{path}/postings")
    write_parquet(postings.groupBy("term_idx").agg(F.sum("n").alias("n"), F.max("high").alias("top")), f"{path}/terms")
    return read_index(spark, path, features)


def read_index(spark: SparkSession, path: str, features: DataFrame) -> SparseIndex:
    """The index stored at ``path`` over the rows that it was built from."""
    return SparseIndex(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms"), features)


def _dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of pairs (query_id, q_idx, q_weight, id, seq, term_idx, weight); the terms of a row are in order."""
    for batch in batches:
        if not len(batch):
            continue
        asked = pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("query_id", "seq", "q_idx", "q_weight")], names=["id", "seq", "term_idx", "weight"]
        )
        a, b = Rows.read(asked).unit(), Rows.read(batch).unit()
        rows = np.arange(len(a), dtype=np.int64)
        span = 1 + max(a.index.max(initial=0), b.index.max(initial=0))
        left = np.repeat(rows, a.length) * span + a.index
        right = np.repeat(rows, b.length) * span + b.index
        at = np.minimum(np.searchsorted(left, right), max(len(left) - 1, 0))
        same = left[at] == right if len(left) else np.zeros(len(right), dtype=bool)
        score = np.bincount(right[same] // span, a.value[at[same]] * b.value[same], minlength=len(a)).astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("query_id"), batch.column("id"), batch.column("seq"), pa.array(score)], names=["query_id", "id", "seq", "score"]
        )


def _scored(pairs: DataFrame, asked: DataFrame, asked_rows: int, index: SparseIndex, limits: Limits) -> DataFrame:
    """Exact scores of stored, distinct ``(query_id, seq)``; a query's own row is left out.

    The pairs travel to the rows. A few rows are named in a filter, by which the scan skips what does not hold them.
    """
    rows = index.features
    n = pairs.limit(limits.broadcast_rows + 1).count()
    if n <= PUSHED_IDS:
        rows = rows.where(F.col("seq").isin([r.seq for r in pairs.select("seq").distinct().collect()]))
    wanted = rows.select("id", "seq", *vector_columns(rows)).join(carrier(pairs, limits, n)(pairs), "seq")
    both = wanted.join(carrier(asked, limits, asked_rows)(asked), "query_id").where("id <> query_id")
    return both.select("query_id", "q_idx", "q_weight", "id", "seq", "term_idx", "weight").mapInArrow(_dots, CANDIDATES)


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The K best per query with their rank, merged in two levels."""
    ranked = scored.withColumn("salt", F.spark_partition_id() % SALTS)
    for key in (["query_id", "salt"], ["query_id"]):
        order = Window.partitionBy(*key).orderBy(F.desc(F.round("score", RANK_DIGITS)), "seq")
        ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.drop("salt")


def _stage(df: DataFrame, root: str, name: str) -> DataFrame:
    write_parquet(df, f"{root}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")


def _reach(wq: Column, low: Column, high: Column) -> Column:
    """Most that a unit row with a weight in [low, high] can score against a unit query with ``wq`` for that term."""
    nearest = F.greatest(low, F.least(high, wq))
    return wq * nearest + F.sqrt((1 - wq * wq) * (1 - nearest * nearest))


def _near(wq: np.ndarray, low: float, high: float) -> np.ndarray:
    """``_reach`` in numbers."""
    nearest = np.maximum(low, np.minimum(high, wq))
    return wq * nearest + np.sqrt((1 - wq * wq) * (1 - nearest * nearest))


@dataclass
class _Asked:
    """The query terms to be read, by term, and what the terms left out may add to each query."""

    ids: list[str]
    first: dict[int, slice]
    query: np.ndarray
    wq: np.ndarray
    floor: np.ndarray
    most: np.ndarray
    square: np.ndarray

    @staticmethod
    def read(terms: pa.Table) -> _Asked:
        """Of rows (query_id, term_idx, wq, most, square, floor, idle)."""
        terms = terms.filter(pc.is_valid(terms["query_id"])).sort_by("term_idx")
        names = pc.dictionary_encode(terms["query_id"].combine_chunks())
        query = names.indices.to_numpy(zero_copy_only=False)
        term, wq, most, square, floor, idle = (terms[c].to_numpy() for c in ("term_idx", "wq", "most", "square", "floor", "idle"))
        bounds = np.zeros((3, len(names.dictionary)))
        bounds[0, query] = floor
        np.maximum.at(bounds[1], query[idle], most[idle])
        np.maximum.at(bounds[2], query[idle], square[idle])
        needed = ~idle
        found, start = np.unique(term[needed], return_index=True)
        first = {int(t): slice(a, b) for t, a, b in zip(found, start, [*start[1:], needed.sum()])}
        return _Asked(names.dictionary.to_pylist(), first, query[needed], wq[needed], *bounds)

    def reached(self, term: int, low: float, high: float) -> np.ndarray:
        """The query terms for which some row of a block of the term can reach the query's floor."""
        some = self.first[term]
        with np.errstate(invalid="ignore"):
            # a weight that rounding makes longer than one has no bound, as in Spark
            return some.start + np.flatnonzero(~(_near(self.wq[some], low, high) < self.floor[self.query[some]]))


_CUT = "shard int, blocks binary, block binary, seq binary, weight binary"


def _able_by_shard(index: SparseIndex, rest: DataFrame, queries: int) -> DataFrame:
    """``(query_id, seq)`` that the sums over the postings read do not rule out, for queries that fit a broadcast.

    Postings are dealt by a hash of their row, once and not for each query; a task adds up all queries for its rows, so
    that no sum of a query and a row is shuffled. Rows are cut so that a task holds about STEP sums and postings at most,
    and that there are as many shares as cores.
    """
    shipped = index.features.sparkSession.sparkContext.broadcast(_Asked.read(rest.toArrow()))
    terms = rest.where("not idle").select("term_idx").distinct()
    opened = index.postings.join(F.broadcast(terms), "term_idx", "left_semi")
    read = index.terms.join(F.broadcast(terms), "term_idx", "left_semi").agg(F.sum("n")).first()[0] or 0
    cores = index.features.sparkSession.sparkContext.defaultParallelism
    shards = max(cores, ceil(max(index.features.count() * queries, read) / STEP))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shipped.value
        for batch in batches:
            term, low, high = (batch[c].to_numpy() for c in ("term_idx", "low", "high"))
            keep = [i for i in range(len(batch)) if len(asked.reached(int(term[i]), low[i], high[i]))]
            held = batch.take(pa.array(keep, pa.int64()))
            blocks = np.column_stack([held[c].to_numpy().astype(float) for c in ("term_idx", "low", "high")])
            places, weights = held["seq"].flatten(), held["weight"].flatten()
            known = pc.is_valid(places).to_numpy(zero_copy_only=False)
            block = np.repeat(np.arange(len(held), dtype=np.int32), pc.list_value_length(held["seq"]).to_numpy())[known]
            seq, weight = pc.fill_null(places, 0).to_numpy()[known], weights.to_numpy()[known]
            mixed = (seq.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            shard = (mixed % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            found, start = np.unique(shard[order], return_index=True)
            for number, rows in zip(found, np.split(order, start[1:])):
                used, own = np.unique(block[rows], return_inverse=True)
                parts = (blocks[used], own.astype(np.int32), seq[rows], weight[rows])
                yield pa.record_batch([pa.array([number], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["shard", "blocks", "block", "seq", "weight"])

    def add_up(table: pa.Table) -> pa.Table:
        asked = shipped.value
        parts = [
            [np.frombuffer(x.as_buffer(), t) for x, t in zip(row, (np.float64, np.int32, np.int64, np.float64))]
            for row in zip(*(table[c] for c in ("blocks", "block", "seq", "weight")))
        ]
        seqs, place = np.unique(np.concatenate([seq for _, _, seq, _ in parts]), return_inverse=True)
        score, used, met = (np.zeros(len(asked.ids) * len(seqs), t) for t in (float, float, bool))
        begin = 0
        for blocks, block, seq, weight in parts:
            blocks = blocks.reshape(-1, 3)
            own, begin = place[begin : begin + len(seq)], begin + len(seq)
            ends = np.searchsorted(block, np.arange(len(blocks) + 1))
            for (term, low, high), start, stop in zip(blocks, ends, ends[1:]):
                some = asked.reached(int(term), low, high)
                cells = (asked.query[some, None] * len(seqs) + own[start:stop]).ravel()
                np.add.at(score, cells, np.outer(asked.wq[some], weight[start:stop]).ravel())
                np.add.at(used, cells, np.tile(weight[start:stop] ** 2, len(some)))
                met[cells] = True
        score, used, met = (x.reshape(len(asked.ids), -1) for x in (score, used, met))
        more = np.minimum(asked.most[:, None], np.sqrt(asked.square[:, None] * np.maximum(1 - used, 0)))
        query, row = np.nonzero(met & (score + more >= asked.floor[:, None]))
        return pa.table({"query_id": pa.array(asked.ids, pa.string()).take(pa.array(query)), "seq": seqs[row]})

    lists = opened.select("term_idx", "low", "high", F.col("entries.seq").cast("array<bigint>").alias("seq"), F.col("entries.weight").alias("weight"))
    return lists.mapInArrow(cut, _CUT).repartition(shards, "shard").groupBy("shard").applyInArrow(add_up, "query_id string, seq long")


def topk_indexed(
    index: SparseIndex, queries: DataFrame, k: int = TOP_K, limits: Limits = LIMITS, root: str | None = None
) -> DataFrame:
    """``(query_id, rank, id, seq, score)``: the rows that ``similarity.topk`` gives, through the index.

    Of each query term the blocks with the highest impact are read first, ``PROBES`` postings per wanted result; the K-th best
    exact score among their best rows is the query's floor. A row outside of that list is in the result only if its score
    reaches the floor, so: the terms with the longest postings are left out as long as they cannot reach it alone, by
    the sum of their largest products or by the length of that part of the query; a block is left out if no row with such a
    weight can reach it; a row is left out if its score over the terms read and the most the others can add stay below.
    What remains is scored in full. The first rows of the corpus are scored as well: rows without a shared term fill short
    lists in corpus order. Intermediate tables are written below ``root``: ``scored`` holds every pair scored.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    features = index.features
    spark = features.sparkSession
    root = root or scratch_path(spark, "indexed")
    if not k:
        return _best(spark.createDataFrame([], CANDIDATES), 0).select("query_id", "rank", "id", "seq", "score")
    rows = _query_rows(queries, features, limits).select(F.col("id").alias("query_id"), F.col("term_idx").alias("q_idx"), F.col("weight").alias("q_weight"))
    asked = _stage(rows, root, "asked")
    sought = _unit_entries(asked.select("query_id", F.col("q_idx").alias("term_idx"), F.col("q_weight").alias("weight")), "query_id")
    sought = sought.withColumnRenamed("weight", "wq").join(index.terms, "term_idx")
    sought = _stage(sought, root, "sought")
    n = asked.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("q_idx")), F.lit(0)).alias("terms")).first()
    ship, ship_row, ship_head = (carrier(asked, limits, m) for m in (n.terms, n.rows, n.terms * LEVELS))

    # the blocks with the highest impact, one part of each level, up to the number of probes
    heads = index.postings.where("part = 0").select("term_idx", "level", "part", F.col("n").alias("rows"), "low", "high")
    by_impact = Window.partitionBy("query_id").orderBy(F.desc(F.col("wq") * F.col("high")), "term_idx", "level").rowsBetween(Window.unboundedPreceding, -1)
    first = heads.join(ship(sought.select("query_id", "term_idx", "wq")), "term_idx")
    first = first.withColumn("before", F.coalesce(F.sum("rows").over(by_impact), F.lit(0))).where(F.col("before") < PROBES * k)
    first = _stage(first.select("query_id", "wq", "term_idx", "level", "part"), root, "probes")
    opened = index.postings.join(ship_head(first), ["term_idx", "level", "part"])
    partial = opened.select("query_id", "wq", F.explode("entries").alias("e")).groupBy("query_id", F.col("e.seq").alias("seq")).agg(F.sum(F.col("wq") * F.col("e.weight")).alias("score"))
    likely = _best(partial.withColumn("id", F.lit("")), 3 * k).select("query_id", "seq")
    corpus_head = features.select("seq").orderBy("seq").limit(2 * k + 1)
    # 2k + 1 rows of the corpus for every query, whatever the corpus
    heads = asked.select("query_id").crossJoin(F.broadcast(corpus_head))
    pairs = _stage(likely.unionByName(heads).distinct(), root, "first_pairs")
    known = _stage(_scored(pairs, asked, n.rows, index, limits), root, "first")
    floors = _best(known, k).groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).otherwise(F.lit(0.0)).alias("floor"))

    # terms in the order of their length: the longest together may not reach the floor alone
    longest = Window.partitionBy("query_id").orderBy(F.desc("n"), "term_idx").rowsBetween(Window.unboundedPreceding, 0)
    rest = sought.select(
        "query_id", "term_idx", "wq", F.sum(F.col("wq") * F.col("top")).over(longest).alias("most"), F.sum(F.col("wq") * F.col("wq")).over(longest).alias("square")
    ).join(ship_row(floors), "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)) - TIE)
    rest = rest.withColumn("idle", F.least("most", F.sqrt("square")) < IDLE_SHARE * F.col("floor"))
    rest = _stage(rest, root, "terms")
    if n.terms <= limits.broadcast_rows:
        able = _able_by_shard(index, rest, n.rows)
    else:
        able = _able_by_query(index, rest, ship, ship_row)
    fresh = _stage(able.join(known.select("query_id", "seq"), ["query_id", "seq"], "left_anti"), root, "pairs")
    scored = _stage(known.unionByName(_scored(fresh, asked, n.rows, index, limits)), root, "scored")
    return _best(scored, k).select("query_id", "rank", "id", "seq", "score")


def _able_by_query(index: SparseIndex, rest: DataFrame, ship: Callable, ship_row: Callable) -> DataFrame:
    """The rows of ``_able_by_shard`` for any number of queries: the sums of a query and a row are shuffled."""
    idle = rest.where("idle").groupBy("query_id").agg(F.max("most").alias("most"), F.max("square").alias("square"))
    needed = rest.where("not idle").select("query_id", "term_idx", "wq", "floor")
    opened = index.postings.join(ship(needed), "term_idx").where(_reach(F.col("wq"), F.col("low"), F.col("high")) >= F.col("floor"))
    sums = opened.select("query_id", "wq", "floor", F.explode("entries").alias("e")).groupBy("query_id", F.col("e.seq").alias("seq")).agg(
        F.sum(F.col("wq") * F.col("e.weight")).alias("score"), F.sum(F.col("e.weight") * F.col("e.weight")).alias("used"), F.first("floor").alias("floor")
    )
    zero = F.lit(0.0)
    more = F.least(F.coalesce("most", zero), F.sqrt(F.coalesce("square", zero) * F.greatest(1 - F.col("used"), zero)))
    return sums.join(ship_row(idle), "query_id", "left").where(F.col("score") + more >= F.col("floor")).select("query_id", "seq")
