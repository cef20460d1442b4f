"""Exact top-K cosine similarity for batches of queries.

Every corpus row is scored inside the task that reads it and each task passes on only its best K per query, so
what is shuffled is tasks x queries x K rows: no corpus row, no score of a non-candidate and no pair list.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text as tx
from folioscope.operators.blocks import SALTS, Rows, Scorer, distinct_columns, entries, vector_columns
from folioscope.operators.carry import carrier
from folioscope.operators.lookup import last_wins
from folioscope.schemas import PAPER_FIELDS
from folioscope.settings import LIMITS, PREVIEW_CHARS, TOP_K, Limits

# Scores are compared after rounding to 6 decimals and shown with 4.
RANK_DIGITS = 6
SCORE_DIGITS = 4

# rows and queries scored at once, few enough for their scores to stay in a processor's cache
TILE = 512
# row blocks for each bound of entries: one task of two full blocks would score billions of pairs
ROW_CUTS = 4

# ids that are stated in a filter instead of a join
PUSHED_IDS = 1_000

CANDIDATES = "query_id string, id string, seq long, score double"
_ARROW = pa.schema([("query_id", pa.string()), ("id", pa.string()), ("seq", pa.int64()), ("score", pa.float64())])


class _Best:
    """The best K rows per query seen so far: highest rounded score, then lowest seq; never the query itself.

    Once a list is full its last entry is a floor: of a tile of scores only the few above it are taken out and merged.
    """

    def __init__(self, queries: Rows, k: int, floor: np.ndarray | None = None):
        self.scorer = Scorer(queries)
        self.query_ids = queries.ids
        self.k = k
        self.own: dict[str, list[int]] = {}
        for i, name in enumerate(queries.ids):
            self.own.setdefault(name, []).append(i)
        shape = (len(queries), k)
        self.ids = np.full(shape, None, object)
        self.seq = np.full(shape, np.iinfo(np.int64).max)
        self.score = np.full(shape, -np.inf)
        # lowest score that may enter a list
        self.floor = np.full(len(queries), -np.inf) if floor is None else floor.copy()
        if queries.index is None:
            # such a row has no score with any other
            self.floor[~np.isfinite(queries.value).all(axis=1)] = np.inf

    def add(self, rows: Rows) -> None:
        if not self.k:
            return
        if rows.index is None:
            for start in range(0, len(rows), TILE):
                part = rows.part(start, start + TILE)
                tiles = range(0, len(self.query_ids), TILE)
                self._take(part, ((t, part.value @ self.scorer.matrix[:, t : t + TILE]) for t in tiles))
        else:
            for part in rows.steps(len(self.query_ids)):
                self._take(part, [(0, self.scorer(part))])

    def _take(self, rows: Rows, tiles: Iterable[tuple[int, np.ndarray]]) -> None:
        """Merge scores, given as tiles with one line per row and one column per query from the given one on."""
        same = [(r, q) for r, name in enumerate(rows.ids) for q in self.own.get(name, ())]
        own_row, own_query = np.array(same, np.int64).reshape(-1, 2).T
        found = []
        for start, scores in tiles:
            width = scores.shape[1]
            inside = (own_query >= start) & (own_query < start + width)
            scores[own_row[inside], own_query[inside] - start] = -np.inf
            floor = self.floor[start : start + width]
            if np.isneginf(floor).any():
                row, query = self._first(rows, scores)
            else:
                row, query = np.divmod(np.flatnonzero((scores >= floor).ravel()), width)
            if len(row):
                found.append((query + start, row, scores[row, query]))
        if found:
            query, row, score = (np.concatenate(c) for c in zip(*found))
            self._merge(query, rows.ids[row], rows.seq[row], score)

    def _first(self, rows: Rows, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best rows of every query; one integer per score finds them: rounded score first, then place by seq."""
        n, width = scores.shape
        place = np.empty(n, np.int64)
        place[np.argsort(rows.seq, kind="stable")] = np.arange(n)
        usable = np.isfinite(scores)
        keys = np.where(usable, np.rint(np.where(usable, scores, 0.0) * 10**RANK_DIGITS), -(2.0**31)).astype(np.int64) * n - place[:, None]
        take = min(self.k, n)
        row = np.argpartition(-keys.T, take - 1, axis=1)[:, :take].ravel()
        return row, np.repeat(np.arange(width), take)

    def _merge(self, query: np.ndarray, ids: np.ndarray, seq: np.ndarray, score: np.ndarray) -> None:
        kept = np.isfinite(score)
        key = np.rint(np.where(kept, score, 0.0) * 10**RANK_DIGITS)
        last = np.rint(self.score[query, -1] * 10**RANK_DIGITS)
        kept &= (key > last) | ((key == last) & (seq < self.seq[query, -1]))
        query, ids, seq, score = query[kept], ids[kept], seq[kept], score[kept]
        changed = np.unique(query)
        query = np.concatenate([np.repeat(changed, self.k), query])
        ids, seq, score = (
            np.concatenate([old[changed].ravel(), new]) for old, new in ((self.ids, ids), (self.seq, seq), (self.score, score))
        )
        order = np.lexsort((seq, -np.rint(score * 10**RANK_DIGITS), query))
        first = np.searchsorted(query[order], changed)
        top = order[first[:, None] + np.arange(self.k)]
        self.ids[changed], self.seq[changed], self.score[changed] = ids[top], seq[top], score[top]
        self.floor[changed] = np.maximum(self.floor[changed], self.score[changed, -1] - 1.01 * 10.0**-RANK_DIGITS)

    def table(self) -> pa.Table:
        found = np.isfinite(self.score)
        owner = np.broadcast_to(self.query_ids[:, None], self.score.shape)
        columns = [m[found] for m in (owner, self.ids, self.seq, self.score)]
        return pa.table([pa.array(c, t.type) for c, t in zip(columns, _ARROW)], schema=_ARROW)


def _score_all(best: _Best, tables: Iterator[pa.RecordBatch | pa.Table]) -> pa.Table:
    for table in tables:
        best.add(Rows.read(table).unit())
    return best.table()


def _query_rows(queries: DataFrame, features: DataFrame, limits: Limits) -> DataFrame:
    """Feature rows of the queried ids; unknown ids drop out, repeated ids count once, of rows with one id the last."""
    wanted = queries.select(F.col("query_id").alias("id")).distinct()
    asked = features.join(carrier(queries, limits)(wanted), "id", "left_semi")
    return last_wins(asked.select("id", "seq", *vector_columns(features)))


def _by_broadcast(features: DataFrame, query_table: pa.Table, k: int) -> DataFrame:
    shipped = features.sparkSession.sparkContext.broadcast(query_table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _score_all(_Best(Rows.read(shipped.value).unit(), k), batches).to_batches()

    return features.select("id", "seq", *vector_columns(features)).mapInArrow(run, CANDIDATES)


def _by_blocks(features: DataFrame, query_rows: DataFrame, k: int, query_blocks: int, row_blocks: int) -> DataFrame:
    """Fragment and replicate: corpus blocks meet query blocks in tasks of bounded size on both sides."""

    def block_of(n: int):
        return F.pmod(F.xxhash64("id", "seq"), F.lit(n)).cast("int")

    def copies(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    columns = ["id", "seq", *vector_columns(features)]
    rows = features.select(*columns, block_of(row_blocks).alias("rb"), copies(query_blocks).alias("qb"))
    asked = query_rows.select(*columns, block_of(query_blocks).alias("qb"), copies(row_blocks).alias("rb"))

    def run(row_table: pa.Table, query_table: pa.Table) -> pa.Table:
        if not len(query_table) or not len(row_table):
            return _ARROW.empty_table()
        return _score_all(_Best(Rows.read(query_table).unit(), k), row_table.to_batches(max_chunksize=10_000))

    return rows.groupBy("rb", "qb").cogroup(distinct_columns(asked).groupBy("rb", "qb")).applyInArrow(run, CANDIDATES)


def topk(features: DataFrame, queries: DataFrame, k: int = TOP_K, limits: Limits = LIMITS) -> DataFrame:
    """``(query_id, rank, id, seq, score)``: the K rows most similar to each queried row, best first.

    Sparse and dense features alike. Rows without any shared term score 0 and fill the list in seq order. The
    query itself is left out by id, so an exact copy of it ranks first. Two limits are read from the data: a
    query set within ``block_entries`` is broadcast; a larger one, up to the whole corpus, is cut into blocks, so that a
    task's pairs stay bounded however large the table is.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    # measured, then fetched: kept so that the features are scanned once for both
    query_rows = _query_rows(queries, features, limits).cache()
    try:
        size = query_rows.agg(F.sum(entries(features).cast("long")).alias("n")).first().n or 0
        if k == 0 or size == 0:
            empty = features.sparkSession.createDataFrame([], CANDIDATES)
            return empty.withColumn("rank", F.lit(0)).select("query_id", "rank", "id", "seq", "score")
        query_table = query_rows.toArrow() if size <= limits.block_entries else None
    finally:
        query_rows.unpersist()
    if query_table is not None:
        found = _by_broadcast(features, query_table, k)
    else:
        total = features.agg(F.sum(entries(features).cast("long")).alias("n")).first().n
        found = _by_blocks(
            features, query_rows, k, ceil(size / limits.block_entries), ceil(ROW_CUTS * total / limits.block_entries)
        )
    # tasks' lists are merged in two levels, so that no task gets one from every split
    ranked = found.withColumn("salt", F.spark_partition_id() % SALTS)
    for key in (["query_id", "salt"], ["query_id"]):
        best_first = Window.partitionBy(*key).orderBy(F.desc(F.round("score", RANK_DIGITS)), "seq")
        ranked = ranked.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "seq", "score")


def with_metadata(
    ranked: DataFrame, papers: DataFrame, at_most: int | None = None, limits: Limits = LIMITS
) -> DataFrame:
    """Result rows with title, abstract preview, authors and categories; score shown with 4 decimals.

    The results, not the papers, travel to the join when they are within ``broadcast_rows``. ``at_most`` is a known
    bound on the number of results; without it they are counted, so pass a stored table.
    """
    ship = carrier(ranked, limits, at_most)
    # joined first, shortened after: only the results' abstracts are touched
    return papers.select(*PAPER_FIELDS).join(ship(ranked), "id").select(
        "query_id",
        "rank",
        "id",
        "title",
        tx.ellipsize("abstract", PREVIEW_CHARS).alias("abstract"),
        "authors",
        "categories",
        F.round("score", SCORE_DIGITS).alias("score"),
    )


def recommend_many(
    papers: DataFrame, features: DataFrame, queries: DataFrame, k: int = TOP_K, limits: Limits = LIMITS
) -> DataFrame:
    """Similar papers with metadata for every queried id; unknown ids have no rows."""
    return with_metadata(topk(features, queries, k, limits), papers, queries.count() * k, limits)


def recommend(
    papers: DataFrame, features: DataFrame, paper_id: str, k: int = TOP_K, limits: Limits = LIMITS
) -> DataFrame:
    """Similar papers for one id; an unknown id is an error."""
    spark = features.sparkSession
    query = spark.createDataFrame([(paper_id,)], "query_id string")
    if not features.where(F.col("id") == paper_id).take(1):
        raise ValueError(f"Paper ID '{paper_id}' not found in the dataset.")
    found = topk(features, query, k, limits)
    if k <= PUSHED_IDS:
        # one short list: its ids become a filter that the scan of the papers can use to skip row groups
        rows = found.collect()
        found = spark.createDataFrame(rows, found.schema)
        papers = papers.where(F.col("id").isin([row.id for row in rows]))
    return with_metadata(found, papers, k, limits).orderBy("rank")


def requested_k(k: str = "k", default: int = TOP_K):
    """A request's K: a whole number (sign, blanks around it and inner underscores allowed), else the default."""
    written = tx.strip(k)
    whole = F.coalesce(written.rlike(r"^[+-]?\d+(_\d+)*$"), F.lit(False))
    digits = F.regexp_replace(written, "_", "")
    # beyond the range of a long every list is exhausted anyway
    huge = F.when(digits.startswith("-"), F.lit(0)).otherwise(F.lit(2**62))
    number = F.coalesce(digits.try_cast("bigint"), huge)
    return F.when(whole, F.greatest(number, F.lit(0))).otherwise(F.lit(default).cast("bigint"))


def answer_requests(
    requests: DataFrame,
    papers: DataFrame,
    features: DataFrame,
    default_k: int = TOP_K,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Batch form of the recommendation endpoint over ``(request_id, paper_id, k)``.

    Known papers get one row per result with status ``ok`` (one row without a result for an empty list), unknown
    ones a single ``error`` row with a message. Lists are ranked once per paper, in classes of K up to ten times as
    large as the smallest of the class: a request for a very long list does not lengthen the others.
    """
    asked = requests.select("request_id", "paper_id", requested_k("k", default_k).alias("top_k"))
    named = asked.groupBy("paper_id").agg(F.max("top_k").alias("k"))
    ids = features.select(F.col("id").alias("paper_id"))
    known = ids.join(carrier(requests, limits)(named), "paper_id")
    if (known.agg(F.max("k").alias("k")).first().k or 0) > TOP_K:
        known = known.withColumn("k", F.least("k", F.lit(features.count())))
    length = F.when(F.col("k") <= TOP_K, F.lit(0)).otherwise(F.ceil(F.log10(F.col("k") / TOP_K)))
    known = known.withColumn("length", length)
    classes = known.groupBy("length").agg(F.count("*").alias("n"), F.max("k").alias("k")).orderBy("length").collect()
    lists = None
    for c in classes:
        own = known.where(F.col("length") == c.length).select(F.col("paper_id").alias("query_id"))
        ranked = topk(features, own, c.k, limits)
        lists = ranked if lists is None else lists.unionByName(ranked)
    if lists is None:
        lists = topk(features, known.select(F.col("paper_id").alias("query_id")), 0, limits)
    # a paper may be asked for very often: its list is sent to the requests, not the requests to its list
    bound = sum(c.n * c.k for c in classes)
    results = with_metadata(lists, papers, bound, limits).withColumnRenamed("query_id", "paper_id")
    send_ids, send_lists = carrier(known, limits, sum(c.n for c in classes)), carrier(results, limits, bound)
    flagged = asked.join(send_ids(known.select("paper_id", F.lit(True).alias("_known"))), "paper_id", "left")
    wanted = flagged.join(send_lists(results), "paper_id", "left").where(
        F.col("rank").isNull() | (F.col("rank") <= F.col("top_k")) | ((F.col("top_k") == 0) & (F.col("rank") == 1))
    )
    ok = F.coalesce("_known", F.lit(False))
    shown = ok & (F.col("rank") <= F.col("top_k"))
    message = F.concat(F.lit("Paper ID '"), F.col("paper_id"), F.lit("' not found in the dataset."))
    return wanted.select(
        "request_id",
        "paper_id",
        "top_k",
        F.when(ok, "ok").otherwise("error").alias("status"),
        F.when(~ok, message).alias("message"),
        *[F.when(shown, F.col(c)).alias(c) for c in ("rank", "id", "title", "abstract", "authors", "categories", "score")],
    )
