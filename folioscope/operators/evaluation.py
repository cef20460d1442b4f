"""Ranking evaluation over result tables ``(query_id, rank, id, ...)``.

A result is relevant when its primary category equals the query's. All metrics of all K come from one ranked
table, ranked to the largest K.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text as tx
from folioscope.functions.sampling import sample_key
from folioscope.functions.text import primary_category
from folioscope.operators.blocks import is_sparse, vector_columns
from folioscope.operators.carry import carrier
from folioscope.settings import EVAL_QUERIES, LIMITS, SEED, Limits

METRIC_DIGITS = 4

# Reading guide for diversity; gaps between the bands have no name.
NARROW_BELOW = 0.3
MODERATE = (0.4, 0.7)
SCATTERED_ABOVE = 0.8


def sample_queries(papers: DataFrame, n: int = EVAL_QUERIES, seed: int = SEED) -> DataFrame:
    """``n`` query ids without replacement (all of them if the corpus is smaller)."""
    return papers.orderBy(sample_key(seed), "id").limit(n).select(F.col("id").alias("query_id"))


def with_primary_category(papers: DataFrame) -> DataFrame:
    return papers.select("id", primary_category("categories").alias("primary_category"))


def judge(ranked: DataFrame, categories: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Adds ``relevant``. A null category equals nothing; results and queries unknown to the corpus drop out.

    Results number queries x K, the corpus does not: the result side travels, the corpus stays where it is.
    """
    ship = carrier(ranked, limits)
    category = categories.select("id", "primary_category")
    of_query = category.select(F.col("id").alias("query_id"), F.col("primary_category").alias("query_category"))
    half = of_query.join(ship(ranked.select("query_id", "rank", "id")), "query_id")
    judged = category.join(ship(half), "id")
    same = F.coalesce(F.col("primary_category") == F.col("query_category"), F.lit(False))
    return judged.select("query_id", "rank", "id", same.alias("relevant"))


def per_k(df: DataFrame, ks: Sequence[int], rank: str = "rank") -> DataFrame:
    """One copy of a ranked row for each K whose list it belongs to."""
    wanted = F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k >= F.col(rank))
    return df.withColumn("k", F.explode(wanted))


def query_scores(judged: DataFrame, ks: Sequence[int]) -> DataFrame:
    """``(query_id, k, precision, reciprocal_rank)``; precision divides by K even if the list is shorter."""
    first_hit = F.min(F.when(F.col("relevant"), F.col("rank")))
    return (
        per_k(judged, ks)
        .groupBy("query_id", "k")
        .agg(F.sum(F.col("relevant").cast("int")).alias("hits"), first_hit.alias("first_hit"))
        .select(
            "query_id",
            "k",
            (F.col("hits") / F.col("k")).alias("precision"),
            F.coalesce(F.lit(1.0) / F.col("first_hit"), F.lit(0.0)).alias("reciprocal_rank"),
        )
    )


def vector_entries(features: DataFrame, *carried: str) -> DataFrame:
    """Feature rows as ``(*carried, place, dimension, value)``; an empty row keeps one entry of nulls."""
    if is_sparse(features):
        pairs = F.arrays_zip(F.col("term_idx").alias("dimension"), F.col("weight").cast("array<double>").alias("value"))
    else:
        pairs = F.transform("embedding", lambda x, i: F.struct(i.alias("dimension"), x.cast("double").alias("value")))
    return features.select(*carried, F.posexplode_outer(pairs).alias("place", "_e")).select(
        *carried, "place", F.col("_e.dimension").alias("dimension"), F.col("_e.value").alias("value")
    )


def _scaled(features: DataFrame) -> DataFrame:
    """Vectors brought to length one; zero vectors stay."""
    name = vector_columns(features)[-1]

    def scale(v: Column) -> Column:
        norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x))
        return tx.let(norm, lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(v))

    return features.withColumn(name, tx.let(F.col(name).cast("array<double>"), scale))


def _mean_pair_distance(members: DataFrame, group: Sequence[str]) -> DataFrame:
    """Mean cosine distance over unordered pairs of vectors of any length, from sums: no pair is ever formed.

    With vectors scaled to length one, ``1 - (|sum v|^2 - sum |v|^2) / (m (m - 1))``; a zero vector counts as a member and adds nothing to the sums.
    ``members`` has the group columns and the vector.
    """
    begins_row = (F.coalesce("place", F.lit(0)) == 0).cast("long")
    square = F.col("value") * F.col("value")
    sums = (
        vector_entries(_scaled(members), *group)
        .groupBy(*group, "dimension")
        .agg(F.sum("value").alias("s"), F.sum(square).alias("sq"), F.sum(begins_row).alias("m"))
        .groupBy(*group)
        .agg(F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum("sq").alias("sq"), F.sum("m").alias("m"))
    )
    m, zero = F.col("m"), F.lit(0.0)
    mean = F.when(m > 1, 1 - (F.coalesce("ss", zero) - F.coalesce("sq", zero)) / (m * (m - 1))).otherwise(zero)
    return sums.select(*group, mean.alias("diversity"))


def pooled_diversity(ranked: DataFrame, features: DataFrame, ks: Sequence[int], limits: Limits = LIMITS) -> DataFrame:
    """``(k, diversity)`` over the distinct results of all queries together."""
    pool = ranked.groupBy("id").agg(F.min("rank").alias("best_rank"))
    members = features.join(carrier(ranked, limits)(pool), "id")
    return _mean_pair_distance(per_k(members, ks, "best_rank"), ["k"])


def list_diversity(ranked: DataFrame, features: DataFrame, ks: Sequence[int], limits: Limits = LIMITS) -> DataFrame:
    """``(query_id, k, diversity)`` within each result list."""
    members = features.join(carrier(ranked, limits)(ranked.select("query_id", "rank", "id")), "id")
    return _mean_pair_distance(per_k(members, ks), ["query_id", "k"])


def coverage(ranked: DataFrame, ks: Sequence[int], corpus_size: int) -> DataFrame:
    """``(k, catalog_coverage)``: share of the corpus that appears in at least one list."""
    pool = ranked.groupBy("id").agg(F.min("rank").alias("best_rank"))
    return per_k(pool, ks, "best_rank").groupBy("k").agg((F.count("*") / corpus_size).alias("catalog_coverage"))


def evaluate(
    ranked: DataFrame,
    papers: DataFrame,
    features: DataFrame,
    ks: Sequence[int],
    method: str,
    digits: int = METRIC_DIGITS,
    limits: Limits = LIMITS,
) -> DataFrame:
    """One row per K: ``method, k, num_queries, precision, precision_std, mrr, diversity, catalog_coverage``.

    ``features`` are unit vectors of the same method that produced ``ranked``. K without any usable query gives
    a row of nulls. ``ranked`` is read several times: pass a stored table.
    """
    spark = papers.sparkSession
    scores = query_scores(judge(ranked, with_primary_category(papers), limits), ks)
    means = scores.groupBy("k").agg(
        F.count("*").alias("num_queries"),
        F.avg("precision").alias("precision"),
        F.stddev_pop("precision").alias("precision_std"),
        F.avg("reciprocal_rank").alias("mrr"),
    )
    every_k = spark.createDataFrame([(k,) for k in ks], "k int")
    joined = (
        every_k.join(means, "k", "left")
        .join(pooled_diversity(ranked, features, ks, limits), "k", "left")
        .join(coverage(ranked, ks, papers.count()), "k", "left")
    )
    rounded = [F.round(m, digits).alias(m) for m in ("precision", "precision_std", "mrr")]
    return joined.select(
        F.lit(method).alias("method"),
        "k",
        F.coalesce("num_queries", F.lit(0)).alias("num_queries"),
        *rounded,
        F.round(F.coalesce("diversity", F.lit(0.0)), digits).alias("diversity"),
        F.round(F.coalesce("catalog_coverage", F.lit(0.0)), digits).alias("catalog_coverage"),
    )


def compare(
    runs: Mapping[str, tuple[DataFrame, DataFrame]],
    papers: DataFrame,
    ks: Sequence[int],
    digits: int = METRIC_DIGITS,
    limits: Limits = LIMITS,
) -> DataFrame:
    """``evaluate`` for several methods ``{name: (ranked, features)}`` on the same queries, one row per (method, k)."""
    rows = None
    for name, (ranked, features) in runs.items():
        one = evaluate(ranked, papers, features, ks, name, digits, limits)
        rows = one if rows is None else rows.unionByName(one)
    return rows


# The metrics that are compared side by side.
COMPARED = ("precision", "mrr", "diversity", "catalog_coverage")


def side_by_side(metrics: DataFrame, a: str, b: str) -> DataFrame:
    """``(k, metric, a, b, better)``: the larger value wins, equal ones tie; diversity adds its band per method."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in COMPARED]))
    tall = metrics.select("method", "k", pairs.alias("p")).select("method", "k", "p.*")

    def value(name: str) -> Column:
        return F.max(F.when(F.col("method") == name, F.col("value")))

    wide = tall.groupBy("k", "metric").agg(value(a).alias("a"), value(b).alias("b"))
    better = F.when(F.col("a") > F.col("b"), a).when(F.col("b") > F.col("a"), b).otherwise("Tie")
    is_diversity = F.col("metric") == "diversity"
    return wide.select(
        "k",
        "metric",
        "a",
        "b",
        better.alias("better"),
        F.when(is_diversity, diversity_band(F.col("a"))).alias("band_a"),
        F.when(is_diversity, diversity_band(F.col("b"))).alias("band_b"),
    )


def diversity_band(value: Column) -> Column:
    return (
        F.when(value < NARROW_BELOW, "near-duplicates")
        .when(value.between(*MODERATE), "moderate")
        .when(value > SCATTERED_ABOVE, "scattered")
        .otherwise("other")
    )
