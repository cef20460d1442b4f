"""Distinctive keywords per cluster, cluster sizes and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text as tx
from folioscope.functions.wordlists import VECTOR_STOP_WORDS
from folioscope.operators.carry import carrier
from folioscope.settings import CLUSTER_TERM_CAP, GLOBAL_TERM_CAP, KEYWORDS_PER_CLUSTER

# Placeholders for clusters without keywords.
SMALL_CLUSTER = "(small cluster)"
NO_KEYWORDS = "(keyword extraction failed)"


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    """``(cluster_id, size, share)``."""
    sizes = clusters.groupBy("cluster_id").agg(F.count("*").alias("size"))
    total = clusters.agg(F.count("*").alias("total")).scalar()
    return sizes.select("cluster_id", "size", (F.col("size") / total).alias("share"))


def _all_term_counts(papers: DataFrame, clusters: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """``(cluster_id, term, n)`` from raw title and abstract, clusters of one document left out."""
    usable = clusters.groupBy("cluster_id").agg(F.count("*").alias("size")).where("size >= 2").select("cluster_id")
    raw = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))
    # labels within the bound travel to the texts; beyond it only the counted words do, not the texts
    words = papers.select("id", tx.tokens(raw, stop_words).alias("words"))
    found = words.join(carrier(clusters)(clusters), "id").select("cluster_id", F.explode("words").alias("term"))
    counts = found.groupBy("cluster_id", "term").agg(F.count("*").alias("n"))
    # one row per cluster on the right side, after the texts have been reduced to counts
    return counts.join(carrier(usable)(usable), "cluster_id", "left_semi")


def cluster_term_counts(
    papers: DataFrame,
    clusters: DataFrame,
    cap: int = CLUSTER_TERM_CAP,
    stop_words: Sequence[str] = VECTOR_STOP_WORDS,
) -> DataFrame:
    """The ``cap`` most frequent terms of each cluster, ties alphabetical."""
    return _top_per_cluster(_all_term_counts(papers, clusters, stop_words), cap)


def _top_per_cluster(counts: DataFrame, cap: int) -> DataFrame:
    """The rank limit is pushed below the shuffle, so each task sends at most ``cap`` terms per cluster."""
    by_count = Window.partitionBy("cluster_id").orderBy(F.desc("n"), "term")
    return counts.withColumn("r", F.row_number().over(by_count)).where(F.col("r") <= cap).drop("r")


def _top_global(counts: DataFrame, cap: int | None) -> DataFrame:
    totals = counts.groupBy("term").agg(F.sum("n").alias("global_n"))
    return totals.orderBy(F.desc("global_n"), "term").limit(cap) if cap else totals


def global_term_counts(
    papers: DataFrame,
    clusters: DataFrame,
    cap: int | None = GLOBAL_TERM_CAP,
    stop_words: Sequence[str] = VECTOR_STOP_WORDS,
) -> DataFrame:
    """The ``cap`` most frequent terms over the documents of all counted clusters (None keeps every term)."""
    return _top_global(_all_term_counts(papers, clusters, stop_words), cap)


def keyword_scores(
    papers: DataFrame,
    clusters: DataFrame,
    exact_global: bool = True,
    stop_words: Sequence[str] = VECTOR_STOP_WORDS,
    cluster_cap: int = CLUSTER_TERM_CAP,
    global_cap: int = GLOBAL_TERM_CAP,
) -> DataFrame:
    """``(cluster_id, term, n, score)`` with ``score = n / (global_n + 1)``.

    With ``exact_global=False`` the global counts are capped, and a term outside the capped list counts as global 1
    and so outscores listed ones.
    """
    counts = _all_term_counts(papers, clusters, stop_words)
    top = _top_per_cluster(counts, cluster_cap)
    scored = top.join(_top_global(counts, None if exact_global else global_cap), "term", "left")
    score = F.col("n") / (F.coalesce("global_n", F.lit(1)) + 1)
    return scored.select("cluster_id", "term", "n", score.alias("score"))


def cluster_keywords(
    papers: DataFrame,
    clusters: DataFrame,
    top_n: int = KEYWORDS_PER_CLUSTER,
    **options,
) -> DataFrame:
    """``(cluster_id, keywords)``, best first, ties alphabetical, with placeholders where nothing can be said."""
    scores = keyword_scores(papers, clusters, **options)
    best_first = Window.partitionBy("cluster_id").orderBy(F.desc("score"), "term")
    best = scores.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top_n)
    lists = best.groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_ranked"))
    sizes = clusters.groupBy("cluster_id").agg(F.count("*").alias("size"))
    fallback = F.when(F.col("size") < 2, F.lit(SMALL_CLUSTER)).otherwise(F.lit(NO_KEYWORDS))
    return sizes.join(lists, "cluster_id", "left").select(
        "cluster_id", F.coalesce(F.col("_ranked.term"), F.array(fallback)).alias("keywords")
    )


def cluster_of_papers(ids: DataFrame, clusters: DataFrame, keywords: DataFrame) -> DataFrame:
    """``(id, cluster_id, keywords)`` for the asked ids, nulls where the id is unknown."""
    found = ids.select("id").join(clusters.select("id", "cluster_id"), "id", "left")
    return found.join(carrier(keywords)(keywords), "cluster_id", "left").select("id", "cluster_id", "keywords")


def keyword_labels(keywords: DataFrame, n: int = 4) -> DataFrame:
    """``(cluster_id, label)``: the first ``n`` keywords, or the cluster's number."""
    named = F.concat(F.lit("Cluster "), F.col("cluster_id").cast("string"))
    return keywords.select("cluster_id", tx.keyword_label("keywords", n, named).alias("label"))
