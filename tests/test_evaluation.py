from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.operators import evaluation
from folioscope.settings import Limits

CATEGORIES = {"q": "a x", "p": "b", "n": None, "e": "", "r1": "b", "r2": "a", "r3": "a z", "r4": None, "r5": ""}
RANKED = (
    [("q", i, f"r{i}") for i in range(1, 6)]
    + [("p", i, f"r{i + 1}") for i in range(1, 3)]
    + [("n", 1, "r4"), ("e", 1, "r5"), ("gone", 1, "r1")]
)


@pytest.fixture(scope="module")
def papers(spark):
    return spark.createDataFrame(list(CATEGORIES.items()), "id string, categories string")


@pytest.fixture(scope="module")
def ranked(spark):
    return spark.createDataFrame(RANKED, "query_id string, rank int, id string")


VECTORS = {"r1": [1.0, 0.0], "r2": [0.6, 0.8], "r3": [0.0, 1.0], "r4": [0.0, 0.0], "r5": [-1.0, 0.0]}


@pytest.fixture(scope="module")
def features(spark):
    rows = [(i, n, v) for n, (i, v) in enumerate(VECTORS.items())]
    return spark.createDataFrame(rows, "id string, seq long, embedding array<double>")


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0)], ids=["broadcast", "shuffle"])
def test_scores_per_query(papers, ranked, limits):
    judged = evaluation.judge(ranked, evaluation.with_primary_category(papers), limits)
    rows = {(r.query_id, r.k): (r.precision, r.reciprocal_rank) for r in evaluation.query_scores(judged, [1, 5]).collect()}
    assert rows == {
        ("q", 1): (0.0, 0.0),
        ("q", 5): (0.4, 0.5),
        ("p", 1): (0.0, 0.0),
        ("p", 5): (0.0, 0.0),
        ("n", 1): (1.0, 1.0),
        ("n", 5): (0.2, 1.0),
        ("e", 1): (0.0, 0.0),
        ("e", 5): (0.0, 0.0),
    }


def mean_distance(ids):
    pairs = [1 - float(np.dot(VECTORS[a], VECTORS[b])) for a, b in combinations(ids, 2)]
    return sum(pairs) / len(pairs) if pairs else 0.0


def test_diversity_closed_form_equals_pairs(ranked, features):
    pooled = {r.k: r.diversity for r in evaluation.pooled_diversity(ranked, features, [1, 2, 5]).collect()}
    for k, value in pooled.items():
        assert value == pytest.approx(mean_distance({i for _, rank, i in RANKED if rank <= k}))
    assert set(pooled) == {1, 2, 5}
    listed = {r.query_id: r.diversity for r in evaluation.list_diversity(ranked, features, [5]).collect()}
    assert listed["q"] == pytest.approx(mean_distance([f"r{i}" for i in range(1, 6)]))
    assert listed["n"] == 0.0


def test_sparse_and_dense_diversity_agree(spark, ranked, features):
    sparse = features.select("id", F.array(F.lit(0), F.lit(1)).alias("term_idx"), F.col("embedding").alias("weight"))
    a = evaluation.pooled_diversity(ranked, sparse, [5]).first().diversity
    assert a == pytest.approx(evaluation.pooled_diversity(ranked, features, [5]).first().diversity)


def test_metrics_row(papers, ranked, features):
    row = evaluation.evaluate(ranked, papers, features, [5], "m").first()
    assert (row.method, row.k, row.num_queries) == ("m", 5, 4)
    values = np.array([0.4, 0.0, 0.2, 0.0])
    assert row.precision == pytest.approx(round(values.mean(), 4)) and row.precision_std == pytest.approx(round(values.std(), 4))
    assert row.mrr == pytest.approx(0.375)
    assert row.catalog_coverage == pytest.approx(round(5 / 9, 4))


def test_no_usable_query_gives_nulls(papers, ranked, features):
    row = evaluation.evaluate(ranked.limit(0), papers, features, [5], "m").first()
    assert row.num_queries == 0 and row.precision is None and row.mrr is None
    assert row.diversity == 0.0 and row.catalog_coverage == 0.0


def test_side_by_side(spark):
    rows = [("a", 5, 0.5, 0.2, 0.35, 0.1), ("b", 5, 0.4, 0.3, 0.9, 0.1)]
    metrics = spark.createDataFrame(rows, "method string, k int, precision double, mrr double, diversity double, catalog_coverage double")
    found = {r.metric: r for r in evaluation.side_by_side(metrics, "a", "b").collect()}
    assert {m: r.better for m, r in found.items()} == {"precision": "a", "mrr": "b", "diversity": "b", "catalog_coverage": "Tie"}
    assert (found["diversity"].band_a, found["diversity"].band_b) == ("other", "scattered")


@pytest.mark.parametrize("value, band", [(0.1, "near-duplicates"), (0.3, "other"), (0.4, "moderate"), (0.7, "moderate"), (0.75, "other"), (0.81, "scattered")])
def test_bands(spark, value, band):
    assert spark.range(1).select(evaluation.diversity_band(F.lit(value))).first()[0] == band


def test_precision_times_k_is_whole(corpus):
    judged = evaluation.judge(corpus.ranked("tfidf", 100, 10), evaluation.with_primary_category(corpus.papers))
    hits = [r.precision * 10 for r in evaluation.query_scores(judged, [10]).collect()]
    assert len(hits) == 100 and all(h == pytest.approx(round(h)) for h in hits)


def test_query_sample(corpus):
    ids = [r.query_id for r in evaluation.sample_queries(corpus.papers, 1000).collect()]
    assert len(ids) == len(set(ids)) == corpus.papers.count()
    assert [r.query_id for r in evaluation.sample_queries(corpus.papers, 5).collect()] == ids[:5]
