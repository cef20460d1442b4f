from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.functions.sampling import sample_key
from folioscope.operators import clustering, keywords, kmeans, landscape
from folioscope.operators.blocks import Rows
from folioscope.schemas import SEQUENCED_PAPER
from folioscope.settings import Limits


def points_of(spark, matrix):
    rows = [(f"p{i}", i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id string, seq long, embedding array<double>").repartition(4, "seq")


def labels_of(spark, labels):
    return spark.createDataFrame([(f"p{i}", int(c)) for i, c in enumerate(labels)], "id string, cluster_id int")


def matrix_of(df):
    return np.array([r.embedding for r in df.orderBy("seq").collect()])


def test_svd_recovers_a_low_rank_matrix(spark):
    rng = np.random.default_rng(0)
    a = rng.standard_normal((80, 5)) @ rng.standard_normal((5, 20))
    reduced, values, v = clustering.truncated_svd(points_of(spark, a), 20, components=5)
    assert values == pytest.approx(np.linalg.svd(a, compute_uv=False)[:5])
    assert v.T @ v == pytest.approx(np.eye(5), abs=1e-8)
    us = matrix_of(reduced)
    assert us @ v.T == pytest.approx(a, abs=1e-6)
    assert np.linalg.norm(us, axis=0) == pytest.approx(values)
    assert (v[np.abs(v).argmax(axis=0), range(5)] > 0).all()


def test_svd_of_sparse_rows_keeps_every_document(corpus):
    reduced, values, v = clustering.truncated_svd(corpus.tfidf, len(corpus.model.terms), 4)
    us = matrix_of(reduced)
    assert us.shape == (corpus.papers.count(), 4)
    assert (np.diff(values) <= 1e-9).all() and (np.square(us).sum(axis=1) <= 1 + 1e-6).all()
    dense = np.zeros((len(us), len(corpus.model.terms)))
    for i, row in enumerate(corpus.tfidf.orderBy("seq").collect()):
        dense[i, row.term_idx] = row.weight
    assert values == pytest.approx(np.linalg.svd(dense, compute_uv=False)[:4], rel=1e-2)
    assert dense @ v == pytest.approx(us, abs=1e-9)
    again, values2, _ = clustering.truncated_svd(corpus.tfidf, len(corpus.model.terms), 4)
    assert values2 == pytest.approx(values) and matrix_of(again) == pytest.approx(us, abs=1e-6)


BLOBS = np.concatenate([np.random.default_rng(3).normal(m, 0.3, (25, 3)) for m in (0, 4, 9)])


def test_kmeans_finds_blobs_and_nearest_centroids(spark):
    points = points_of(spark, BLOBS)
    clusters, centroids = kmeans.kmeans(points, 3, restarts=4)
    found = {r.id: r.cluster_id for r in clusters.collect()}
    assert [len({found[f"p{i}"] for i in range(s, s + 25)}) for s in (0, 25, 50)] == [1, 1, 1]
    nearest = {r.id: (r.cluster_id, r.distance2) for r in clustering.nearest_centroid(points, centroids).collect()}
    assert {i: c for i, (c, _) in nearest.items()} == found
    total = clustering.inertia(points, clusters, centroids).first().inertia
    assert total == pytest.approx(sum(d for _, d in nearest.values()))
    again, _ = kmeans.kmeans(points, 3, restarts=4)
    assert {r.id: r.cluster_id for r in again.collect()} == found


def brute_silhouette(x, labels):
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    out = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, mine].sum() / (mine.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) if c != own)
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("limits", [Limits(), Limits(block_entries=70)], ids=["broadcast", "blocks"])
def test_silhouette_equals_brute_force(spark, limits):
    labels = np.array([i % 4 for i in range(74)] + [9])
    values = clustering.silhouette_points(points_of(spark, BLOBS), labels_of(spark, labels), limits)
    found = {r.id: r.silhouette for r in values.collect()}
    assert [found[f"p{i}"] for i in range(75)] == pytest.approx(brute_silhouette(BLOBS, labels))
    assert found["p74"] == 0.0


def test_k_sweep_picks_the_blobs(spark):
    points = points_of(spark, BLOBS)
    sweep = clustering.k_sweep(points, 2, 5, restarts=3, exact=True)
    rows = sweep.orderBy("k").collect()
    assert clustering.best_k(sweep) == 3 and {r.metric for r in rows} == {"euclidean"}
    for row in rows:
        labels = {r.id: r.cluster_id for r in kmeans.kmeans(points, row.k, restarts=3)[0].collect()}
        whole = brute_silhouette(BLOBS, np.array([labels[f"p{i}"] for i in range(75)]))
        assert row.silhouette == pytest.approx(whole.mean())
    assert all(a.inertia >= b.inertia * 0.98 for a, b in zip(rows, rows[1:]))
    blocks = clustering.k_sweep(points, 2, 5, restarts=3, exact=True, limits=Limits(block_entries=70)).orderBy("k").collect()
    assert [r.silhouette for r in blocks] == pytest.approx([r.silhouette for r in rows])
    linear = clustering.k_sweep(points, 3, 3, restarts=1).first()
    assert linear.metric == "squared_euclidean" and linear.silhouette > rows[1].silhouette


def test_best_k_prefers_the_smaller_on_a_tie(spark):
    sweep = spark.createDataFrame([(5, 1.0, 0.4), (4, 2.0, 0.4), (3, 3.0, 0.1)], "k int, inertia double, silhouette double")
    assert clustering.best_k(sweep) == 4


def keyword_case(spark):
    texts = ["rare rare common", "common thing", "common second", "second common", "lonely words", "the of", "and 1 2"]
    clusters = [0, 0, 1, 1, 2, 3, 3]
    papers = spark.createDataFrame([(f"p{i}", t, None, "", "", i) for i, t in enumerate(texts)], SEQUENCED_PAPER)
    return papers, labels_of(spark, clusters)


def test_keywords_and_placeholders(spark):
    papers, clusters = keyword_case(spark)
    found = {r.cluster_id: r.keywords for r in keywords.cluster_keywords(papers, clusters).collect()}
    assert found == {
        0: ["rare", "thing", "common"],
        1: ["second", "common"],
        2: ["(small cluster)"],
        3: ["(keyword extraction failed)"],
    }


def test_terms_outside_the_global_list_count_as_one(spark):
    papers, clusters = keyword_case(spark)
    capped = {(r.cluster_id, r.term): r.score for r in keywords.keyword_scores(papers, clusters, exact_global=False, global_cap=1).collect()}
    assert capped[(0, "rare")] == 1.0 and capped[(0, "common")] == pytest.approx(2 / 5) and capped[(1, "second")] == 1.0
    exact = {(r.cluster_id, r.term): r.score for r in keywords.keyword_scores(papers, clusters, exact_global=True, global_cap=1).collect()}
    assert exact[(0, "rare")] == pytest.approx(2 / 3)


def test_cluster_term_cap_is_pushed_below_the_shuffle(spark):
    papers, clusters = keyword_case(spark)
    plan = keywords.cluster_term_counts(papers, clusters)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_cluster_of_unknown_paper(spark):
    _, clusters = keyword_case(spark)
    words = spark.createDataFrame([(0, ["a"])], "cluster_id int, keywords array<string>")
    ids = spark.createDataFrame([("p0",), ("p2",), ("zz",)], "id string")
    found = {r.id: (r.cluster_id, r.keywords) for r in keywords.cluster_of_papers(ids, clusters, words).collect()}
    assert found == {"p0": (0, ["a"]), "p2": (1, None), "zz": (None, None)}


def test_quotas_are_exact(spark):
    clusters = spark.range(3000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") < 2990, 0).when(F.col("id") < 2999, 1).otherwise(2).alias("cluster_id"),
    )
    plain = landscape.stratified_sample(clusters)
    sizes = {r.cluster_id: r["count"] for r in plain.groupBy("cluster_id").count().collect()}
    assert sizes == {0: 1495, 1: 4, 2: 1}
    outside = clusters.join(plain, "id", "left_anti").first().id
    assert landscape.stratified_sample(clusters, highlight=outside).count() == 1501
    assert landscape.stratified_sample(clusters, max_points=3000).count() == 3000
    first = {r.id for r in clusters.where("cluster_id = 0").orderBy(sample_key(42), "id").limit(1495).collect()}
    assert {r.id for r in plain.where("cluster_id = 0").collect()} == first


def test_viewport(spark):
    points = spark.createDataFrame([("a", 0.0, 5.0), ("b", 10.0, 5.0)], "id string, x double, y double")
    rows = {r.id: r for r in landscape.viewport(points).collect()}
    assert rows["a"].cx == pytest.approx(60 + 0.5 / 11 * 720) and rows["b"].cx == pytest.approx(60 + 10.5 / 11 * 720)
    assert rows["a"].cy == rows["b"].cy == pytest.approx(40 + 0.5 * 440)


def test_map_points(spark):
    clusters = labels_of(spark, [0, 0, 21])
    coords = spark.createDataFrame([("p0", 0.0, 0.0), ("p1", 1.0, 1.0), ("p2", 2.0, 2.0)], "id string, x double, y double")
    words = spark.createDataFrame([(0, list("abcdef"))], "cluster_id int, keywords array<string>")
    found = landscape.map_points(clusters, coords, words, highlight="p2")
    rows = {r.id: r for r in found.collect()}
    assert rows["p0"].label == "a, b, c, d" and rows["p2"].label == "Cluster 21"
    assert rows["p2"].color_idx == 1 and rows["p2"].highlighted and not rows["p0"].highlighted
    assert {(r.shown, r.total) for r in rows.values()} == {(3, 3)}
    assert landscape.map_note(found).first().note == "Showing 3 of 3 papers"


def test_silhouettes_of_labelings_over_several_tiles_equal_brute_force(spark):
    """More points than a tile holds, one cluster of one point, and a place that two rows share."""
    n = clustering.OTHERS + 300
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, 2))
    x[7] = x[8]
    labels = np.stack([rng.integers(0, 3, n), np.arange(n) == 5], axis=1).astype(int)
    rows = [(str(i), i, x[i].tolist(), labels[i].tolist()) for i in range(n)]
    table = spark.createDataFrame(rows, "id string, seq long, embedding array<double>, labels array<int>").repartition(3)
    gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for got, own in zip(clustering._silhouettes_of_labelings(table, 2), labels.T):
        size = np.bincount(own)
        totals = np.stack([gaps[:, own == c].sum(axis=1) for c in range(len(size))], axis=1)
        a = totals[np.arange(n), own] / np.maximum(size[own] - 1, 1)
        means = totals / size
        means[np.arange(n), own] = np.inf
        b = means.min(axis=1)
        wanted = np.where(size[own] > 1, (b - a) / np.maximum(a, b), 0.0).mean()
        assert abs(got - wanted) < 1e-9


@pytest.mark.parametrize("grouped", [1, 10**9], ids=["by run", "by point"])
def test_silhouettes_beyond_the_bound_meet_part_by_part(spark, monkeypatch, grouped):
    """All labelings in one pass over the pairs, in many tasks, with the points shipped in several parts; repeated ids stay rows."""
    monkeypatch.setattr(clustering, "PAIRS", 20_000)
    monkeypatch.setattr(clustering, "OTHERS", 64)
    monkeypatch.setattr(clustering, "POINTS", 16)
    monkeypatch.setattr(clustering, "GROUPED", grouped)
    monkeypatch.setattr(clustering, "silhouette_points", lambda *_: pytest.fail("one labeling at a time"))
    rng, n = np.random.default_rng(8), 400
    x = np.concatenate([rng.normal(c, 1.0, size=(n // 4, 2)) for c in (0, 8, 16, 40)])
    labels = np.stack([np.arange(n) * 4 // n, rng.integers(0, 3, n)], axis=1)
    rows = [(str(i % 390), i, x[i].tolist(), labels[i].tolist()) for i in range(n)]
    table = spark.createDataFrame(rows, "id string, seq long, embedding array<double>, labels array<int>").cache()
    got = clustering._silhouettes_of_labelings(table, 2, Limits(block_entries=300))
    assert got == pytest.approx([brute_silhouette(x, own).mean() for own in labels.T], abs=1e-9)
    points = table.select("id", "seq", "embedding")
    sweep = clustering.k_sweep(points, 3, 4, restarts=2, exact=True, limits=Limits(block_entries=300)).orderBy("k").collect()
    assert len(sweep) == 2 and sweep[1].silhouette == pytest.approx(got[0])


@pytest.mark.parametrize("step", [40, 10_000])
def test_rare_dimensions_are_multiplied_by_entry(monkeypatch, step):
    """Sparse rows times a matrix and back: equal to the dense product, in few dense cells and without a copy for every row."""
    monkeypatch.setattr(clustering, "STEP", step)
    monkeypatch.setattr(clustering, "HEIGHT", 20)
    monkeypatch.setattr(clustering, "ENTRIES", 7)
    monkeypatch.setattr(clustering, "COMMON", 0.3)
    rng = np.random.default_rng(4)
    width, matrix = 300, rng.standard_normal((300, 3))
    chosen = [np.array([], int), *([0] * (i % 2) + sorted(rng.choice(np.arange(1, width), i % 6, replace=False).tolist()) for i in range(50))]
    length = np.array([len(c) for c in chosen])
    index = np.concatenate(chosen).astype(np.int64)
    rows = Rows(np.arange(51).astype(str), np.arange(51), rng.random(len(index)), length, index)
    whole = np.zeros((51, width))
    whole[np.repeat(np.arange(51), length), index] = rows.value
    total, products = np.zeros((width, 3)), []
    for part in clustering._parts(rows, width):
        assert part.dense.size <= 40 and set(part.common) <= {0}
        products.append(part.times(matrix))
        part.add_transposed_times(products[-1], total)
    assert np.concatenate(products) == pytest.approx(whole @ matrix)
    assert total == pytest.approx(whole.T @ (whole @ matrix))
    filled = Rows(np.arange(9), np.arange(9), rng.random(45), np.full(9, 5), np.tile(np.arange(5), 9))
    (only,) = clustering._parts(filled, 5) if step > 45 else (next(clustering._parts(filled, 5)),)
    assert not len(only.index) and only.dense.shape[1] == 5
    monkeypatch.setattr(clustering, "STEP", 51 * width)
    (few,) = clustering._parts(rows, width)
    assert not len(few.index) and few.common.tolist() == sorted(set(index.tolist()))
