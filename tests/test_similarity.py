from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.operators import similarity
from folioscope.operators.blocks import Rows
from folioscope.settings import Limits

BLOCKS = Limits(block_entries=60)


def sparse_rows(spark, rng, n=60, width=30):
    rows = []
    for i in range(n):
        size = int(rng.integers(0, 6))
        where = sorted(rng.choice(width, size, replace=False).tolist())
        rows.append((f"d{i}", i, where, rng.random(size).round(1).tolist()))
    rows.append(("copy", n, rows[3][2], rows[3][3]))
    return spark.createDataFrame(rows, "id string, seq long, term_idx array<int>, weight array<double>"), rows


def brute_force(ids, seqs, matrix, queries, k):
    norm = np.linalg.norm(matrix, axis=1)
    unit = matrix / np.where(norm > 0, norm, 1)[:, None]
    out = {}
    for q in queries:
        scores = unit @ unit[ids.index(q)]
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-round(scores[i], 6), seqs[i]))
        out[q] = [(ids[i], round(float(scores[i]), 6)) for i in order[:k]]
    return out


def lists(ranked):
    out = {}
    for r in ranked.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.id, round(r.score, 6) + 0.0))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("limits", [Limits(), BLOCKS], ids=["broadcast", "blocks"])
@pytest.mark.parametrize("k", [1, 7, 500])
def test_sparse_topk_equals_brute_force(spark, limits, k):
    features, rows = sparse_rows(spark, np.random.default_rng(1))
    matrix = np.zeros((len(rows), 30))
    for i, row in enumerate(rows):
        matrix[i, row[2]] = row[3]
    ids = [r[0] for r in rows]
    asked = ids if limits is BLOCKS else ids[:20] + ["copy"]
    queries = spark.createDataFrame([(q,) for q in [*asked, asked[0], "unknown"]], "query_id string")
    found = lists(similarity.topk(features.repartition(5), queries, k, limits))
    assert found == brute_force(ids, [r[1] for r in rows], matrix, asked, k)


@pytest.mark.parametrize("limits", [Limits(), BLOCKS], ids=["broadcast", "blocks"])
def test_dense_topk_equals_brute_force(spark, limits):
    rng = np.random.default_rng(2)
    matrix = rng.standard_normal((50, 6)).round(2)
    matrix[7] = 0
    rows = [(f"v{i}", i, row.tolist()) for i, row in enumerate(matrix)]
    features = spark.createDataFrame(rows, "id string, seq long, embedding array<double>")
    ids = [r[0] for r in rows]
    queries = spark.createDataFrame([(q,) for q in ids], "query_id string")
    found = lists(similarity.topk(features, queries, 4, limits))
    assert found == brute_force(ids, range(50), matrix, ids, 4)


def test_copy_ranks_first_and_query_is_absent(spark):
    features, rows = sparse_rows(spark, np.random.default_rng(1))
    query = spark.createDataFrame([("d3",)], "query_id string")
    found = lists(similarity.topk(features, query, 100))["d3"]
    assert found[0] == ("copy", 1.0) and len(found) == len(rows) - 1
    assert "d3" not in [i for i, _ in found]


def test_k_zero_and_negative(spark):
    features, _ = sparse_rows(spark, np.random.default_rng(1))
    query = spark.createDataFrame([("d3",)], "query_id string")
    assert similarity.topk(features, query, 0).count() == 0
    with pytest.raises(ValueError):
        similarity.topk(features, query, -1)


def test_feature_layouts_are_told_apart(spark):
    with pytest.raises(ValueError):
        similarity.topk(spark.range(2).withColumn("seq", F.col("id")), spark.range(1).select(F.col("id").alias("query_id")))


def test_unknown_paper_is_an_error(spark, corpus):
    with pytest.raises(ValueError, match="not found"):
        similarity.recommend(corpus.papers, corpus.tfidf, "nope")


def test_requested_k(spark):
    given = ["5", "x", "1.5", None, " +7 ", "-3", "0", "1_0", "", "99999999999999999999", "-99999999999999999999", "5 5"]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(given)], "i int, k string")
    found = [r.k for r in df.select("i", similarity.requested_k("k").alias("k")).orderBy("i").collect()]
    assert found == [5, 10, 10, 10, 7, 0, 0, 10, 10, 2**62, 0, 10]


def test_requests(spark, corpus):
    requests = spark.createDataFrame(
        [(1, "7", "2"), (2, "7", "x"), (3, "none", "5"), (4, "7", "0"), (5, "8", "100000"), (6, "7", "2")],
        "request_id long, paper_id string, k string",
    )
    rows = similarity.answer_requests(requests, corpus.papers, corpus.tfidf).collect()
    sizes = {i: [r for r in rows if r.request_id == i] for i in range(1, 7)}
    assert {i: len(r) for i, r in sizes.items()} == {1: 2, 2: 10, 3: 1, 4: 1, 5: corpus.papers.count() - 1, 6: 2}
    assert sizes[3][0].status == "error" and "none" in sizes[3][0].message and sizes[3][0].id is None
    assert sizes[4][0].status == "ok" and sizes[4][0].id is None
    assert {r.message for i in (1, 2, 4, 5, 6) for r in sizes[i]} == {None}


def test_scores_fall_with_rank_and_stay_in_range(spark, corpus):
    ranked = corpus.ranked("tfidf", 100, 10).orderBy("query_id", "rank").collect()
    for a, b in zip(ranked, ranked[1:]):
        assert -1e-9 <= a.score <= 1 + 1e-9 and a.query_id != a.id
        if a.query_id == b.query_id:
            assert round(a.score, 6) >= round(b.score, 6)


def test_only_candidates_are_shuffled(spark, corpus):
    ranked = similarity.topk(corpus.tfidf, corpus.queries(), 10)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    # natural splits, and two exchanges of candidates: within salted parts, then whole
    assert plan.count("Exchange") == 2 and plan.count("hashpartitioning(query_id") == 2 and "Coalesce" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.index("MapInArrow") > plan.index("Exchange") > plan.index("Window")


def test_metadata_join_broadcasts_the_results(spark, corpus):
    plan = similarity.recommend_many(corpus.papers, corpus.tfidf, corpus.queries())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("pushed", [0, 1_000])
def test_recommend_one(spark, corpus, monkeypatch, pushed):
    monkeypatch.setattr(similarity, "PUSHED_IDS", pushed)
    found = similarity.recommend(corpus.papers, corpus.tfidf, "7", 4).collect()
    query = spark.createDataFrame([("7",)], "query_id string")
    many = similarity.recommend_many(corpus.papers, corpus.tfidf, query, 4).orderBy("rank").collect()
    assert found == many and [r.rank for r in found] == [1, 2, 3, 4]
    assert similarity.recommend(corpus.papers, corpus.tfidf, "7", 0).collect() == []


def test_recommend_one_filters_the_paper_scan(corpus, tmp_path):
    corpus.papers.write.parquet(str(tmp_path / "papers"))
    papers = corpus.spark.read.parquet(str(tmp_path / "papers"))
    plan = similarity.recommend(papers, corpus.tfidf, "7", 4)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(id" in plan


def test_lists_by_tiles_take_little_time_and_keep_all_other_rows():
    """Of many rows with a query's id none takes a place from another row; a list costs about what its products cost."""
    rng = np.random.default_rng(3)
    values = rng.normal(size=(3000, 16))
    values[5:9] = values[4]
    values[100] = np.nan
    ids = np.array([str(i // 4) for i in range(3000)], object)
    order = rng.permutation(3000)
    rows = Rows(ids[order], order.astype(np.int64), values[order], np.full(3000, 16)).unit()
    asked = Rows(np.array([str(i) for i in range(750)], object), np.arange(0, 3000, 4), values[::4], np.full(750, 16)).unit()
    best = similarity._Best(asked, 5)
    for start in range(0, 3000, 1000):
        best.add(rows.part(start, start + 1000))
    scores = np.nan_to_num(asked.value @ rows.value.T, nan=-np.inf)
    for i in rng.choice(750, 60, replace=False):
        other = np.flatnonzero((rows.ids != asked.ids[i]) & np.isfinite(scores[i]))
        wanted = other[np.lexsort((rows.seq[other], -np.rint(scores[i, other] * 1e6)))][:5]
        assert best.seq[i][np.isfinite(best.score[i])].tolist() == rows.seq[wanted].tolist()
    many = Rows(np.array([f"x{i}" for i in range(8000)], object), np.arange(8000), rng.normal(size=(8000, 64)), np.full(8000, 64)).unit()
    best, start = similarity._Best(many, 5), time.perf_counter()
    best.add(many)
    # 64 million pairs; the sorting of all scores took 7 seconds
    assert time.perf_counter() - start < 4
