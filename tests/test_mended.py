"""File order, repeated ids, vectors of any length, lemmas of very long words, scratch folders."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from folioscope.operators import blocks, cleaning, clustering, evaluation, features, kmeans, similarity
from folioscope.plans.prepare import PrepareConfig, prepare
from folioscope.sources.papers import head, load_papers


def test_rows_follow_the_order_of_files(spark, tmp_path):
    for name, n in (("a", 5), ("b", 500), ("c", 20)):
        lines = [f'{{"id":"{name}{i}","title":"t","abstract":"x"}}' for i in range(n)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines))
    papers = load_papers(spark, str(tmp_path))
    assert [r.id for r in papers.orderBy("seq").collect()] == [f"{k}{i}" for k, n in (("a", 5), ("b", 500), ("c", 20)) for i in range(n)]
    assert [r.id for r in head(papers, 7).orderBy("seq").collect()] == ["a0", "a1", "a2", "a3", "a4", "b0", "b1"]


def test_diversity_does_not_depend_on_length(spark):
    rows = spark.createDataFrame([("a", [2.0, 0.0]), ("b", [5.0, 0.0]), ("c", [0.0, 0.5]), ("d", [0.0, 0.0])], "id string, embedding array<double>")
    ranked = spark.createDataFrame([("q", 1, "a"), ("q", 2, "b"), ("q", 3, "c"), ("q", 4, "d")], "query_id string, rank int, id string")
    got = {r.k: r.diversity for r in evaluation.pooled_diversity(ranked, rows, [2, 3, 4]).collect()}
    assert got == pytest.approx({2: 0.0, 3: 2 / 3, 4: 5 / 6})


def test_reloaded_model_keeps_its_settings(spark, tmp_path):
    docs = spark.createDataFrame([("a", 1, "alpha the gamma the"), ("b", 2, "the beta alpha")], "id string, seq long, final_text string")
    model = features.fit_tfidf(docs, stop_words=("alpha",), ngram_max=1)
    assert model.terms == ["beta", "gamma", "the"]
    features.write_model(model, str(tmp_path))
    again = features.read_model(spark, str(tmp_path))
    assert again.transform(docs).collect() == model.transform(docs).collect()


def test_many_sparse_queries_are_scored_in_halves(monkeypatch):
    rng = np.random.default_rng(0)
    index = [np.sort(rng.choice(50, 6, replace=False)) for _ in range(9)]
    rows = blocks.Rows(np.arange(9), np.arange(9), rng.random(54), np.full(9, 6), np.concatenate(index))
    whole = blocks.Scorer(rows)(rows)
    monkeypatch.setattr(blocks, "STEP", 60)
    scorer = blocks.Scorer(rows)
    assert scorer.halves and np.allclose(scorer(rows), whole)


def test_one_long_list_leaves_the_others_short(spark, monkeypatch):
    papers = spark.createDataFrame([(str(i), f"t{i}", "x", "a", "c", i) for i in range(300)], "id string, title string, abstract string, authors string, categories string, seq long")
    rng = np.random.default_rng(1)
    vectors = spark.createDataFrame([(str(i), i, rng.random(4).tolist()) for i in range(300)], "id string, seq long, embedding array<double>")
    asked, plain = [], similarity.topk
    monkeypatch.setattr(similarity, "topk", lambda f, q, k, limits: asked.append((q.count(), k)) or plain(f, q, k, limits))
    requests = spark.createDataFrame([(1, "3", "4"), (2, "5", "1000000"), (3, "7", "6"), (4, "nobody", "2")], "request_id int, paper_id string, k string")
    got = similarity.answer_requests(requests, papers, vectors).groupBy("request_id").count().collect()
    assert {r.request_id: r["count"] for r in got} == {1: 4, 2: 299, 3: 6, 4: 1} and sorted(asked) == [(1, 300), (2, 6)]


def test_starting_rows_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    rows = [(str(i), i, [float(i % 3) * 10 + rng.random(), rng.random()]) for i in range(600)]
    points = spark.createDataFrame(rows, "id string, seq long, embedding array<double>")
    starts = [kmeans._start_rows(p, 3, 42) for p in (points.coalesce(1), points.repartition(7))]
    assert (starts[0][0] == starts[1][0]).all() and starts[0][1].sum() == 600 and len(starts[0][0]) == 1 + 4 * 100
    same = spark.createDataFrame([(str(i), i, [1.0, 2.0]) for i in range(5)], points.schema)
    assert kmeans.kmeans(same, 2, restarts=2)[0].count() == 5


def test_lemma_of_a_very_long_word(spark):
    forms = spark.createDataFrame([("x" * 60_000 + "s", 1), ("papers", 2), ("paper", 3), ("bosses", 1), ("boss", 1)], "form string, n long")
    cleaning.lemma_map(forms.limit(2)).collect()
    start = time.time()
    got = {r.form: r.lemma for r in cleaning.lemma_map(forms).collect()}
    assert got == {"papers": "paper", "bosses": "boss"} and time.time() - start < 10


def test_preparation_takes_every_row_and_the_last_of_an_id(spark, tmp_path):
    assert PrepareConfig().corpus_cap is None
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows = [(str(i % 20), f"{words[i % 6]} {words[i // 6]} star", f"{words[i % 5]} field {words[i % 4]}", "cs.AI", "", i) for i in range(30)]
    papers = spark.createDataFrame(rows, "id string, title string, abstract string, categories string, authors string, seq long")
    config = PrepareConfig(eval_queries=5, top_k=3, svd_components=3, n_clusters=2, restarts=1)
    assert prepare(spark, papers, f"{tmp_path}/out", config).first().papers == 20
    kept = spark.read.parquet(f"{tmp_path}/out/papers")
    assert sorted(r.seq for r in kept.select("seq").collect()) == list(range(10, 30))
    assert kept.where(F.col("id") == "3").first().seq == 23
    with pytest.raises(ValueError, match="other settings"):
        prepare(spark, papers, f"{tmp_path}/out", PrepareConfig(eval_queries=5, top_k=4, svd_components=3, n_clusters=2, restarts=1))


def test_a_sweep_reads_its_points_a_few_times(spark):
    rng = np.random.default_rng(7)
    rows = [(str(i), i, (rng.standard_normal(6) + i % 2).tolist()) for i in range(400)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    points = spark.createDataFrame(rows, "id string, seq long, embedding array<double>").mapInArrow(counted, "id string, seq long, embedding array<double>")
    sweep = clustering.k_sweep(points, 3, 8, restarts=3).orderBy("k").collect()
    assert [r.k for r in sweep] == list(range(3, 9)) and read.value <= 8 * 400


def test_silhouettes_of_a_sweep_are_those_of_each_labeling(spark):
    rng = np.random.default_rng(8)
    x, ks = rng.standard_normal((300, 5)) + 3, [2, 4, 7]
    labels = np.stack([rng.integers(0, k, 300) for k in ks], axis=1)
    labels[:, 2] = np.where(labels[:, 2] == 5, 4, labels[:, 2])
    labels[0, 2] = 5
    rows = [(str(i), i, x[i].tolist(), labels[i].tolist()) for i in range(300)]
    table = spark.createDataFrame(rows, "id string, seq long, embedding array<double>, labels array<int>").repartition(3)
    for i, value in enumerate(clustering._squared_silhouettes(table, ks)):
        vectors = table.select(F.get("labels", F.lit(i)).alias("cluster_id"), array_to_vector("embedding").alias("features"))
        assert value == pytest.approx(clustering.silhouette_linear(vectors))


def test_of_equally_near_centers_the_first_one_gets_the_row():
    centers = np.array([[5.0, 0.0], [1.0, 0.0], [-1.0, 0.0], [1.0, 0.0]])
    nearest = kmeans._Nearest([centers, centers[::-1]])
    nearest.add(np.array([[0.0, 2.0], [1.0, 1.0], [4.0, 0.0]]), costs=True)
    assert nearest.total[:, -2].tolist() == [1, 2, 0, 0, 2, 0, 0, 1]
    assert nearest.total[:, -1].tolist() == [1, 6, 0, 0, 6, 0, 0, 1]
