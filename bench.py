"""Times the headline jobs and prints one JSON line.

``BENCH_SF_DIR`` names the table directory, ``BENCH_CPUS`` the local cores. Every job runs whole: its result is
counted or written, and stages it builds on are stored before its clock starts. The first pass over the text warms
the session up and is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from folioscope.operators import cleaning, clustering, evaluation, features, keywords, kmeans, similarity  # noqa: E402
from folioscope.plans.workspace import Workspace  # noqa: E402
from folioscope.session import build_session  # noqa: E402
from folioscope.settings import SWEEP_KS  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    out = tempfile.mkdtemp(prefix="bench-")
    w = Workspace.of(spark, sf_dir)
    seconds: dict[str, float] = {}

    def timed(name: str, job: Callable[[], object]) -> object:
        start = time.perf_counter()
        result = job()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    def written(name: str, build: Callable[[], object]):
        """Time a build and its write; hand back the stored table."""
        timed(name, lambda: build().write.mode("overwrite").parquet(f"{out}/{name}"))
        return spark.read.parquet(f"{out}/{name}")

    def done(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    done(cleaning.strip_markup(w.spread_papers))

    lemmas = written("lemma_map", lambda: cleaning.corpus_lemma_map(w.spread_papers))
    clean = written("clean_corpus", lambda: cleaning.preprocess(w.spread_papers, lemmas))
    model = timed("tfidf_fit", lambda: features.fit_tfidf(clean))
    tfidf = written("tfidf_transform", lambda: model.transform(clean))
    dense = written("hash_embed", lambda: features.hash_embed(clean))

    for n in (1, 100, 200):
        queries = w.queries(n)
        timed(f"recommend_top10_{n}", lambda: done(similarity.recommend_many(w.papers, tfidf, queries)))
    one = w.queries(1).first()[0]
    runs = []
    for _ in range(4):  # the first warms up
        start = time.perf_counter()
        done(similarity.recommend(w.papers, tfidf, one))
        runs.append(time.perf_counter() - start)
    seconds["recommend_one_id"] = round(sorted(runs[1:])[1], 3)
    queries = w.queries(200)
    timed("recommend_dense_top10_200", lambda: done(similarity.recommend_many(w.papers, dense, queries)))
    timed("similar_vectors_top10_100", lambda: done(similarity.topk(w.vectors, w.vector_queries(), 10)))

    ranked = written("rank_top20_200", lambda: similarity.topk(tfidf, queries, max(SWEEP_KS)))
    timed("metrics_k_5_10_20", lambda: done(evaluation.evaluate(ranked, w.papers, tfidf, SWEEP_KS, "tfidf")))
    timed("cluster_keywords", lambda: done(keywords.cluster_keywords(w.spread_papers, w.lang_clusters)))

    width = len(model.terms)
    reduced = written("svd_100", lambda: clustering.truncated_svd(tfidf, width, 100)[0])
    timed("kmeans_17_10_restarts", lambda: done(kmeans.kmeans(reduced, 17)[0]))
    labels, _ = kmeans.kmeans(reduced, 17, restarts=1)
    labels = written("kmeans_17_labels", lambda: labels)
    timed("silhouette_exact", lambda: done(clustering.silhouette(reduced, labels)))

    total = round(sum(seconds.values()), 3)
    line = {"metric": "total_time", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
