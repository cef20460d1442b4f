from __future__ import annotations

import json
import time
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from compare import differences, duck
from folioscope.plans.prepare import PrepareConfig, prepare

SF = "/root/testdata/sf0.001"


def test_prepare_builds_once_and_reuses(spark, tmp_path):
    lines = []
    for i in range(40):
        subject = "black holes and horizons of gravity" if i % 2 else "neural networks with deep learning models"
        lines.append(json.dumps({"id": f"{i:04d}", "title": f"On {subject}", "abstract": f"We study {subject} {i % 7} times.", "categories": "gr-qc" if i % 2 else "cs.LG"}))
    (tmp_path / "raw.json").write_text("\n".join(lines) + "\n")
    config = PrepareConfig(corpus_cap=30, eval_queries=10, top_k=5, svd_components=4, k_min=2, k_max=3, restarts=2)
    out = str(tmp_path / "out")
    row = prepare(spark, str(tmp_path / "raw.json"), out, config).first()
    assert (row.papers, row.tfidf_rows, row.embedding_rows) == (30, 30, 30) and row.clusters in (2, 3)
    metrics = {r.method: r for r in spark.read.parquet(f"{out}/metrics").collect()}
    assert set(metrics) == {"tfidf", "embedding"} and metrics["tfidf"].precision == pytest.approx(1.0)
    stamps = {p: p.stat().st_mtime_ns for p in Path(out).rglob("_SUCCESS")}
    time.sleep(0.01)
    assert prepare(spark, str(tmp_path / "raw.json"), out, config).first() == row
    assert {p: p.stat().st_mtime_ns for p in Path(out).rglob("_SUCCESS")} == stamps


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() == 1000


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert differences(spark, duck(SF), name, SF, entry_point.queries(), entry_point.oracle_sql()) == []


@pytest.mark.parametrize("name", ["svd_rows", "svd_coordinates", "kmeans_labels"])
def test_one_row_per_document(spark, name):
    assert entry_point.queries()[name](spark, SF).count() == 200
