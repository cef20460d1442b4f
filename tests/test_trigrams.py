"""Indexed search against the scan."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from folioscope.operators import lookup, trigrams
from folioscope.settings import Limits

PAPERS = "id string, title string, abstract string, authors string, categories string, seq long"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def papers(spark):
    rng = random.Random(7)
    words = ["Galaxy", "neural net", "C++", "ünïcode", "a.b", "deep", "learning", "star😀s", "mass (x)", "[1]"]
    rows = [
        (str(i), rng.choice([None, "", " ".join(rng.choices(words, k=3))]), rng.choice([None, "ab", "\n".join(rng.choices(words, k=6))]), "", "x", i)
        for i in range(300)
    ]
    return spark.createDataFrame(rows, PAPERS).repartition(4)


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=1)])
def test_search_equals_the_scan(spark, papers, tmp_path, monkeypatch, limits):
    monkeypatch.setattr(trigrams, "BLOCK_ROWS", 16)
    if limits.broadcast_rows == 1:
        monkeypatch.setattr(trigrams, "PUSHED_IDS", 0)
    index = trigrams.build_index(papers, str(tmp_path / "index"), limits)
    for text in ("galaxy", " DEEP ", "c++", "ünï", "star😀s", "zzz", "ab", "", "galaxy neural net"):
        assert rows_of(trigrams.search_indexed(index, text, 1000, limits=limits)) == rows_of(lookup.search(papers, text, 1000)), text
    for text in ("gal.xy|deep", r"mass \(x\)", "^a", "lear(ning)?", "(deep|neural)+", r"\[1\]", "[[a-z]]eep", "(?i)galaxy", "n{2,}", "(?:star|gal)axy$"):
        assert rows_of(trigrams.search_indexed(index, text, 1000, True, limits)) == rows_of(lookup.search(papers, text, 1000, True)), text


def test_what_a_pattern_requires():
    assert trigrams.required("abcd") == [{"abc", "bcd"}]
    assert trigrams.required("abc|bcd") == [{"abc"}, {"bcd"}]
    assert trigrams.required("x(abc|bcd)y") == [{"abc"}, {"bcd"}]
    assert trigrams.required("abc(x|y)*def") == [{"abc", "def"}]
    assert trigrams.required("(abc)+x?") == [{"abc"}]
    for vague in ("ab", "[abc]+", "abc|x", "(abc)?", r"\x61bc", r"\0101", "(?i)abc", "(abc", "(?!abc)"):
        assert not trigrams.required(vague), vague


def test_few_rows_are_read(spark, papers, tmp_path):
    index = trigrams.build_index(papers, str(tmp_path / "index"))
    trigrams.search_indexed(index, "deep learning c++", root=str(tmp_path / "run"))
    read = spark.read.parquet(str(tmp_path / "run" / "candidates")).count()
    hits = papers.where(F.lower("title").contains("deep learning c++") | F.lower("abstract").contains("deep learning c++")).count()
    assert hits <= read < 30


def test_empty_corpus(spark, tmp_path):
    index = trigrams.build_index(spark.createDataFrame([], PAPERS), str(tmp_path / "index"))
    assert trigrams.search_indexed(index, "galaxy").count() == 0


def test_lists_of_rows_are_grouped_not_single_entries(spark, tmp_path):
    """Tasks hand on one list per trigram and chunk of rows: the index of many equal texts has few rows to shuffle."""
    rows = [(str(i), None, f"Galaxy \0{i % 3} star\U0001f600s", "", "x", i) for i in range(2000)]
    index = trigrams.build_index(spark.createDataFrame(rows, PAPERS).coalesce(2), str(tmp_path / "index"))
    found = {r.gram: r.rows for r in index.postings.collect()}
    assert found["gal"] == list(range(2000)) and found["r\U0001f600s"] == list(range(2000)) and found[" \0001"] == list(range(1, 2000, 3))
    assert {r.gram: r.n for r in index.grams.collect()} == {g: len(rows) for g, rows in found.items()}
    partial = spark.read.parquet(str(tmp_path / "index" / "partial"))
    assert partial.count() <= 2 * len(found) and partial.agg(F.sum(F.size("rows"))).first()[0] == 2000 * 14


def test_lists_do_not_depend_on_the_size_of_batches(spark, tmp_path):
    """A session that hands on few rows at a time has the same lists: a task's rows are gathered first."""
    rows = [(str(i), None, f"Galaxy {i % 3}", "", "x", i) for i in range(500)]
    papers, name = spark.createDataFrame(rows, PAPERS).coalesce(2), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, found = spark.conf.get(name), []
    try:
        for size in ("10000", "16"):
            spark.conf.set(name, size)
            found.append(sorted((r.gram, r.rows) for r in trigrams._partial_postings(papers).collect()))
    finally:
        spark.conf.set(name, before)
    assert found[0] == found[1] and len(found[0]) <= 2 * len({gram for gram, _ in found[0]})
