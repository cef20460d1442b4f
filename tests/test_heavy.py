from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscope.operators import features, heavy


def table_of(counts):
    return heavy.pa.table({"term": heavy.pa.array(list(counts), heavy.pa.string()), "n": heavy.pa.array(list(counts.values()), heavy.pa.int64())})


def bounds(table):
    rows = dict(zip(table["term"].to_pylist(), table["n"].to_pylist()))
    return rows, rows.pop(None, 0)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.sampled_from("abcdefghij"), min_size=1), min_size=1, max_size=6), st.integers(1, 8))
def test_bounds_hold_in_any_order_of_merging(parts, capacity):
    true = Counter(t for part in parts for t in part)
    summaries = [heavy._merged([table_of(Counter(part))], capacity) for part in parts]
    while len(summaries) > 1:
        summaries = [heavy._merged(summaries[i : i + 2], capacity) for i in range(0, len(summaries), 2)]
    at_least, error = bounds(summaries[0])
    assert len(at_least) <= capacity
    assert error <= sum(true.values()) / (capacity + 1)
    assert all(n <= true[t] <= n + error for t, n in at_least.items())
    assert all(true[t] <= error for t in true if t not in at_least)


def test_summary_of_rows_over_many_tasks(spark):
    """One term has a third of all rows; the others are spread evenly."""
    rows = spark.range(0, 60_000, 1, 23).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("t"), F.col("id") % 900)).alias("term")
    )
    lists = rows.select(F.array("term", F.lit(None)).alias("terms")).union(spark.createDataFrame([(None,), ([],)], "terms array<string>"))
    true = {r.term: r["count"] for r in rows.groupBy("term").count().collect() if r.term}
    for capacity in (1, 50, 5_000):
        found = heavy.summarise(lists, capacity)
        known = dict(zip(found.terms, found.at_least))
        assert found.terms[0] == "hot" and len(known) <= capacity
        assert found.error <= sum(true.values()) / (capacity + 1)
        assert all(n <= true[t] <= n + found.error for t, n in known.items())
        assert all(n <= found.error for t, n in true.items() if t not in known)
    assert found.error == 0 and known == true


def test_empty_table_and_wrong_size(spark):
    none = spark.createDataFrame([], "terms array<string>")
    assert heavy.summarise(none, 5).terms == [] and heavy.summarise(none, 5).error == 0
    with pytest.raises(ValueError):
        heavy.summarise(none, 0)


@pytest.mark.parametrize("cap", [1, 60, 400])
def test_every_summary_gives_the_same_vocabulary(spark, corpus, cap):
    """Small summaries leave the choice open, so that all words are counted; large ones settle it."""
    plain = corpus.clean.select("id", F.explode(features.tx.terms("final_text")).alias("term"))
    counts = plain.groupBy("term").agg(F.count("*").alias("ctf"), F.count_distinct("id").alias("df"))
    best = {(r.term, r.ctf, r.df) for r in counts.orderBy(F.desc("ctf"), "term").limit(cap).collect()}
    for size in (cap, 20 * cap):
        vocab = features.fit_tfidf(corpus.clean, max_terms=cap, summary_terms=size).vocab
        assert {(r.term, r.ctf, r.df) for r in vocab.collect()} == best


def test_equal_counts_leave_the_choice_to_the_full_count(spark, monkeypatch):
    """All words occur equally often: the word filter has nothing to leave out and no summary is certain."""
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    docs = spark.createDataFrame([(str(i), " ".join(words[i:] + words[:i])) for i in range(0, 300, 30)], "id string, final_text string")
    asked = []
    full = features.top_terms
    monkeypatch.setattr(features, "top_terms", lambda *a: asked.append(1) or full(*a))
    true = Counter(t for r in docs.select(features.tx.terms("final_text").alias("t")).collect() for t in r.t)
    best = sorted(sorted(true, key=lambda t: (-true[t], t))[:20])
    assert features.fit_tfidf(docs, max_terms=20, summary_terms=40).terms == best
    assert asked == [1]
    # a summary that holds all terms is certain
    assert features.fit_tfidf(docs, max_terms=20, summary_terms=1_000).terms == best
    assert asked == [1]


def test_few_terms_above_many_rare_ones_need_no_full_count(spark, monkeypatch):
    rare = [f"x{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}" for i in range(4_000)]
    rows = [(str(i), f"often {rare[i]} usual often") for i in range(4_000)]
    docs = spark.createDataFrame(rows, "id string, final_text string").repartition(16)
    monkeypatch.setattr(features, "top_terms", None)
    model = features.fit_tfidf(docs, max_terms=3, summary_terms=300)
    assert model.terms == ["often", "usual", "usual often"]
    assert [r.ctf for r in model.vocab.orderBy("term").collect()] == [8_000, 4_000, 4_000]
