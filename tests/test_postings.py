"""The inverted index against the scan of all rows."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from folioscope.operators import postings, similarity
from folioscope.settings import Limits

SPARSE = "id string, seq long, term_idx array<int>, weight array<double>"


def lists(df):
    return {(r.query_id, r["rank"]): (r.id, round(r.score, 5)) for r in df.collect()}


def made_up(spark, rng, n, terms, common=0.3):
    rows = []
    for i in range(n):
        if rng.random() < 0.1 and rows:
            base = rng.choice(rows)
            rows.append((f"d{i}", i, base[2], base[3]))
            continue
        chosen = sorted({0} & ({0} if rng.random() < common else set()) | {int(rng.paretovariate(0.6)) % terms for _ in range(rng.randint(0, 8))})
        rows.append((f"d{i}", i, chosen, [rng.choice([0.5, 1.0, 2.0, rng.random() + 0.01]) for _ in chosen]))
    return spark.createDataFrame(rows, SPARSE).repartition(4)


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=3)])
def test_lists_equal_the_scan(spark, tmp_path, monkeypatch, limits):
    monkeypatch.setattr(postings, "BLOCK_ROWS", 16)
    monkeypatch.setattr(postings, "PROBES", 4)
    rng = random.Random(8)
    rows = made_up(spark, rng, 400, 60)
    index = postings.build_index(rows, str(tmp_path / "index"), limits)
    queries = rows.where(F.col("seq") % 7 == 0).select(F.col("id").alias("query_id")).union(spark.createDataFrame([("nobody",)], "query_id string"))
    for k in (1, 10):
        assert lists(postings.topk_indexed(index, queries, k, limits)) == lists(similarity.topk(rows, queries, k))
    assert postings.topk_indexed(index, queries, 0).count() == 0


def test_blocks_are_bounded_and_ordered_by_impact(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_ROWS", 16)
    rows = made_up(spark, random.Random(3), 600, 5, common=1.0)
    index = postings.build_index(rows, str(tmp_path / "index"))
    blocks = index.postings.collect()
    assert max(b.n for b in blocks) < 4 * 16 and sum(b.n for b in blocks) == rows.agg(F.sum(F.size("term_idx"))).first()[0]
    for b in blocks:
        weights = [e.weight for e in b.entries]
        assert (min(weights), max(weights)) == (b.low, b.high) and 2 ** (-(b.level + 1) / 2) <= b.low and b.high <= 2 ** (-b.level / 2) + 1e-12


def test_few_rows_are_scored_where_lists_are_clear(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        topic = i % 300
        rows.append((f"d{i}", i, [0, *range(1 + topic * 5, 6 + topic * 5)], [0.05, *(rng.random() + 1 for _ in range(5))]))
    table = spark.createDataFrame(rows, SPARSE)
    index = postings.build_index(table, str(tmp_path / "index"))
    queries = table.where("seq < 20").select(F.col("id").alias("query_id"))
    got = postings.topk_indexed(index, queries, 5, root=str(tmp_path / "run"))
    assert lists(got) == lists(similarity.topk(table, queries, 5))
    assert spark.read.parquet(str(tmp_path / "run" / "scored")).count() < 0.02 * 20 * 3000


def test_empty_rows_and_tables(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0, [], []), ("b", 1, [3], [0.0]), ("c", 2, [3], [2.0]), ("c", 3, [3], [1.0])], SPARSE)
    index = postings.build_index(rows, str(tmp_path / "index"))
    queries = spark.createDataFrame([("a",), ("c",), ("c",)], "query_id string")
    # a repeated id asks once per row of it, as rows of one id are told apart by place only
    assert lists(postings.topk_indexed(index, queries.where("query_id = 'a'"), 3)) == lists(similarity.topk(rows, queries.where("query_id = 'a'"), 3))
    none = postings.build_index(rows.limit(0), str(tmp_path / "none"))
    assert postings.topk_indexed(none, queries, 3).count() == 0
    with pytest.raises(Exception, match="not negative"):
        postings.build_index(spark.createDataFrame([("a", 0, [1], [-1.0])], SPARSE), str(tmp_path / "bad"))


@pytest.mark.parametrize("step", [300, 10**9], ids=["by size", "by cores"])
def test_sums_of_a_query_and_a_row_are_not_shuffled(spark, tmp_path, monkeypatch, step):
    """Postings are dealt once by their row: the same rows are left as by adding up shuffled sums, repeated ids and places included."""
    monkeypatch.setattr(postings, "BLOCK_ROWS", 16)
    monkeypatch.setattr(postings, "PROBES", 4)
    monkeypatch.setattr(postings, "STEP", step)
    rng = random.Random(12)
    plain = made_up(spark, rng, 300, 40).collect()
    more = [(r.id, r.seq, r.term_idx, r.weight) for r in plain] + [(r.id, r.seq, r.term_idx, r.weight) for r in plain[:20]] + [("d5", 900, [0, 3], [1.0, 2.0]), ("lost", None, [0, 1], [1.0, 1.0])]
    rows = spark.createDataFrame(more, SPARSE).repartition(3)
    index = postings.build_index(rows, str(tmp_path / "index"))
    queries = spark.createDataFrame([(f"d{i}",) for i in range(0, 60, 5)], "query_id string")
    found = {}
    for way, limits in (("shuffled", Limits(broadcast_rows=3)), ("dealt", Limits())):
        with monkeypatch.context() as patch:
            if way == "dealt":
                patch.setattr(postings, "_able_by_query", lambda *_: pytest.fail("sums are shuffled"))
            got = lists(postings.topk_indexed(index, queries, 4, limits, root=str(tmp_path / way)))
        pairs = spark.read.parquet(str(tmp_path / way / "pairs")).where("seq is not null")
        found[way] = got, sorted((r.query_id, r.seq) for r in pairs.collect())
    assert found["dealt"] == found["shuffled"] and found["dealt"][1]


def test_time_of_a_long_row_follows_its_entries(spark, tmp_path):
    """The length of a row is added up once, not once for each of its entries."""
    n = 40_000
    rows = spark.createDataFrame([("a", 0, list(range(n)), [0.5 + i % 7 for i in range(n)]), ("b", 1, [0], [2.0])], SPARSE)
    start = time.time()
    index = postings.build_index(rows, str(tmp_path / "index"))
    assert time.time() - start < 20
    total = index.postings.where("term_idx > 0").select(F.explode("entries").alias("e")).agg(F.count("*").alias("n"), F.sum(F.col("e.weight") * F.col("e.weight")).alias("s")).first()
    assert total.n == n - 1 and abs(total.s - (1 - 0.25 / sum((0.5 + i % 7) ** 2 for i in range(n)))) < 1e-9
