from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.operators import features
from folioscope.settings import Limits

DOCS = [
    ("1", 1, "alpha beta beta gamma"),
    ("2", 2, "beta gamma delta"),
    ("3", 3, "of the and"),
    ("4", 4, "alpha alpha beta 123 x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id string, seq long, final_text string").repartition(3, "seq")


def grams(text):
    words = [w for w in text.split() if w.isalpha() and len(w) > 1 and w not in ("of", "the", "and")]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def expected(max_terms):
    """Smooth-idf, length-one TF-IDF in plain Python."""
    counts = {i: Counter(grams(t)) for i, _, t in DOCS}
    total = Counter()
    for c in counts.values():
        total.update(c)
    vocab = [t for t, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:max_terms]]
    idf = {t: math.log((1 + len(DOCS)) / (1 + sum(t in c for c in counts.values()))) + 1 for t in vocab}
    rows = {}
    for i, c in counts.items():
        raw = {t: n * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        rows.update({(i, t): v / norm for t, v in raw.items()})
    return vocab, idf, rows


@pytest.mark.parametrize("max_terms", [1, 2, 3, 5, 100])
def test_tfidf_equals_the_definition(docs, max_terms):
    vocab, idf, rows = expected(max_terms)
    model = features.fit_tfidf(docs, max_terms=max_terms)
    assert model.terms == sorted(vocab)
    stored = {r.term: r for r in model.vocab.collect()}
    assert {t: pytest.approx(r.idf) for t, r in stored.items()} == idf
    found = features.long_tfidf(model.transform(docs), model.vocab).collect()
    assert {(r.id, r.term): r.weight for r in found} == {k: pytest.approx(v) for k, v in rows.items()}


def test_rows_have_length_one_or_none(docs):
    rows = features.fit_tfidf(docs).transform(docs)
    norms = {r.id: sum(x * x for x in r.weight) for r in rows.collect()}
    assert norms.pop("3") == 0
    assert all(n == pytest.approx(1) for n in norms.values())


def test_the_word_floor_changes_nothing(spark, corpus):
    """Small caps use the bigram filter; the plain count of all terms is the yardstick."""
    plain = corpus.clean.select(F.explode(features.tx.terms("final_text")).alias("term")).groupBy("term").count()
    for cap in (3, 50, 400):
        best = plain.orderBy(F.desc("count"), "term").limit(cap).collect()
        found = features.top_terms(corpus.clean, "final_text", cap, features.VECTOR_STOP_WORDS)
        assert [(r.term, r.ctf) for r in found] == [(r.term, r["count"]) for r in best]


def test_transform_new_texts_with_reloaded_vocabulary(spark, docs):
    vocab = features.fit_tfidf(docs).vocab
    model = features.TfidfModel.from_table(vocab)
    new = spark.createDataFrame([("n", "beta unseen beta"), ("m", "unseen"), ("o", None)], "id string, final_text string")
    rows = {r.id: dict(zip(r.term_idx, r.weight)) for r in model.transform(new).collect()}
    assert rows == {"n": {model.terms.index("beta"): 1.0}, "m": {}, "o": {}}


def test_transform_shuffles_nothing(docs, spark, tmp_path):
    docs.write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    plan = features.fit_tfidf(stored).transform(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_term_counts_shuffle_only_rows_that_share_an_id(spark, tmp_path):
    """Terms of single ids are counted in their rows; repeated and missing ids are added up, within the bound and beyond it."""
    more = [*DOCS, ("2", 5, "beta beta"), (None, 6, "gamma delta gamma"), (None, 7, "gamma"), ("5", 8, None), ("6", 9, "a a")]
    wanted = {}
    for i, _, text in more:
        wanted.setdefault(i, Counter()).update(grams(text or ""))
    wanted = {(i, t): n for i, counts in wanted.items() for t, n in counts.items()}
    for name, rows in (("single", DOCS), ("shared", more)):
        spark.createDataFrame(rows, "id string, seq long, final_text string").repartition(3, "seq").write.parquet(str(tmp_path / name))
    for limits in (Limits(), Limits(broadcast_rows=1)):
        found = features.term_counts(spark.read.parquet(str(tmp_path / "shared")), limits=limits)
        rows = found.collect()
        assert {(r.id, r.term): r.n for r in rows} == wanted and len(rows) == len(wanted)
        assert found.dtypes == [("id", "string"), ("term", "string"), ("n", "bigint")]
    single = features.term_counts(spark.read.parquet(str(tmp_path / "single")))
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString()
    assert {(r.id, r.term): r.n for r in single.collect()} == {k: n for k, n in wanted.items() if k[0] in ("1", "3", "4")} | {("2", t): n for t, n in Counter(grams(DOCS[1][2])).items()}


def test_the_clean_stage_keeps_what_later_stages_read(corpus):
    assert corpus.clean.columns == ["id", "seq", "final_text"]


def test_empty_corpus(docs):
    model = features.fit_tfidf(docs.limit(0))
    assert model.terms == [] and model.transform(docs).where("size(weight) > 0").count() == 0


def test_hash_embedding(docs):
    rows = {r.id: np.array(r.embedding) for r in features.hash_embed(docs, dim=16).collect()}
    assert all(len(v) == 16 for v in rows.values())
    assert np.linalg.norm(rows["1"]) == pytest.approx(1)
    plan = features.hash_embed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_encoder_is_built_once_per_task_and_called_in_batches(docs):
    def factory():
        calls = []

        def encode(texts):
            calls.append(len(texts))
            return np.array([[len(t), len(texts), len(calls)] for t in texts])

        return encode

    rows = features.embed(docs.coalesce(1), factory, batch_size=3).collect()
    assert sorted(tuple(r.embedding[1:]) for r in rows) == [(1.0, 2.0), (3.0, 1.0), (3.0, 1.0), (3.0, 1.0)]
