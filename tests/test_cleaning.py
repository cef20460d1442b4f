from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from folioscope.operators import cleaning, lookup
from folioscope.schemas import SEQUENCED_PAPER
from folioscope.settings import Limits


def lemmas(spark, forms, lexicon=None):
    listed = spark.createDataFrame([(f, 1) for f in forms], "form string, n long")
    known = spark.createDataFrame([(f,) for f in lexicon], "form string") if lexicon is not None else None
    return {r.form: r.lemma for r in cleaning.lemma_map(listed, known).collect()}


def test_lemma_rules_with_a_lexicon(spark):
    forms = "papers galaxies classes running papers. wolves boxes quizzes churches dishes firemen omen unknowns glasses".split()
    lexicon = "paper galaxy class wolf box quizz church dish fireman omen oman glass run".split()
    assert lemmas(spark, forms, lexicon) == {
        "papers": "paper",
        "galaxies": "galaxy",
        "classes": "class",
        "wolves": "wolf",
        "boxes": "box",
        "quizzes": "quizz",
        "churches": "church",
        "dishes": "dish",
        "firemen": "fireman",
        "glasses": "glass",
    }


def test_shortest_listed_candidate_wins(spark):
    assert lemmas(spark, ["gases"], ["gases", "gase", "gas"]) == {"gases": "gas"}


def test_rules_are_applied_again_only_when_nothing_is_listed(spark):
    assert lemmas(spark, ["asses"], ["as"]) == {"asses": "as"}
    assert lemmas(spark, ["asses"], ["as", "ass"]) == {"asses": "ass"}


def test_default_lexicon_is_the_corpus(spark):
    assert lemmas(spark, ["papers", "paper", "models"]) == {"papers": "paper"}


ROWS = [
    ("1", "Papers", "the papers, classes and papers", "", "", 1),
    ("2", None, None, "", "", 2),
    ("3", "Class", "", "", "", 3),
    ("4", "paper class galaxies", "galaxies galaxy galaxies models", "", "", 4),
]


@pytest.mark.parametrize("bound", [0, 1, 2, 100])
def test_both_lemma_plans_agree(spark, bound):
    papers = spark.createDataFrame(ROWS, SEQUENCED_PAPER).repartition(3, "seq")
    mapping = cleaning.corpus_lemma_map(papers)
    done = cleaning.preprocess(papers, mapping, limits=Limits(broadcast_rows=bound)).orderBy("seq")
    assert [(r.cleaned_title, r.cleaned_abstract, r.final_text) for r in done.collect()] == [
        ("paper", "papers, class paper", "paper papers, class paper"),
        ("", "", ""),
        ("class", "", "class"),
        ("paper class galaxy", "galaxy galaxy galaxy models", "paper class galaxy galaxy galaxy galaxy models"),
    ]


def test_preprocess_without_lemmas_and_on_no_rows(spark):
    papers = spark.createDataFrame(ROWS, SEQUENCED_PAPER)
    texts = [r.final_text for r in cleaning.preprocess(papers).orderBy("seq").collect()]
    assert texts[0] == "papers papers, classes papers"
    assert cleaning.preprocess(papers.limit(0)).count() == 0


def test_plain_cleaning_runs_no_python(spark):
    papers = spark.createDataFrame(ROWS, SEQUENCED_PAPER)
    plan = cleaning.preprocess(papers)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_last_wins(spark):
    rows = [("1", "old", "a", "", "", 1), ("2", "b", "b", "", "", 2), ("1", "new", "c", "", "", 3)]
    kept = lookup.last_wins(spark.createDataFrame(rows, SEQUENCED_PAPER)).orderBy("id").collect()
    assert [(r.id, r.title, r.seq) for r in kept] == [("1", "new", 3), ("2", "b", 2)]


def test_search(spark):
    rows = [
        ("1", "Modern C++ tips", None, "", "", 1),
        ("2", None, "all about c++", "", "", 2),
        ("3", "plain c", "x" * 201, "", "", 3),
    ]
    papers = spark.createDataFrame(rows, SEQUENCED_PAPER)
    assert [r.id for r in lookup.search(papers, "  C++ ").collect()] == ["1", "2"]
    assert [r.id for r in lookup.search(papers, "c\\+\\+|plain", regex=True).collect()] == ["1", "2", "3"]
    assert lookup.search(papers, "absent").count() == 0
    assert [r.id for r in lookup.search(papers, "c", top_k=1).collect()] == ["1"]
    assert lookup.search(papers, "plain").first().abstract == "x" * 200 + "..."


def test_random_papers_depend_on_the_seed_only(spark):
    rows = [(str(i), "t", "a", "c", "u", i) for i in range(50)]
    papers = spark.createDataFrame(rows, SEQUENCED_PAPER)
    first = [r.id for r in lookup.random_papers(papers, 5).collect()]
    assert first == [r.id for r in lookup.random_papers(papers.repartition(7), 5).collect()]
    assert first != [r.id for r in lookup.random_papers(papers, 5, seed=1).collect()]


def test_word_counts_are_summed_before_the_shuffle(spark):
    papers = cleaning.strip_markup(spark.createDataFrame(ROWS, SEQUENCED_PAPER))
    plan = cleaning.word_counts(papers)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") == 1 and plan.count("Exchange") == 1
    assert cleaning.word_counts(papers).agg(F.sum("n")).first()[0] == 12
