from __future__ import annotations

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from folioscope.operators import features
from folioscope.operators.vectorizer import TfidfVectorizer, TfidfVectorizerModel

ROWS = [
    ("1", 1, "alpha beta beta gamma", 0.0),
    ("2", 2, "beta gamma delta", 0.0),
    ("3", 3, None, 1.0),
    ("4", 4, "delta delta alpha stop", 1.0),
    ("4", 5, "", 1.0),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "id string, seq long, text string, label double").repartition(3, "seq")


def weights(rows, column="v"):
    return {r.seq: [round(x, 9) for x in r[column]] for r in rows.select("seq", vector_to_array(column).alias(column)).collect()}


def test_equals_the_plain_functions(docs):
    stage = TfidfVectorizer(inputCol="text", outputCol="v", maxTerms=5, stopWords=["stop"])
    model = stage.fit(docs)
    plain = features.fit_tfidf(docs, "text", 5, ("stop",))
    assert model.fitted.terms == plain.terms and model.fitted.idf == plain.idf
    width = len(plain.terms)
    expected = {}
    for r in plain.transform(docs, "text").collect():
        expected[r.seq] = [0.0] * width
        for i, x in zip(r.term_idx, r.weight):
            expected[r.seq][i] = round(x, 9)
    assert weights(model.transform(docs)) == expected


def test_other_columns_stay_even_with_names_of_helpers(docs):
    clash = docs.withColumns({"_terms": F.lit(1), "_tf": F.lit(2), "terms": F.lit(3), "counts": F.lit(4)})
    out = TfidfVectorizer(inputCol="text", outputCol="v").fit(clash).transform(clash)
    assert out.columns == [*clash.columns, "v"]
    assert out.where("_terms = 1 and _tf = 2 and terms = 3 and counts = 4").count() == len(ROWS)


def test_a_saved_pipeline_does_the_same(spark, docs, tmp_path):
    stages = [TfidfVectorizer(inputCol="text", outputCol="v", ngramMax=1), NaiveBayes(featuresCol="v")]
    Pipeline(stages=stages).save(str(tmp_path / "plan"))
    fitted = Pipeline.load(str(tmp_path / "plan")).fit(docs)
    fitted.save(str(tmp_path / "fitted"))
    fitted.write().overwrite().save(str(tmp_path / "fitted"))
    loaded = PipelineModel.load(str(tmp_path / "fitted"))
    assert isinstance(loaded.stages[0], TfidfVectorizerModel)
    assert loaded.stages[0].uid == fitted.stages[0].uid and loaded.stages[0].getOrDefault("ngramMax") == 1
    assert all(" " not in t for t in loaded.stages[0].fitted.terms)
    assert weights(loaded.transform(docs), "probability") == weights(fitted.transform(docs), "probability")
    assert weights(loaded.transform(docs)) == weights(fitted.transform(docs))


def test_params_can_be_changed_when_fitting(docs):
    stage = TfidfVectorizer(inputCol="text", outputCol="v")
    assert len(stage.fit(docs, {stage.maxTerms: 2}).fitted.terms) == 2
    assert stage.copy({stage.ngramMax: 1}).getOrDefault("ngramMax") == 1 and stage.getOrDefault("ngramMax") == 2


def test_empty_table(docs):
    model = TfidfVectorizer(inputCol="text", outputCol="v").fit(docs.limit(0))
    assert weights(model.transform(docs)) == {seq: [] for _, seq, _, _ in ROWS}
