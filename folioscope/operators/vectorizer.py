"""TF-IDF as stages of a ``pyspark.ml`` pipeline.

``TfidfVectorizer`` learns what ``features.fit_tfidf`` learns and its model adds a column of unit-length sparse vectors,
so texts can be followed by any other stage of a ``Pipeline``. Pipelines and fitted pipelines that hold them are saved
and loaded like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text as tx
from folioscope.functions.wordlists import VECTOR_STOP_WORDS
from folioscope.operators.features import TfidfModel, fit_tfidf
from folioscope.settings import MAX_TERMS
from folioscope.sources.tables import write_parquet


class _VectorizerParams(HasInputCol, HasOutputCol):
    maxTerms = Param(Params._dummy(), "maxTerms", "terms kept, the most frequent first", TypeConverters.toInt)
    ngramMax = Param(Params._dummy(), "ngramMax", "1 for words, 2 for words and pairs of words", TypeConverters.toInt)
    stopWords = Param(Params._dummy(), "stopWords", "words left out before pairs are formed", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(
            inputCol="final_text", outputCol="tfidf", maxTerms=MAX_TERMS, ngramMax=2, stopWords=list(VECTOR_STOP_WORDS)
        )


class TfidfVectorizer(Estimator, _VectorizerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Chooses the ``maxTerms`` most frequent terms of ``inputCol`` and weighs them by document frequency.

    Null and empty texts count as documents without terms; other columns are passed on.
    """

    @keyword_only
    def __init__(
        self,
        *,
        inputCol: str | None = None,
        outputCol: str | None = None,
        maxTerms: int | None = None,
        ngramMax: int | None = None,
        stopWords: Sequence[str] | None = None,
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TfidfVectorizerModel:
        fitted = fit_tfidf(
            dataset,
            self.getInputCol(),
            self.getOrDefault("maxTerms"),
            tuple(self.getOrDefault("stopWords")),
            self.getOrDefault("ngramMax"),
        )
        return self._copyValues(TfidfVectorizerModel(fitted))


class TfidfVectorizerModel(Model, _VectorizerParams, MLReadable, MLWritable):
    """A fitted vocabulary (``fitted``, whose ``vocab`` is the table of terms, counts and weights)."""

    def __init__(self, fitted: TfidfModel | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.getOutputCol()
        if not self.fitted.terms:
            return dataset.withColumn(out, array_to_vector(F.array().cast("array<double>")))
        # the uid keeps helper columns apart from those of the caller
        terms, counts, weighted = (f"{self.uid}_{step}" for step in ("terms", "counts", "weighted"))
        words = tx.terms(self.getInputCol(), self.getOrDefault("stopWords"), self.getOrDefault("ngramMax"))
        rows = dataset.withColumn(terms, words)
        for step in (
            CountVectorizerModel.from_vocabulary(self.fitted.terms, inputCol=terms, outputCol=counts),
            ElementwiseProduct(scalingVec=Vectors.dense(self.fitted.idf), inputCol=counts, outputCol=weighted),
            Normalizer(p=2.0, inputCol=weighted, outputCol=out),
        ):
            rows = step.transform(rows)
        return rows.drop(terms, counts, weighted)

    def write(self) -> MLWriter:
        return _VocabularyWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _VocabularyReader()


class _VocabularyWriter(MLWriter):
    """Settings as metadata, the vocabulary as a Parquet table beside them."""

    def __init__(self, model: TfidfVectorizerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        write_parquet(self.model.fitted.vocab, f"{path}/vocab")


class _VocabularyReader(MLReader):
    def load(self, path: str) -> TfidfVectorizerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TfidfVectorizerModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.fitted = TfidfModel.from_table(
            self.sparkSession.read.parquet(f"{path}/vocab"), model.getOrDefault("stopWords"), model.getOrDefault("ngramMax")
        )
        return model
