"""Stage tables of one corpus directory, built on first use and stored for the rest of the application."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import cleaning, evaluation, features, postings, similarity, trigrams
from folioscope.operators.vectorizer import TfidfVectorizer
from folioscope.session import ship_package
from folioscope.settings import EVAL_QUERIES, SWEEP_KS, SWEEP_QUERIES
from folioscope.sources.papers import papers_from_documents, spread, vectors_from_embeddings
from folioscope.sources.tables import exists, materialize, scratch_path


class Workspace:
    _open: dict[tuple[str, str], Workspace] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.root = scratch_path(spark, "stages")
        ship_package(spark)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Workspace:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._open:
            cls._open[key] = cls(spark, sf_dir)
        return cls._open[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return materialize(self.spark, f"{self.root}/{name}", build)

    @property
    def papers(self) -> DataFrame:
        return papers_from_documents(self.table("documents"))

    @property
    def spread_papers(self) -> DataFrame:
        return spread(self.papers)

    @property
    def vectors(self) -> DataFrame:
        return spread(vectors_from_embeddings(self.table("embeddings")))

    @property
    def lang_clusters(self) -> DataFrame:
        """A given clustering: one cluster per language, numbered in alphabetical order."""
        languages = self.table("documents").select("lang").distinct()
        numbered = languages.select(F.sort_array(F.collect_set("lang")).alias("names"))
        listed = numbered.select(F.posexplode("names").alias("cluster_id", "lang"))
        return (
            self.table("documents")
            .join(F.broadcast(listed), "lang")
            .select(F.col("doc_id").cast("string").alias("id"), "cluster_id")
        )

    @property
    def label_clusters(self) -> DataFrame:
        return self.vectors.select("id", F.col("label").alias("cluster_id"))

    @cached_property
    def lemmas(self) -> DataFrame:
        return self.stage("lemmas", lambda: cleaning.corpus_lemma_map(self.spread_papers))

    @cached_property
    def clean(self) -> DataFrame:
        """``(id, seq, final_text)``: what later stages read of the cleaned corpus."""
        return self.stage("clean", lambda: cleaning.preprocess(self.spread_papers, self.lemmas).select("id", "seq", "final_text"))

    @cached_property
    def vocab(self) -> DataFrame:
        return self.stage("vocab", lambda: features.fit_tfidf(self.clean).vocab)

    @cached_property
    def model(self) -> features.TfidfModel:
        return features.TfidfModel.from_table(self.vocab)

    @cached_property
    def tfidf(self) -> DataFrame:
        return self.stage("tfidf", lambda: self.model.transform(self.clean))

    @cached_property
    def tfidf_pipeline(self) -> PipelineModel:
        path = f"{self.root}/tfidf_pipeline"
        plan = Pipeline(stages=[TfidfVectorizer(inputCol="final_text", outputCol="features")])
        plan.fit(self.clean).write().overwrite().save(path)
        return PipelineModel.load(path)

    @cached_property
    def tfidf_index(self) -> postings.SparseIndex:
        if not exists(self.spark, f"{self.root}/index/terms"):
            postings.build_index(self.tfidf, f"{self.root}/index")
        return postings.read_index(self.spark, f"{self.root}/index", self.tfidf)

    @cached_property
    def trigram_index(self) -> trigrams.TrigramIndex:
        if not exists(self.spark, f"{self.root}/trigrams/postings"):
            trigrams.build_index(self.spread_papers, f"{self.root}/trigrams")
        return trigrams.read_index(self.spark, f"{self.root}/trigrams", self.papers)

    @cached_property
    def hashed(self) -> DataFrame:
        return self.stage("hashed", lambda: features.hash_embed(self.clean))

    def features(self, method: str) -> DataFrame:
        return {"tfidf": lambda: self.tfidf, "embedding": lambda: self.hashed}[method]()

    def queries(self, n: int = EVAL_QUERIES) -> DataFrame:
        return self.stage(f"queries_{n}", lambda: evaluation.sample_queries(self.papers, n))

    def vector_queries(self, n: int = EVAL_QUERIES) -> DataFrame:
        return self.stage(f"vector_queries_{n}", lambda: evaluation.sample_queries(self.vectors, n))

    def ranked(self, method: str, n: int, k: int) -> DataFrame:
        return self.stage(
            f"ranked_{method}_{n}_{k}", lambda: similarity.topk(self.features(method), self.queries(n), k)
        )

    def swept(self, method: str) -> DataFrame:
        return self.ranked(method, SWEEP_QUERIES, max(SWEEP_KS))

    @cached_property
    def ranked_vectors(self) -> DataFrame:
        return self.stage("ranked_vectors", lambda: similarity.topk(self.vectors, self.vector_queries(), 10))
