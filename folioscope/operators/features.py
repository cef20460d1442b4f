"""Sparse TF-IDF and dense embeddings.

A TF-IDF row is stored sparse, one row per document: ``(id, seq, term_idx array<int>, weight array<double>)``.
Once the vocabulary is known, counting, weighting and scaling happen inside each row, so documents are never
shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import text as tx
from folioscope.functions.wordlists import VECTOR_STOP_WORDS
from folioscope.operators.heavy import summarise
from folioscope.schemas import VOCABULARY
from folioscope.settings import EMBEDDING_DIM, ENCODE_BATCH, LIMITS, MAX_TERMS, Limits
from folioscope.sources.tables import write_parquet


# terms of a summary for each term of the vocabulary cap
SUMMARY_TERMS = 10
# occurrences of terms counted at once before their sums leave a task, but for those of one row
COUNTED = 2_000_000


def term_counts(docs: DataFrame, text_col: str = "final_text", limits: Limits = LIMITS, **kw) -> DataFrame:
    """Long table ``(id, term, n)`` over all terms.

    Terms are counted in the row. Only the counts of rows that share an id are shuffled; one pass over the ids, which must
    not change from one reading of ``docs`` to the next, finds those.
    """

    def each(rows: DataFrame) -> DataFrame:
        return rows.select("id", F.explode(tx.counted(tx.terms(text_col, **kw))).alias("e")).select("id", "e.term", "e.n")

    def added(rows: DataFrame) -> DataFrame:
        return each(rows).groupBy("id", "term").agg(F.sum("n").alias("n"))

    shared = docs.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("id").alias("_shared"))
    n = shared.limit(limits.broadcast_rows + 1).count()
    if not n:
        return each(docs)
    if n > limits.broadcast_rows:
        return added(docs)
    shared, same = F.broadcast(shared), F.col("id").eqNullSafe(F.col("_shared"))
    return each(docs.join(shared, same, "left_anti")).unionByName(added(docs.join(shared, same, "left_semi")))


def partial_term_counts(docs: DataFrame, text_col: str, stop_words: Sequence[str] | None, ngram_max: int = 2) -> DataFrame:
    """``(term, ctf, df)`` of some rows at a time, to be added up: occurrences and the number of rows that hold a term. Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["terms"]
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(np.cumsum(lengths) // COUNTED, prepend=-1))
            for start, stop in zip(starts, [*starts[1:], len(lists)]):
                found = pc.dictionary_encode(lists.slice(start, stop - start).flatten())
                code, size = found.indices.to_numpy(), len(found.dictionary)
                if not size:
                    continue
                row = np.repeat(np.arange(stop - start, dtype=np.int64), lengths[start:stop])
                ctf, df = (np.bincount(x, minlength=size) for x in (code, np.unique(row * size + code) % size))
                yield pa.record_batch([found.dictionary, pa.array(ctf, pa.int64()), pa.array(df, pa.int64())], names=["term", "ctf", "df"])

    return docs.select(tx.terms(text_col, stop_words, ngram_max).alias("terms")).mapInArrow(run, "term string, ctf long, df long")


def _count(terms: DataFrame) -> DataFrame:
    return terms.groupBy("term").agg(F.count("*").alias("ctf"))


def top_terms(docs: DataFrame, text_col: str, max_terms: int, stop_words: Sequence[str] | None, ngram_max: int = 2) -> list:
    """The ``max_terms`` terms with the highest corpus count (ties alphabetical) as rows ``(term, ctf)``.

    A bigram is never more frequent than either of its words. If at least ``max_terms`` single words exist, the
    count of the last one that would fit is a floor that every chosen term must reach, so only bigrams of two
    words at or above the floor have to be counted. This drops nearly all distinct bigrams before the shuffle
    without changing the result. The word filter is broadcast, hence skipped when ties make it too long.
    """
    unigrams = _count(docs.select(F.explode(tx.tokens(text_col, stop_words)).alias("term")))
    best = unigrams.orderBy(F.desc("ctf"), "term").limit(4 * max_terms).collect()
    if ngram_max < 2:
        return best[:max_terms]
    pairs = docs.select(F.explode(tx.let(tx.tokens(text_col, stop_words), tx.bigrams)).alias("term"))
    if len(best) >= max_terms:
        floor = best[max_terms - 1].ctf
        frequent = [row.term for row in best if row.ctf >= floor]
        if len(best) < 4 * max_terms or best[-1].ctf < floor:
            keep = F.broadcast(docs.sparkSession.createDataFrame([(w,) for w in frequent], "word string"))
            pairs = (
                pairs.withColumns(
                    {"first": F.substring_index("term", " ", 1), "second": F.substring_index("term", " ", -1)}
                )
                .join(keep.withColumnRenamed("word", "first"), "first", "left_semi")
                .join(keep.withColumnRenamed("word", "second"), "second", "left_semi")
                .select("term")
            )
    top_pairs = _count(pairs).orderBy(F.desc("ctf"), "term").limit(max_terms).collect()
    merged = sorted(best[:max_terms] + top_pairs, key=lambda r: (-r.ctf, r.term.encode()))
    return merged[:max_terms]


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary. ``vocab`` has at most ``max_terms`` rows (term, ctf, df, idf, term_idx)."""

    vocab: DataFrame
    terms: list[str]
    idf: list[float]
    stop_words: tuple[str, ...]
    ngram_max: int = 2

    @staticmethod
    def from_table(
        vocab: DataFrame, stop_words: Sequence[str] = VECTOR_STOP_WORDS, ngram_max: int = 2
    ) -> TfidfModel:
        """Reload from a stored vocabulary table; its size was fixed by ``max_terms`` when it was fitted."""
        rows = vocab.orderBy("term_idx").collect()
        return TfidfModel(vocab, [r.term for r in rows], [r.idf for r in rows], tuple(stop_words), ngram_max)

    def _counted(self, docs: DataFrame, text_col: str) -> DataFrame:
        counter = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_terms", outputCol="_tf")
        return counter.transform(docs.withColumn("_terms", tx.terms(text_col, self.stop_words, self.ngram_max)))

    def transform(self, docs: DataFrame, text_col: str = "final_text") -> DataFrame:
        """Sparse unit-length rows; unseen terms are dropped and a text without known terms gets empty arrays."""
        carried = [c for c in ("id", "seq") if c in docs.columns]
        if not self.terms:
            none = {"term_idx": F.array().cast("array<int>"), "weight": F.array().cast("array<double>")}
            return docs.select(*carried).withColumns(none)
        weigh = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_tfidf")
        scale = Normalizer(p=2.0, inputCol="_tfidf", outputCol="_unit")
        unit = scale.transform(weigh.transform(self._counted(docs.select(*carried, text_col), text_col)))
        sparse = F.unwrap_udt("_unit")
        return unit.select(
            *carried, sparse["indices"].alias("term_idx"), sparse["values"].alias("weight")
        )


def _exact_counts(docs: DataFrame, text_col: str, terms: Sequence[str], stop_words: Sequence[str], ngram_max: int) -> list[tuple[str, int, int]]:
    """``(term, ctf, df)`` of the given terms in one pass over the texts; a task hands on one row per term."""
    if not terms:
        return []
    counted = TfidfModel(None, list(terms), [], tuple(stop_words), ngram_max)._counted(docs.select(text_col), text_col)
    entries = F.arrays_zip(F.unwrap_udt("_tf")["indices"].alias("i"), F.unwrap_udt("_tf")["values"].alias("n"))
    each = counted.select(F.explode(entries).alias("e")).select("e.*")
    sums = each.groupBy("i").agg(F.sum("n").cast("long").alias("ctf"), F.count("*").alias("df"))
    return [(terms[r.i], r.ctf, r.df) for r in sums.collect()]


def _most_frequent(
    docs: DataFrame, text_col: str, max_terms: int, stop_words: Sequence[str], ngram_max: int, summary_terms: int
) -> list[tuple[str, int, int]]:
    """``(term, ctf, df)`` of the ``max_terms`` most frequent terms, ties alphabetical, in alphabetical order.

    A summary of all terms names the candidates, one more pass counts them. They are the whole answer if the last
    one chosen is more frequent than any term the summary may lack; otherwise all words are counted (``top_terms``).
    """
    lists = docs.select(tx.terms(text_col, stop_words, ngram_max).alias("terms"))
    summary = summarise(lists, max(summary_terms, max_terms))
    counts = _exact_counts(docs, text_col, summary.candidates(max_terms), stop_words, ngram_max)
    best = sorted(counts, key=lambda r: (-r[1], r[0].encode()))[:max_terms]
    certain = not summary.error or (len(best) == max_terms and best[-1][1] > summary.error)
    if not certain:
        chosen = [r.term for r in top_terms(docs, text_col, max_terms, stop_words, ngram_max)]
        best = _exact_counts(docs, text_col, chosen, stop_words, ngram_max)
    return sorted(best, key=lambda r: r[0].encode())


def fit_tfidf(
    docs: DataFrame,
    text_col: str = "final_text",
    max_terms: int = MAX_TERMS,
    stop_words: Sequence[str] = VECTOR_STOP_WORDS,
    ngram_max: int = 2,
    summary_terms: int | None = None,
) -> TfidfModel:
    """Vocabulary cap by corpus count, then smooth idf ``ln((1+N)/(1+df)) + 1``. Runs two passes over ``docs``.

    Terms are counted in summaries of ``summary_terms`` terms (10 for each term of the cap unless given), so no task
    holds or sends more, however many different terms the corpus has; the size does not change the result. What comes
    back to the driver is one summary and the vocabulary, at most ``max_terms`` rows.
    """
    if max_terms < 1:
        raise ValueError("max_terms must be positive")
    size = SUMMARY_TERMS * max_terms if summary_terms is None else summary_terms
    counted = _most_frequent(docs, text_col, max_terms, stop_words, ngram_max, size)
    return _model(docs.sparkSession, counted, docs.count(), stop_words, ngram_max)


def _model(spark: SparkSession, counted: list[tuple[str, int, int]], n_docs: int, stop_words: Sequence[str], ngram_max: int) -> TfidfModel:
    """The model of chosen terms ``(term, ctf, df)`` in their order."""
    idf = [float(np.log((1 + n_docs) / (1 + df)) + 1) for _, _, df in counted]
    rows = [(t, ctf, df, w, i) for i, ((t, ctf, df), w) in enumerate(zip(counted, idf))]
    return TfidfModel(spark.createDataFrame(rows, VOCABULARY), [t for t, _, _ in counted], idf, tuple(stop_words), ngram_max)


def model_of_counts(
    counts: DataFrame, n_docs: int, max_terms: int = MAX_TERMS, stop_words: Sequence[str] = VECTOR_STOP_WORDS, ngram_max: int = 2
) -> TfidfModel:
    """The model that ``fit_tfidf`` gives, from the counts ``(term, ctf, df)`` of all terms of ``n_docs`` texts."""
    chosen = counts.orderBy(F.desc("ctf"), "term").limit(max_terms).collect()
    counted = sorted(((r.term, r.ctf, r.df) for r in chosen), key=lambda r: r[0].encode())
    return _model(counts.sparkSession, counted, n_docs, stop_words, ngram_max)


def write_model(model: TfidfModel, path: str) -> None:
    """Stores the vocabulary (``vocab``) and then the settings it was fitted with (``vectoriser``) below ``path``."""
    write_parquet(model.vocab, f"{path}/vocab")
    settings = [(list(model.stop_words), model.ngram_max)]
    write_parquet(model.vocab.sparkSession.createDataFrame(settings, "stop_words array<string>, ngram_max int"), f"{path}/vectoriser")


def read_model(spark: SparkSession, path: str) -> TfidfModel:
    """The model stored by ``write_model``: it counts the terms of new texts as the fitted one does."""
    settings = spark.read.parquet(f"{path}/vectoriser").first()
    return TfidfModel.from_table(spark.read.parquet(f"{path}/vocab"), settings.stop_words, settings.ngram_max)


def long_tfidf(rows: DataFrame, vocab: DataFrame) -> DataFrame:
    """Sparse rows as ``(id, term, weight)``; the vocabulary is bounded by its cap, so it is broadcast."""
    entries = rows.select("id", F.explode(F.arrays_zip("term_idx", "weight")).alias("e")).select("id", "e.*")
    return entries.join(F.broadcast(vocab.select("term_idx", "term")), "term_idx").select("id", "term", "weight")


def hash_bucket(token: Column, dim: int) -> Column:
    """Signed bucket name of a token: ``+b`` or ``-b`` with ``b`` in ``[0, dim)``, from the token's md5."""
    digest = F.md5(token)
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % dim
    positive = F.substring(digest, 9, 1) < "8"
    return F.concat(F.when(positive, F.lit("+")).otherwise(F.lit("-")), bucket.cast("string"))


def hash_embed(docs: DataFrame, text_col: str = "final_text", dim: int = EMBEDDING_DIM) -> DataFrame:
    """Model-free dense embedding: signed feature hashing of the tokens, unit length. Map-only, no Python."""
    signed = [f"+{b}" for b in range(dim)] + [f"-{b}" for b in range(dim)]
    hashed = docs.select(
        "id", "seq", F.transform(tx.tokens(text_col), lambda t: hash_bucket(t, dim)).alias("_buckets")
    )
    counter = CountVectorizerModel.from_vocabulary(signed, inputCol="_buckets", outputCol="_counts")
    counts = counter.transform(hashed).withColumn("_c", vector_to_array("_counts"))
    signed_sum = F.zip_with(F.slice("_c", 1, dim), F.slice("_c", dim + 1, dim), lambda p, m: p - m)
    unit = Normalizer(p=2.0, inputCol="_sum", outputCol="_unit").transform(
        counts.select("id", "seq", array_to_vector(signed_sum).alias("_sum"))
    )
    return unit.select("id", "seq", vector_to_array("_unit").alias("embedding"))


def embed(
    docs: DataFrame,
    encoder_factory: Callable[[], Callable[[list[str]], np.ndarray]],
    text_col: str = "final_text",
    batch_size: int = ENCODE_BATCH,
) -> DataFrame:
    """Dense vectors from a caller's encoder (texts -> 2-D array), e.g. a pretrained sentence model.

    The encoder is built once per task, on the executor, and called with ``batch_size`` texts at a time.
    """

    def run(batches):
        encode = None
        for pdf in batches:
            encode = encode or encoder_factory()
            texts = pdf["_text"].tolist()
            parts = [np.asarray(encode(texts[i : i + batch_size])) for i in range(0, len(texts), batch_size)]
            vectors = [row.astype("float32") for part in parts for row in part]
            yield pd.DataFrame({"id": pdf["id"], "seq": pdf["seq"], "embedding": vectors})

    texts = docs.select("id", "seq", F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return texts.mapInPandas(run, "id string, seq long, embedding array<float>")

