"""Token counts kept in a cache under the digests of the content and of the tokenizer."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.common import map_batches, ready, stored
from folioscope.sources.tables import exists, scratch_root

# new digests that are sent to the texts; of more the texts travel
SENT_DIGESTS = 200_000
CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Version of a tokenizer: the digest of its vocabulary file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


@lru_cache(maxsize=2)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts the tokens of whole texts, without begin, end or added special tokens; loaded once per worker."""
    if path.endswith(".model"):
        import sentencepiece

        encoder = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(encoder.encode(t)) for t in texts]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    return spark.read.schema(CACHE_SCHEMA).parquet(cache) if exists(spark, cache) else spark.createDataFrame([], CACHE_SCHEMA)


def encode_misses(misses: DataFrame, tokenizer_path: str, version: str) -> DataFrame:
    """Cache rows of ``(content, text)``; the only place where texts are encoded."""

    def convert(batch: pa.RecordBatch):
        yield batch.column(0)
        yield [version] * batch.num_rows
        yield counter(tokenizer_path)(batch.column(1).to_pylist())

    return map_batches(misses, convert, CACHE_SCHEMA)


def cache_of(spark: SparkSession, tokenizer_path: str) -> str:
    """The cache of this application for a tokenizer's version, in the shared scratch folder."""
    return f"{scratch_root(spark)}/token-cache-{tokenizer_digest(tokenizer_path)}"


def count_tokens(
    docs: DataFrame, tokenizer_path: str, cache: str | None = None, limit: int = 4096, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row; new contents are appended to the table at ``cache``.

    The cache defaults to one per application and version of the tokenizer. A content is the whole text, null counting
    as empty; nothing else is normalised, since any change of the text can change its tokens. Contents in the cache under
    this tokenizer's digest are not encoded again; of equal new contents one is, whatever their keys. Repeated rows and
    null keys give rows of their own; no rows give no rows. A cache that two runs fill at once may hold a content twice,
    with the same count; readers take one. If nothing is new, no text leaves its task; if something is, texts are made
    distinct in their task before they travel, and of at most ``SENT_DIGESTS`` new digests only their texts do.
    """
    spark = docs.sparkSession
    ready(spark)
    cache = cache or cache_of(spark, tokenizer_path)
    version = tokenizer_digest(tokenizer_path)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    given = docs.select(F.col(key).alias("key"), body.alias("text")).withColumn("content", F.sha2("text", 256))
    sizes = stored(given.select("key", "content", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    known = read_cache(spark, cache).where(F.col("tokenizer") == version).select("content")
    fresh = stored(sizes.select("content").distinct().join(known, "content", "left_anti"), "misses")
    new = fresh.limit(SENT_DIGESTS + 1).count()
    if new:
        few = new <= SENT_DIGESTS
        texts = given.select("content", "text")
        texts = texts.join(F.broadcast(fresh), "content", "left_semi") if few else texts
        misses = texts.groupBy("content").agg(F.first("text").alias("text"))
        misses = misses if few else misses.join(fresh, "content", "left_semi")
        encode_misses(misses, tokenizer_path, version).write.mode("append").parquet(cache)

    counts = read_cache(spark, cache).where(F.col("tokenizer") == version)
    counts = counts.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    joined = sizes.join(counts, "content")
    return joined.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
