"""The operators as queries over the given tables, with production parameters and no subsets."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import bpe, language, mixing, pii, prefix_trie, quality, repeats, runs, simhash, tiling, tokens, url_lists, vectors
from folioscope.llm.common import fold, ready, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in whole documents, by greedy string tiling."""
    return tiling.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents outside fold 1 of 3."""
    ready(spark)
    params = language.LanguageParams()
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 3) == 1)
    model = language.learn_languages(docs.where("not held_out"), params, "doc_id", "text", "lang")
    return language.identify_languages(docs, model, params, keys=("doc_id", "held_out"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and secrets of every document."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind in pii.KINDS[:4]], F.sha2(pii.joined_spans(F.col("base")), 256).alias("base_sha256"),
        pii.joined_spans(F.col("spans")).alias("spans"),
    )


@query
def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures, judged by dated lists drawn from their hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    digest = F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 1, 6), 16, 10).cast("int")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), digest % 365))
    judged = url_lists.judge_captures(captures, url_lists.validity_intervals(url_lists.listed_changes(pages)), "page_id", "url", "fetched")
    return judged.select("page_id", "host", "fetched", "blocked", F.array_join("lists", ",").alias("lists"), "since")


ORACLES["op5_url_lists"] = r"""
WITH captures AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
         CAST(DATE '2024-01-01' + CAST(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6))::INT % 365 AS INTEGER) AS DATE) AS fetched,
         row_number() OVER () AS row
  FROM pages),
hosts AS (SELECT DISTINCT host AS entry FROM captures WHERE host IS NOT NULL),
domains AS (SELECT DISTINCT regexp_extract(entry, '([^.]+\.[^.]+\.[^.]+)$', 1) AS entry FROM hosts),
numbered AS (
  SELECT entry, ('0x' || substr(md5('pick' || entry), 1, 6))::INT AS pick, ('0x' || substr(md5('add' || entry), 1, 6))::INT AS added,
         ('0x' || substr(md5('remove' || entry), 1, 6))::INT AS removed, ('0x' || substr(md5('again' || entry), 1, 6))::INT AS again FROM hosts),
spans AS (
  SELECT 'hosts' AS list, entry, added % 240 AS a, added % 240 + 20 + removed % 90 AS b FROM numbered WHERE pick % 3 = 0
  UNION ALL
  SELECT 'hosts', entry, added % 240 + 35 + removed % 90, NULL FROM numbered WHERE pick % 3 = 0 AND again % 2 = 0
  UNION ALL
  SELECT 'domains', entry, ('0x' || substr(md5('since' || entry), 1, 6))::INT % 360, NULL FROM domains
  WHERE entry <> '' AND ('0x' || substr(md5('domain' || entry), 1, 6))::INT % 4 = 0),
dated AS (
  SELECT list, entry, CAST(DATE '2024-01-01' + CAST(a AS INTEGER) AS DATE) AS since, CAST(DATE '2024-01-01' + CAST(b AS INTEGER) AS DATE) AS until FROM spans)
SELECT any_value(c.page_id) AS page_id, any_value(c.host) AS host, any_value(c.fetched) AS fetched, count(d.list) > 0 AS blocked,
       coalesce(string_agg(DISTINCT d.list, ',' ORDER BY d.list), '') AS lists, min(d.since) AS since
FROM captures c LEFT JOIN dated d
  ON (c.host = d.entry OR (ends_with(c.host, '.' || d.entry) AND contains(d.entry, '.')))
  AND c.fetched >= d.since AND (d.until IS NULL OR c.fetched < d.until)
GROUP BY c.row"""


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, through a digest cache that this application fills."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate group of every vector."""
    return vectors.vector_groups(table(spark, sf_dir, "embeddings"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels outside fold 0 of 5."""
    ready(spark)
    params = quality.QualityParams()
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    scored = quality.score_quality(docs, quality.learn_quality(docs, labels, params), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= params.threshold).cast("int"))


@query
def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words every document gives to the mix of sources."""
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that repeat, as counts and a digest."""
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text that they decode to, as a count and digests."""
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def looped(docs: DataFrame) -> DataFrame:
    """Documents whose number says so go round in a loop: from a word on, the text repeats a stretch of its own words."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    parts = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    parts = parts.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    parts = parts.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    parts = parts.withColumn("p", 1 + F.expr("(n - a) div (3 + g % 8)"))
    turned = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, get(words, int(a + (i - a) % p)))), ' ')")
    return parts.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), turned).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, some of which are made to loop, and the text without repeated periods."""
    found = runs.periodic_runs(looped(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def branched(placed: DataFrame) -> DataFrame:
    """Each conversation after its first turns of another: the first turns of the hundred's first one, then its own rest."""
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    convs = placed.where("place = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), shared.alias("shared"))
    heads = placed.where("place < 5 and conv_id % 100 = 0").select(F.col("conv_id").alias("base"), "place", "id")
    lent = convs.join(heads, "base").where("place < shared").select("conv_id", "place", "id")
    sizes = heads.groupBy("base").agg(F.count("*").alias("lent"))
    before = convs.join(sizes, "base", "left").select("conv_id", "shared", F.least("shared", F.coalesce("lent", F.lit(0))).alias("lent"))
    own = placed.join(before, "conv_id").where("place >= shared")
    rest = own.select("conv_id", (F.col("place") - F.col("shared") + F.col("lent")).alias("place"), "id")
    return lent.unionByName(rest).unionByName(prefix_trie.present(convs))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, each rebuilt on the first turns of another."""
    ready(spark)
    return prefix_trie.prefix_trie(branched(prefix_trie.placed_turns(table(spark, sf_dir, "conversations"))))
