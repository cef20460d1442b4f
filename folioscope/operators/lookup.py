"""Point lookup, keyword search, random samples and per-row projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text as tx
from folioscope.functions.sampling import sample_key
from folioscope.schemas import PAPER_FIELDS
from folioscope.settings import PREVIEW_CHARS, SEARCH_LIMIT, SEED


def paper_by_id(papers: DataFrame, paper_id: str) -> DataFrame:
    """All five fields of one paper; no row when the id is unknown. The predicate reaches the Parquet scan."""
    return papers.where(F.col("id") == paper_id).select(*PAPER_FIELDS)


def last_wins(papers: DataFrame) -> DataFrame:
    """One row per id, the one with the highest sequence number.

    ``max_by`` pre-aggregates before the shuffle, so an id with very many copies sends one row per task.
    """
    row = F.struct(*papers.columns)
    kept = papers.groupBy("id").agg(F.max_by(row, F.col("seq")).alias("_row"))
    return kept.select("_row.*").select(*papers.columns)


def search(papers: DataFrame, query: str, top_k: int = SEARCH_LIMIT, regex: bool = False) -> DataFrame:
    """Papers whose title or abstract contains the query, in corpus order.

    ``regex`` matches it as a pattern instead, with Unicode word, digit and blank classes.
    """
    needle = query.lower().strip()

    def hit(column: str):
        lowered = F.lower(column)
        return F.coalesce(lowered.rlike("(?U)" + needle) if regex else lowered.contains(needle), F.lit(False))

    found = papers.where(hit("title") | hit("abstract")).orderBy("seq").limit(top_k)
    return found.select(
        "seq", "id", "title", tx.ellipsize("abstract", PREVIEW_CHARS).alias("abstract"), "authors", "categories"
    )


def random_papers(papers: DataFrame, n: int = 10, seed: int = SEED) -> DataFrame:
    """``n`` papers in a seeded random order; a different seed gives a different draw."""
    drawn = papers.orderBy(sample_key(seed), "id").limit(n)
    return drawn.select("id", "title", "authors", "categories")


def fill_nulls(papers: DataFrame) -> DataFrame:
    return papers.fillna({"title": "", "abstract": "", "categories": "unknown"})


def with_raw_text(papers: DataFrame) -> DataFrame:
    """``final_text`` from uncleaned fields, for a corpus without its cleaned table."""
    blank = F.lit("")
    return papers.withColumn(
        "final_text", F.concat(F.coalesce("title", blank), F.lit(" "), F.coalesce("abstract", blank))
    )


def cards(papers: DataFrame, title_chars: int = 100, author_chars: int = 80) -> DataFrame:
    """Short forms for listings: clipped title and authors, first three categories."""
    return papers.select(
        "id",
        tx.ellipsize("title", title_chars).alias("title"),
        tx.ellipsize("authors", author_chars).alias("authors"),
        F.slice(tx.category_list("categories"), 1, 3).alias("top_categories"),
        tx.category_list("categories").alias("all_categories"),
    )


def ranked(df: DataFrame, partition: str, *order) -> DataFrame:
    """1-based ``rank`` within ``partition``."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(partition).orderBy(*order)))
