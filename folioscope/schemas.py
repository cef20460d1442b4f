"""Explicit schemas. Ids are strings everywhere so that leading and trailing zeros survive."""

from __future__ import annotations

from pyspark.sql import types as T

PAPER = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("categories", T.StringType()),
        T.StructField("authors", T.StringType()),
    ]
)
PAPER_FIELDS = [f.name for f in PAPER.fields]

# seq is the position of the row in its source: the tie-breaker of every ranking.
SEQUENCED_PAPER = T.StructType([*PAPER.fields, T.StructField("seq", T.LongType())])

CLEAN_FIELDS = ["cleaned_title", "cleaned_abstract", "final_text"]

VOCABULARY = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("ctf", T.LongType()),
        T.StructField("df", T.LongType()),
        T.StructField("idf", T.DoubleType()),
        T.StructField("term_idx", T.IntegerType()),
    ]
)
