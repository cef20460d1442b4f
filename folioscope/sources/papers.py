"""Corpus readers: JSON lines and the papers view over a documents table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.text import one_line
from folioscope.schemas import PAPER
from folioscope.session import ship_package
from folioscope.sources import ordered_lines
from folioscope.sources.tables import scratch_path, write_parquet

OPTIONAL = ("categories", "authors")

# whole rows an ordered limit may gather, and the slices counted where it would gather more
GATHERED_ROWS = 2_000_000
SLICES = 10_000


def parse_paper_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """One JSON object per row -> the five paper fields.

    A malformed or blank line fails the job, and so does a missing required field. An optional field becomes
    ``""`` only when its key is absent; an explicit null stays null. The key list of a line is looked at only
    where the parsed value is null, so complete lines are parsed once.
    """
    parsed = F.from_json(F.col(line), PAPER, {"mode": "FAILFAST", "allowSingleQuotes": "false"})
    checked = F.when(F.trim(F.col(line)) == "", F.raise_error(F.lit("blank line in a JSON-lines corpus"))).otherwise(
        parsed
    )
    carried = [c for c in lines.columns if c != line]
    rows = lines.select(*carried, F.col(line).alias("_line"), checked.alias("_p"))

    def required(name: str):
        return F.coalesce(
            F.col(f"_p.{name}"), F.raise_error(F.concat(F.lit(f"paper without '{name}': "), F.col("_line")))
        )

    def optional(name: str):
        absent = ~F.array_contains(F.json_object_keys("_line"), name)
        return F.when(F.col(f"_p.{name}").isNull() & absent, F.lit("")).otherwise(F.col(f"_p.{name}"))

    return rows.select(
        required("id").alias("id"),
        one_line(required("title")).alias("title"),
        one_line(required("abstract")).alias("abstract"),
        *[optional(name).alias(name) for name in OPTIONAL],
        *carried,
    )


def load_papers(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines corpus with ``seq``, a number that rises in the order of file names and of lines in a file.

    Splits are read in any order: each has its rank among all as the high part of ``seq`` and the line's place in its
    task as the low part. The splits are listed in one pass that reads no fields.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(
                f"No corpus at {path}: download the metadata snapshot (JSON lines) and pass its path."
            ) from error
        raise
    split = ["_metadata.file_path", "_metadata.file_block_start"]
    placed = lines.select("value", *split, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"))
    splits = sorted(tuple(r) for r in lines.select(*split).distinct().collect())
    if not splits:
        return parse_paper_lines(lines.withColumn("seq", F.lit(0).cast("bigint")))
    ranked = spark.createDataFrame([(*s, i) for i, s in enumerate(splits)], "file_path string, file_block_start long, split long")
    placed = placed.join(ranked, ["file_path", "file_block_start"])
    return parse_paper_lines(placed.select("value", (F.shiftleft("split", 33) + F.col("place")).alias("seq")))


def load_ordered_papers(spark: SparkSession, path: str, split_bytes: int = ordered_lines.SPLIT_BYTES) -> DataFrame:
    """The corpus of ``load_papers`` through the data source of ordered lines, in one pass and without a join.

    ``seq`` follows from the file's number and the byte at which a line starts. Lines end in a line feed, with or without a
    carriage return; gzip files (``.gz``) are read whole, one task each. The store must be one that pyarrow can open
    (local, HDFS, S3, GCS); others are read by ``load_papers``.
    """
    ship_package(spark)
    ordered_lines.register(spark)
    lines = spark.read.format("ordered_lines").option("splitBytes", split_bytes).load(path)
    return parse_paper_lines(lines)


def numbered(rows: DataFrame, *order: str, name: str = "place") -> DataFrame:
    """``rows`` with their place from 0 in the order of the given columns, which must tell all rows apart.

    Rows are dealt by range and counted per task; no task sorts or sees them all. What the driver gets is one count per task.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "numbered")
    place = F.monotonically_increasing_id()
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    write_parquet(dealt.withColumns({"_task": F.shiftright(place, 33), name: place.bitwiseAND((1 << 33) - 1)}), path)
    stored = spark.read.parquet(path)
    counts = sorted((r["_task"], r["count"]) for r in stored.groupBy("_task").count().collect())
    before, shifts = 0, []
    for task, n in counts:
        shifts.append((task, before))
        before += n
    shift = spark.createDataFrame(shifts, "_task long, _before long")
    return stored.join(F.broadcast(shift), "_task").withColumn(name, F.col(name) + F.col("_before")).drop("_task", "_before")


def head(papers: DataFrame, n: int | None, gathered_rows: int = GATHERED_ROWS) -> DataFrame:
    """The first ``n`` rows in sequence order; ``None`` or 0 keeps all.

    A plain ordered limit gathers up to ``n`` whole rows from every task. Where that would exceed
    ``gathered_rows``, the range of ``seq`` is counted in slices first, and only the slices that hold the first
    ``n`` rows are read in full.
    """
    if not n:
        return papers
    if papers.rdd.getNumPartitions() * n > gathered_rows:
        ends = papers.agg(F.min("seq").alias("low"), F.max("seq").alias("high")).first()
        low, high = ends.low or 0, ends.high or 0
        width = (high - low) // SLICES + 1
        slices = papers.groupBy(F.expr(f"(seq - {low}L) div {width}L").alias("slice")).count().collect()
        reached = 0
        for row in sorted(slices, key=lambda r: r.slice):
            reached += row["count"]
            if reached >= n:
                papers = papers.where(F.col("seq") < low + (row.slice + 1) * width)
                break
    return papers.orderBy("seq").limit(n)


def papers_from_documents(documents: DataFrame) -> DataFrame:
    """Papers view over ``documents``: the title is the first line, language and source are the categories."""
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("abstract"),
        F.concat_ws(" ", "lang", "source").alias("categories"),
        F.lit("").alias("authors"),
        F.col("doc_id").alias("seq"),
    )


def vectors_from_embeddings(embeddings: DataFrame) -> DataFrame:
    """Dense features over ``embeddings``; the label serves as category and as a given clustering."""
    return embeddings.select(
        F.col("vec_id").cast("string").alias("id"),
        F.col("vec_id").alias("seq"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("int").alias("label"),
    )


def spread(df: DataFrame, key: str = "seq") -> DataFrame:
    """A table that arrives in fewer splits than there are cores (one small file) is hashed over them.

    A large table has many splits and passes through unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
