"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.session import ship_package
from folioscope.sources.tables import scratch_path, write_parquet

# rows handed to a Python worker at once; texts are whole, so a batch must stay small
BATCH_ROWS = 256


def ready(spark: SparkSession) -> None:
    """Ship the code to the workers, bound the batches they get and hold the cut of files into splits.

    The cut follows the number of cores at the time of a scan. Rows told apart by their place in the scan need the same
    cut in every scan, also after an executor was lost in between.
    """
    ship_package(spark)
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def told_apart_by_place(df: DataFrame) -> DataFrame:
    """``df``, if its rows come straight from a scan, so that their places are the same in every run.

    Rows that a shuffle deals out have no place of their own: such a table has to be stored first.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        raise ValueError("rows are told apart by their place in the scan: store the table first")
    return df


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, with underscores before it until no column has this name."""
    while wanted.lower() in {c.lower() for c in taken}:
        wanted = f"_{wanted}"
    return wanted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(key: Column, modulus: int) -> Column:
    """``crc32(key as text) mod modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def map_batches(df: DataFrame, convert: Callable[[pa.RecordBatch], Iterable], schema: str) -> DataFrame:
    """``mapInArrow`` of a function that turns one batch into column lists (or arrays), in schema order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield columns(convert(batch), wanted)

    wanted = arrow_schema(df.sparkSession, schema)
    return df.mapInArrow(run, schema)


def columns(values: Iterable, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for v, f in zip(values, schema)]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)
