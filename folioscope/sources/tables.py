"""Stage tables: Parquet (or CSV) snapshots, existence checks and load-or-build."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scratch_root(spark: SparkSession) -> str:
    """Folder for stage tables, shared by all executors.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset (a local test session) is a
    machine-local folder made, and then only once per session.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("folioscope.scratch", None)
        if not root:
            if not spark.sparkContext.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="folioscope-")
            spark.conf.set("folioscope.scratch", root)
    return f"{root.rstrip('/')}/folioscope/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """True when a finished write lies at ``path`` (looked up in the path's own file system)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    marker = hadoop.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None when it is absent and the caller has to build it."""
    return spark.read.parquet(path) if exists(spark, path) else None


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Load the table at ``path`` if it is there, else build it, store it and read it back.

    Reading back cuts the lineage at durable storage, so a lost executor costs a re-read and not a rebuild.
    """
    if not exists(spark, path):
        write_parquet(build(), path)
    return spark.read.parquet(path)


def digest_of_rows(df: DataFrame) -> str:
    """Number of rows and a digest of their contents, whatever their order; one pass, nothing is shuffled."""
    row = F.struct(*df.columns)
    sums = [F.sum(F.xxhash64(F.lit(salt), row).cast("decimal(38,0)")) for salt in (1, 2)]
    n, *parts = df.agg(F.count("*"), *sums).first()
    return "-".join(str(p) for p in (n, *parts))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV snapshot with header; everything quoted, so that newlines and empty strings survive."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "\\N")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Snapshot written by ``write_csv``; the explicit schema keeps ids as strings."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "\\N")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_keywords_json(keywords: DataFrame, path: str) -> None:
    """Cluster keywords as JSON lines ``{"cluster_id": .., "keywords": [..]}``."""
    keywords.select("cluster_id", "keywords").write.mode("overwrite").json(path)


def read_keywords_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("cluster_id int, keywords array<string>").json(path)


def append_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").parquet(path)
