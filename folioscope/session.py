"""Session settings the jobs expect; a cluster session that already exists is used as it is."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent


def build_session(app_name: str = "folioscope", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package's code to the Python workers of this application, once."""
    context = spark.sparkContext
    archive = f"{PACKAGE.name}.zip"
    if archive not in context._python_includes:
        folder = tempfile.mkdtemp(prefix=f"{PACKAGE.name}-code-")
        context.addPyFile(shutil.make_archive(f"{folder}/{PACKAGE.name}", "zip", PACKAGE.parent, PACKAGE.name))
