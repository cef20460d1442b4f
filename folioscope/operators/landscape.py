"""The two-dimensional map of the corpus as a table: sample, viewport coordinates, colours and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.sampling import sample_key
from folioscope.operators.carry import carrier
from folioscope.operators.keywords import cluster_sizes, keyword_labels
from folioscope.settings import MAP_COLOURS, MAP_POINTS, SEED

# Drawing area, its margins and the share of padding around the points.
VIEW = {"x": 800, "y": 540}
MARGINS = {"x": (60, 20), "y": (40, 60)}
PADDING = 0.05


def stratified_sample(
    clusters: DataFrame, max_points: int = MAP_POINTS, seed: int = SEED, highlight: str | None = None
) -> DataFrame:
    """``(id, cluster_id)``: all rows up to ``max_points``, beyond that each cluster's exact proportional quota.

    A quota is the whole part of ``max_points * share``, at least 1. The highlighted id is always included.

    A row's place in the draw is its seeded md5. Counting the first four hex digits per cluster tells up to which
    digits rows can still be within the quota; the rest is dropped before anything is ranked, so even a cluster
    holding most of the corpus leaves little more than its quota to sort.
    """
    keyed = clusters.select("id", "cluster_id", sample_key(seed).alias("key"))
    digits = F.substring("key", 1, 4)
    counts = keyed.groupBy("cluster_id", digits.alias("digits")).agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("cluster_id").orderBy("digits").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("reached", F.sum("n").over(so_far)).join(cluster_sizes(clusters), "cluster_id")
    total = clusters.agg(F.count("*").alias("total")).scalar()
    drawn = F.greatest(F.lit(1), F.floor(max_points * F.col("share")))
    quota = F.when(F.col("total") <= max_points, F.col("size")).otherwise(drawn)
    cuts = (
        running.withColumn("total", total)
        .withColumn("quota", quota)
        .where(F.col("reached") >= F.col("quota"))
        .groupBy("cluster_id")
        .agg(F.min("digits").alias("last_digits"), F.first("quota").alias("quota"))
    )
    near = keyed.join(carrier(cuts)(cuts), "cluster_id").where(digits <= F.col("last_digits"))
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy("key", "id"))
    chosen = near.withColumn("place", place).where(F.col("place") <= F.col("quota")).select("id", "cluster_id")
    if highlight is not None:
        chosen = chosen.unionByName(clusters.where(F.col("id") == highlight).select("id", "cluster_id")).distinct()
    return chosen


def _scaled(axis: str, low: Column, high: Column) -> Column:
    span = high - low
    pad = F.when(span > 0, span * PADDING).otherwise(F.lit(1.0))
    before, after = MARGINS[axis]
    return before + (F.col(axis) - (low - pad)) / (span + 2 * pad) * (VIEW[axis] - before - after)


def viewport(points: DataFrame) -> DataFrame:
    """Adds ``cx`` and ``cy``, the drawing coordinates of ``x`` and ``y``; equal values get a padding of 1."""
    range_of = {axis: F.struct(F.min(axis).alias("low"), F.max(axis).alias("high")).alias(axis) for axis in VIEW}
    limits = points.agg(F.struct(*range_of.values()).alias("limits")).scalar()
    scaled = {f"c{axis}": _scaled(axis, limits[axis]["low"], limits[axis]["high"]) for axis in VIEW}
    return points.withColumns(scaled)


def map_points(
    clusters: DataFrame,
    coords: DataFrame,
    keywords: DataFrame,
    highlight: str | None = None,
    max_points: int = MAP_POINTS,
    seed: int = SEED,
) -> DataFrame:
    """``(id, cluster_id, cx, cy, color_idx, label, highlighted, shown, total)`` for the points of the map."""
    sample = stratified_sample(clusters, max_points, seed, highlight)
    # a sample has at most one row per map point and cluster
    placed = viewport(coords.select("id", "x", "y").join(carrier(sample)(sample), "id"))
    labels = keyword_labels(keywords)
    named = placed.join(carrier(labels)(labels), "cluster_id", "left")
    fallback = F.concat(F.lit("Cluster "), F.col("cluster_id").cast("string"))
    chosen = F.col("id") == highlight if highlight is not None else F.lit(False)
    return named.select(
        "id",
        "cluster_id",
        "cx",
        "cy",
        (F.col("cluster_id") % MAP_COLOURS).alias("color_idx"),
        F.coalesce("label", fallback).alias("label"),
        chosen.alias("highlighted"),
        sample.agg(F.count("*").alias("shown")).scalar().alias("shown"),
        clusters.agg(F.count("*").alias("total")).scalar().alias("total"),
    )


def map_note(points: DataFrame) -> DataFrame:
    """The line under the map: ``Showing n of N papers``."""
    counts = points.agg(F.count("*").alias("shown"), F.max("total").alias("total"))

    def grouped(c: str) -> Column:
        return F.format_number(c, 0)

    note = F.concat(F.lit("Showing "), grouped("shown"), F.lit(" of "), grouped("total"), F.lit(" papers"))
    return counts.select("shown", "total", note.alias("note"))
