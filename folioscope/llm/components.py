"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import stored


def _stars(pairs: DataFrame, keep: str) -> DataFrame:
    """Link the neighbours ``v`` of each ``u`` that ``keep`` names to the least id of u's closed neighbourhood."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is the least id that can be reached.

    Large and small stars alternate until nothing changes (Kiveris et al., 2014). Each round is a few joins and
    minima; hubs are pre-aggregated by ``min`` and split by skew joins. Every round is written to shared storage.
    Self links, repeated and reversed edges are allowed; null ends are ignored; no edges give no rows.
    """
    both = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    links = stored(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        mirrored = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(mirrored, "v > u").where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        links = stored(small.where("u <> v").distinct(), "edges")
        seen = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == state:
            roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
