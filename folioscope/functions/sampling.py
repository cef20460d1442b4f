"""Seeded sampling order: repeatable on any cluster and any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_key(seed: int, id_col: str = "id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col)))
