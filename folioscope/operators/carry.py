"""Which side of a join travels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.settings import LIMITS, Limits


def carrier(
    results: DataFrame, limits: Limits = LIMITS, at_most: int | None = None
) -> Callable[[DataFrame], DataFrame]:
    """How to ship tables of at most as many rows as ``results``: by broadcast within ``broadcast_rows``, else as is.

    ``at_most`` is a bound already known; otherwise ``results`` is counted, stopping at the bound.
    """
    if at_most is None:
        at_most = results.limit(limits.broadcast_rows + 1).count()
    return F.broadcast if at_most <= limits.broadcast_rows else lambda df: df
