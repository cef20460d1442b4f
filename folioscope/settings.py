"""Workload defaults and physical size limits, all overridable per call."""

from __future__ import annotations

from dataclasses import dataclass

# Defaults of the workload itself.
MAX_TERMS = 10_000
EMBEDDING_DIM = 384
ENCODE_BATCH = 64
TOP_K = 10
SEARCH_LIMIT = 20
PREVIEW_CHARS = 200
EVAL_QUERIES = 100
SWEEP_QUERIES = 200
SWEEP_KS = (5, 10, 20)
SVD_COMPONENTS = 100
K_MIN = 3
K_MAX = 20
RESTARTS = 10
SEED = 42
KEYWORDS_PER_CLUSTER = 10
CLUSTER_TERM_CAP = 1_000
GLOBAL_TERM_CAP = 2_000
MAP_POINTS = 1_500
MAP_COLOURS = 20


@dataclass(frozen=True)
class Limits:
    """Bounds that decide between a broadcast plan and a shuffle plan.

    They are checked against the data before a plan is chosen; data beyond a broadcast bound takes the other plan,
    which gives the same rows.
    """

    broadcast_rows: int = 200_000
    # vector entries (index/weight pairs or dense components) shipped to every Python worker
    block_entries: int = 4_000_000


LIMITS = Limits()
