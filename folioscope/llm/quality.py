"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting of shallow trees on the bins of one feature at a time learns a lookup table per feature; then the pairs
that explain most of what is left get tables of their own in the same way. A text is scored by adding table entries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import map_batches, ready
from folioscope.llm.features import FEATURES, text_features


@dataclass(frozen=True)
class QualityParams:
    """The model is fitted on at most ``sample_rows`` labelled rows, the first by a hash of their keys."""

    sample_rows: int = 12_000
    bins: int = 64
    pair_bins: int = 8
    pairs: int = 6
    rounds: int = 150
    pair_rounds: int = 60
    leaves: int = 3
    rate: float = 0.1
    ridge: float = 1.0
    threshold: float = 0.3


def _bins(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, values[:, f], side="right") for f, e in enumerate(edges)], axis=1)


def _edges(values: np.ndarray, bins: int) -> list[np.ndarray]:
    """Inner bin borders at quantiles of the distinct values."""
    found = []
    for column in values.T:
        distinct = np.unique(column)
        middle = (distinct[1:] + distinct[:-1]) / 2
        if len(middle) > bins - 1:
            middle = np.unique(np.quantile(column, np.arange(1, bins) / bins, method="midpoint"))
        found.append(middle)
    return found


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Values by bin of a tree with at most ``leaves`` leaves on ordered bins, grown by the best next split."""
    g, h = np.concatenate(([0.0], np.cumsum(gradient))), np.concatenate(([0.0], np.cumsum(weight)))
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
    cuts = [0, len(gradient)]
    for _ in range(leaves - 1):
        best = (1e-12, None)
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a > 1:
                at = np.arange(a + 1, b)
                better = gain(a, at) + gain(at, b) - gain(a, b)
                k = int(np.argmax(better))
                best = max(best, (float(better[k]), int(at[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    values = np.zeros(len(gradient))
    for a, b in zip(cuts[:-1], cuts[1:]):
        values[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return values


def shallow_grid(gradient: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Values of a two-level tree on a pair of features: the best cut of the first, then the best of the second on each side."""
    values = np.zeros_like(gradient)
    best = (-1.0, values)
    for at in range(1, gradient.shape[0]):
        score, grid = 0.0, np.zeros_like(gradient)
        for rows in (slice(0, at), slice(at, None)):
            line_g, line_h = gradient[rows].sum(0), weight[rows].sum(0)
            line = shallow_tree(line_g, line_h, 2, ridge)
            grid[rows] = line
            score += float((2 * line * line_g - line**2 * (line_h + ridge / len(line))).sum())
        if score > best[0]:
            best = (score, grid)
    return best[1]


@dataclass
class AdditiveModel:
    """``tables[f][bin]`` and ``pair_tables[p][bin, bin]`` are log-odds; ``base`` is added to all."""

    edges: list[np.ndarray]
    pair_edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, values: np.ndarray) -> np.ndarray:
        bins, coarse = _bins(values, self.edges), _bins(values, self.pair_edges)
        total = np.full(len(values), self.base)
        for f, table in enumerate(self.tables):
            total += table[bins[:, f]]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[:, a], coarse[:, b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_additive(values: np.ndarray, labels: np.ndarray, params: QualityParams) -> AdditiveModel:
    """Fit on an array of features and 0/1 labels; without rows, or with one class only, the base rate is all."""
    width = values.shape[1]
    edges, coarse_edges = (_edges(values, n) if len(values) else [np.zeros(0)] * width for n in (params.bins, params.pair_bins))
    mean = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(mean / (1 - mean)))
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = AdditiveModel(edges, coarse_edges, base, tables, [], [])
    if not len(values) or labels.min() == labels.max():
        return model
    bins, coarse = _bins(values, edges), _bins(values, coarse_edges)
    total = np.full(len(values), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(params.rounds):
        for f, table in enumerate(tables):
            gradient, weight = slopes()
            size = len(table)
            step = params.rate * shallow_tree(
                np.bincount(bins[:, f], gradient, size), np.bincount(bins[:, f], weight, size), params.leaves, params.ridge
            )
            table += step
            total += step[bins[:, f]]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(coarse_edges[a]) + 1, len(coarse_edges[b]) + 1)
        at = coarse[:, a] * shape[1] + coarse[:, b]
        gradient, weight = slopes()
        size = shape[0] * shape[1]
        return at, np.bincount(at, gradient, size).reshape(shape), np.bincount(at, weight, size).reshape(shape)

    def worth(pair: tuple[int, int]) -> float:
        _, g, h = grid(*pair)
        return float((g**2 / (h + params.ridge)).sum())

    model.pairs = sorted(combinations(range(width), 2), key=worth, reverse=True)[: params.pairs]
    model.pair_tables = [np.zeros((len(coarse_edges[a]) + 1, len(coarse_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(params.pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            at, g, h = grid(a, b)
            step = params.rate * shallow_grid(g, h, params.ridge)
            table += step
            total += step.ravel()[at]
    return model


def featurise(docs: DataFrame, keep: Sequence[str], text: str, features: Callable = text_features) -> DataFrame:
    given = docs.select(*[F.col(k) for k in keep], F.col(text).cast("string").alias("_text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in given.schema.fields[:-1])

    def convert(batch: pa.RecordBatch):
        yield from (batch.column(i) for i in range(len(keep)))
        yield [features(t) for t in batch.column(len(keep)).to_pylist()]

    return map_batches(given, convert, f"{kinds}features array<double>")


def learn_quality(docs: DataFrame, labels: DataFrame, params: QualityParams, key: str = "doc_id", text: str = "text", label: str = "quality") -> AdditiveModel:
    """Fit on labelled documents; rows without a text or a label of 0 or 1, or with a null key, are not learned from."""
    marked = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("_label"))
    order = [F.xxhash64(F.col("_key").cast("string")).alias("_o"), F.col("_key")]
    chosen = marked.select(F.col(key).alias("_key"), "_label").orderBy(*order).limit(params.sample_rows)
    sample = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_text is not null").join(F.broadcast(chosen), "_key")
    rows = featurise(sample, ["_key", "_label"], "_text").orderBy("_key", "features").limit(params.sample_rows).toPandas()
    values = np.array(rows["features"].tolist(), dtype=np.float64).reshape(len(rows), len(FEATURES))
    return fit_additive(values, rows["_label"].to_numpy(dtype=np.float64), params)


def score_quality(docs: DataFrame, model: AdditiveModel, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep`` and ``score`` of every row, in one pass over the whole texts. Null and empty texts have the features of
    an empty text and are scored like the rest; repeated rows get equal scores; no rows give no rows."""
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(model)
    given = docs.select(*[F.col(k) for k in keep], F.col(text).cast("string").alias("_text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in given.schema.fields[:-1])

    def convert(batch: pa.RecordBatch):
        values = np.array([text_features(t) for t in batch.column(len(keep)).to_pylist()])
        yield from (batch.column(i) for i in range(len(keep)))
        yield shared.value.score(values.reshape(batch.num_rows, len(FEATURES)))

    return map_batches(given, convert, f"{kinds}score double")
