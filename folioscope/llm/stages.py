"""Whole-table forms of the operators for a corpus pipeline: all columns and all kept rows pass through."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import free_name, ready, told_apart_by_place
from folioscope.llm.features import FEATURES, text_features
from folioscope.llm.mixing import MixParams, mix_sources
from folioscope.llm.quality import AdditiveModel, QualityParams


def drop_low_quality(docs: DataFrame, model: AdditiveModel, params: QualityParams = QualityParams(), text: str = "text") -> DataFrame:
    """``docs`` without the rows scored below the threshold; null and empty texts are scored like the rest."""
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    threshold = params.threshold

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        values = np.array([text_features(t.as_py()) for t in texts]).reshape(len(texts), len(FEATURES))
        return pa.array(shared.value.score(values) >= threshold)

    return docs.where(good(docs[text].cast("string")))


def mixed(docs: DataFrame, params: MixParams = MixParams(), text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``copies`` and ``taken`` words of every document the mix takes; the others go.

    Columns of these names are replaced. Rows are told apart by their place in the scan, so ``docs`` has to be a stored
    table; one that a shuffle deals out is refused.
    """
    ready(docs.sparkSession)
    row = free_name("row", docs.columns)
    numbered = told_apart_by_place(docs).withColumn(row, F.monotonically_increasing_id())
    taken = mix_sources(numbered, params, key=row, text=text, source=source).where("copies > 0")
    taken = taken.select(F.col(row).alias("_mix_row"), F.col("copies").alias("_mix_copies"), F.col("taken").alias("_mix_taken"))
    kept: list[Column] = [numbered[c] for c in docs.columns if c.lower() not in ("copies", "taken")]
    # the mix grows with the corpus: never broadcast, the same join at every size
    joined = numbered.join(taken.hint("merge"), numbered[row] == taken["_mix_row"])
    return joined.select(*kept, taken["_mix_copies"].alias("copies"), taken["_mix_taken"].alias("taken"))
