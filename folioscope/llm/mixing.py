"""Mixing sources to target weights by entropy balancing.

Document rates r minimise the relative entropy to "every document once", sum(r log r - r + 1) with r <= cap, subject
to sum(r * size) = target in every source. The solution is an exponential tilt by size, r = min(cap, exp(t * size)),
with one multiplier t per source; the convex dual in t is solved by Newton steps over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.common import stored

SALTS = 64
WORD = "[^\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class MixParams:
    """``weights`` repeat over the sources by code point, null last; ``share`` of all sizes is asked for; no document is
    taken more than ``cap`` times. Newton ends at a relative error of ``tolerance`` in every source."""

    weights: Sequence[float] = (3, 1, 2)
    share: float = 1.5
    cap: int = 2
    tolerance: float = 1e-6
    max_steps: int = 200
    # rows of one running sum
    run_rows: int = 5_000
    # single documents per source whose copies are changed by one to come nearer to the target
    repairs: int = 3


def word_sizes(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """``key, source, size`` and ``draw``, a number that orders equal sizes and depends on the content only."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col(key).alias("key"),
        F.col(source).cast("string").alias("source"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.col(key).cast("string"), body).alias("draw"),
    )


def source_targets(totals: DataFrame, params: MixParams) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: shares by weight, none above cap x its size.

    Water filling in one pass over the sources in order of the level at which they are full, cap * size / weight. The
    level that the sources from one on would share rises while earlier ones are full and falls after; its peak is the
    common level.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    listed = F.array(*[F.lit(float(w)) for w in params.weights])
    weighed = totals.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(listed, (F.col("place") % len(params.weights) + 1).cast("int"))
    )
    bound = params.cap * F.col("source_size").cast("double")
    order = Window.orderBy("ratio", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    filled = (
        weighed.withColumn("bound", bound)
        .withColumn("ratio", F.col("bound") / F.col("weight"))
        .withColumn("wanted", params.share * F.sum("source_size").over(whole))
        .withColumn("full", F.coalesce(F.sum("bound").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("wanted") - F.col("full")) / F.sum("weight").over(onward))
        .withColumn("common", F.max("level").over(whole))
    )
    target = F.least(F.col("bound"), F.col("common") * F.col("weight"))
    return filled.select("source", "source_size", target.alias("target"))


def _rate(t: Column, size: Column, cap: int) -> Column:
    return F.least(F.lit(float(cap)), F.exp(t * size))


def solve_tilts(counted: DataFrame, targets: DataFrame, params: MixParams) -> DataFrame:
    """``source`` and its ``tilt``: Newton on the dual of every source at once.

    ``counted`` has the number of documents of each (source, size), which is all the dual depends on. Every step is one
    aggregation over it: gradient and curvature by source. A step that leaves the bracket known so far is replaced by
    its middle, so that it always converges; one-document sources are no special case.
    """
    top = F.log(F.lit(float(params.cap)))
    filled = counted.where("size > 0")
    ends = filled.groupBy("source").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    # rates of cap for every document at the upper end; at the lower end even the shortest documents nearly vanish
    state = ends.join(targets, same(ends, targets)).select(
        ends["source"], "target", (-50.0 / F.col("least")).alias("low"), (top / F.col("least")).alias("high"),
        (F.col("target") >= params.cap * F.col("source_size")).alias("full"), F.lit(False).alias("done"),
    ).withColumn("tilt", F.when(F.col("full"), F.col("high")).otherwise(0.0))
    state = stored(state, "tilts")
    for _ in range(params.max_steps):
        met = filled.join(state, same(filled, state)).drop(state["source"])
        rate = _rate(F.col("tilt"), F.col("size"), params.cap)
        mass = F.col("n") * F.col("size")
        slope = F.when(F.col("tilt") * F.col("size") < top, mass * F.col("size") * rate).otherwise(0.0)
        sums = met.groupBy("source").agg(
            F.sum(mass * rate).alias("taken"), F.sum(slope).alias("slope"), *[F.first(c).alias(c) for c in ("target", "tilt", "low", "high")]
        )
        over = F.col("taken") > F.col("target")
        close = F.abs(F.col("taken") - F.col("target")) <= params.tolerance * F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - (F.col("taken") - F.col("target")) / F.nullif(F.col("slope"), F.lit(0.0))
        inside = (newton > low) & (newton < high)
        step = F.when(inside, newton).otherwise((low + high) / 2)
        width = (high - low) <= 1e-14 * F.greatest(F.abs(low), F.abs(high))
        state = stored(
            sums.select(
                "source", "target", F.when(close, F.col("tilt")).otherwise(step).alias("tilt"), low.alias("low"), high.alias("high"),
                (close | width).alias("done"),
            ),
            "tilts",
        )
        if not state.where("not done").limit(1).count():
            return state.select("source", "tilt")
    raise RuntimeError(f"tilts did not settle in {params.max_steps} steps")


def round_to_copies(rated: DataFrame, params: MixParams) -> DataFrame:
    """``rated`` (``source, size, draw, rate``) with ``copies``: whole numbers around the rate, by systematic rounding.

    Within a source the fractions of the rates are summed up in order of size, and a document gets one more copy
    where the running sum passes a whole number, so copies are spread evenly over sizes and the words taken stay near
    the target. The order is cut into runs of about ``run_rows`` rows; only the sums of the runs meet in one place.
    """
    fraction = F.round(F.col("rate") - F.floor("rate"), 9)
    # size classes of about 3 % width keep the order without a global sort
    band = F.when(F.col("size") == 0, F.lit(-1)).otherwise(F.floor(F.log2(F.col("size").cast("double")) * 24)).cast("int")
    banded = rated.withColumn("fraction", fraction).withColumn("band", band)
    sizes = banded.groupBy("source", "band").agg(F.ceil(F.count("*") / params.run_rows).cast("int").alias("runs"))
    sizes = sizes.withColumnsRenamed({"source": "s_source", "band": "s_band"})
    place = F.col("source").eqNullSafe(F.col("s_source")) & (F.col("band") == F.col("s_band"))
    dealt = banded.join(sizes, place).drop("s_source", "s_band").withColumn("run", F.pmod(F.col("draw"), F.col("runs")).cast("int"))
    order = Window.partitionBy("source").orderBy("band", "run").rowsBetween(Window.unboundedPreceding, -1)
    runs = dealt.groupBy("source", "band", "run").agg(F.sum("fraction").alias("total"))
    starts = runs.select("source", "band", "run", F.coalesce(F.sum("total").over(order), F.lit(0.0)).alias("start"))
    starts = starts.withColumnsRenamed({"source": "s_source", "band": "s_band", "run": "s_run"})
    place = place & (F.col("run") == F.col("s_run"))
    inner = Window.partitionBy("source", "band", "run").orderBy("size", "draw", "key").rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumn("inner", F.sum("fraction").over(inner)).join(starts, place).drop("s_source", "s_band", "s_run")
    upto = F.col("start") + F.col("inner")
    passed = F.floor(F.round(upto, 6) + 0.5) - F.floor(F.round(upto - F.col("fraction"), 6) + 0.5)
    copies = F.least(F.floor("rate") + passed, F.lit(params.cap)).cast("long")
    return summed.withColumn("copies", copies).drop("fraction", "band", "runs", "run", "start", "inner")


def repair(rounded: DataFrame, known: DataFrame, params: MixParams) -> DataFrame:
    """``rounded`` with one copy more or less of a few documents, where that brings a source nearer to its target.

    Each pass takes the document whose size is nearest to what is missing (or too much); two aggregations by source. Rows
    meet their source's gap on a salted key, so that a source with a third of all rows is spread and summed up first.
    """
    rows = stored(rounded.withColumn("row", F.monotonically_increasing_id()), "rounded")
    targets = known.select(F.col("k_source").alias("m_source"), F.col("target").alias("m_target"))
    for _ in range(params.repairs):
        sums = rows.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("sum"))
        gaps = sums.join(targets, F.col("source").eqNullSafe(F.col("m_source"))).select(
            "m_source", (F.col("m_target") - F.col("sum")).alias("gap"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("m_salt")
        )
        salted = F.col("source").eqNullSafe(F.col("m_source")) & (F.pmod(F.col("row"), F.lit(SALTS)) == F.col("m_salt"))
        met = rows.join(gaps, salted)
        more = (F.col("gap") > 0) & (F.col("copies") < params.cap)
        fewer = (F.col("gap") < 0) & (F.col("copies") > 0)
        off = F.abs(F.abs("gap") - F.col("size"))
        better = (more | fewer) & (off < F.abs("gap"))
        best = F.min(F.when(better, F.struct(off.alias("off"), F.col("draw").alias("draw"), F.col("row").alias("row"), F.signum("gap").cast("long").alias("change"))))
        changed = stored(met.groupBy("source").agg(best.alias("b")).where("b is not null").select("b.row", "b.change"), "repairs")
        rows = rows.join(changed, "row", "left").withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0))).drop("change")
    return rows.drop("row")


def mix_sources(
    docs: DataFrame, params: MixParams = MixParams(), key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """``key, source, size, source_size, target, rate, copies, taken`` of every row.

    A null text has size 0; documents of size 0 are kept once and take no words. A null source is a source of its own
    and comes last. Repeated rows are documents of their own; ties in size are ordered by a hash of the content. No rows
    give no rows. Reruns over the same rows agree.
    """
    sized = stored(word_sizes(docs, key, text, source), "sizes")
    counted = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "size-counts")
    totals = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    targets = stored(source_targets(totals, params), "targets")
    tilts = solve_tilts(counted, targets, params).withColumnRenamed("source", "t_source")
    known = targets.join(tilts, F.col("source").eqNullSafe(F.col("t_source")), "left").drop("t_source").withColumnRenamed("source", "k_source")
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(_rate(F.col("tilt"), F.col("size"), params.cap))
    rated = sized.join(known, F.col("source").eqNullSafe(F.col("k_source"))).drop("k_source").withColumn("rate", rate)
    rounded = repair(round_to_copies(rated, params), known, params)
    return rounded.select(
        F.col("key").alias(key), "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
