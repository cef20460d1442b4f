"""Corpus cleaning: per-row column expressions plus the corpus-wide noun lemma job."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text as tx
from folioscope.functions.wordlists import CLEANING_STOP_WORDS
from folioscope.settings import LIMITS, Limits

# Noun suffix rules (ending -> replacement), in order of precedence.
NOUN_RULES = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)
INFLECTED = r"(s|men)$"

TEXT_COLUMNS = ("cleaned_title", "cleaned_abstract")


def strip_markup(papers: DataFrame, stop_words: Sequence[str] = CLEANING_STOP_WORDS) -> DataFrame:
    """Adds the cleaned columns without lemmas; title and abstract nulls become empty."""
    return papers.fillna({"title": "", "abstract": ""}).withColumns(
        {
            "cleaned_title": tx.clean_before_lemma("title", stop_words),
            "cleaned_abstract": tx.clean_before_lemma("abstract", stop_words),
        }
    )


def word_counts(cleaned: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Distinct words of the cleaned columns with their counts; summed per task before the shuffle."""
    every_word = F.concat(*[tx.words(c) for c in columns])
    return cleaned.select(F.explode(every_word).alias("form")).groupBy("form").agg(F.count("*").alias("n"))


def _base_forms(form: Column) -> Column:
    """Forms one rule application away, in rule order."""
    rewritten = [
        F.when(
            form.endswith(ending),
            F.concat(F.substring(form, F.lit(1), F.char_length(form) - len(ending)), F.lit(replacement)),
        )
        for ending, replacement in NOUN_RULES
    ]
    return F.filter(F.array(*rewritten), lambda f: f.isNotNull())


def lemma_map(forms: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """``(form, lemma, n)`` for the forms whose lemma differs from the form.

    ``forms`` has ``form`` and its count ``n``. A candidate counts when the lexicon (default: the forms
    themselves) lists it. The form and everything one rule away compete first; only if none is listed are the
    rules applied again to their own output. The shortest listed candidate wins, the earlier one on equal length.
    """
    # a rule applies to the output of another only within a closing run of the letters s and e
    rounds = F.aggregate(
        F.sequence(F.lit(1), F.char_length(F.regexp_extract("form", "[se]*$", 0)) + 2),
        F.array(F.array("form")),
        lambda done, _: F.concat(done, F.array(F.flatten(F.transform(F.element_at(done, -1), _base_forms)))),
    )
    # every form stands for itself in round 0, which also lists it when the forms are the lexicon: one pass over
    # the forms serves both, and no join reads them twice
    options = F.when(F.col("form").rlike(INFLECTED), rounds).otherwise(F.array(F.array("form")))
    own = F.lit(lexicon is None) & (F.col("round") == 0)
    candidates = forms.select("form", "n", F.posexplode(options).alias("round", "options")).select(
        "form", "n", "round", own.alias("lists"), F.posexplode("options").alias("place", "candidate")
    )
    if lexicon is not None:
        listed = lexicon.select(F.col("form").alias("candidate"), F.lit(True).alias("lists"))
        candidates = candidates.unionByName(listed, allowMissingColumns=True)
    known = candidates.withColumn("known", F.max("lists").over(Window.partitionBy("candidate")))
    preference = F.struct(F.greatest("round", F.lit(1)), F.char_length("candidate"), "round", "place")
    chosen = (
        known.where(F.col("known") & F.col("form").rlike(INFLECTED))
        .groupBy("form")
        .agg(F.min_by("candidate", preference).alias("lemma"), F.first("n").alias("n"))
    )
    return chosen.where("lemma <> form").select("form", "lemma", "n")


def corpus_lemma_map(papers: DataFrame, lexicon: DataFrame | None = None, **kw) -> DataFrame:
    return lemma_map(word_counts(strip_markup(papers, **kw)), lexicon)


def _lookup_in_tasks(df: DataFrame, columns: Sequence[str], mapping: DataFrame) -> DataFrame:
    """Bounded map: shipped to the tasks once and looked up by whole Arrow columns; no shuffle."""
    table = mapping.select("form", "lemma").toArrow()
    shipped = df.sparkSession.sparkContext.broadcast(
        (table["form"].combine_chunks().cast(pa.string()), table["lemma"].combine_chunks().cast(pa.string()))
    )

    @F.arrow_udf("string")
    def replace(lists: pa.Array) -> pa.Array:
        forms, lemmas = shipped.value
        flat = lists.flatten().cast(pa.string())
        swapped = pc.coalesce(lemmas.take(pc.index_in(flat, value_set=forms)), flat)
        ends = pc.cumulative_sum(pc.list_value_length(lists)).cast(pa.int32())
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        return pc.binary_join(pa.ListArray.from_arrays(offsets, swapped), " ")

    return df.withColumns({c: replace(tx.words(c)) for c in columns})


def _lookup_by_join(
    df: DataFrame, columns: Sequence[str], mapping: DataFrame, key: str, broadcast_rows: int
) -> DataFrame:
    """Map beyond the bound: the most frequent forms stay a bounded broadcast, the tail is a shuffle join.

    Every form left in the tail is rarer than the broadcast ones, so no join key of the shuffle is hot; words
    that cannot have a lemma take part in no join at all.
    """
    hot = mapping.orderBy(F.desc("n"), "form").limit(broadcast_rows).select("form", F.col("lemma").alias("hot_lemma"))
    tail = mapping.select("form", "lemma").join(F.broadcast(hot.select("form")), "form", "left_anti")

    def in_place(n: int, c: str) -> Column:
        return F.transform(
            tx.words(c), lambda w, i: F.struct(F.lit(n).alias("field"), i.alias("pos"), w.alias("form"))
        )

    placed = F.concat(*[in_place(n, c) for n, c in enumerate(columns)])
    occurrences = df.select(key, F.explode(placed).alias("o")).select(key, "o.*").join(F.broadcast(hot), "form", "left")
    open_words = F.col("hot_lemma").isNull() & F.col("form").rlike(INFLECTED)
    settled = occurrences.where(~open_words).withColumn("word", F.coalesce("hot_lemma", "form"))
    looked_up = occurrences.where(open_words).join(tail, "form", "left").withColumn("word", F.coalesce("lemma", "form"))
    parts = ["field", "pos", "word"]
    words = settled.select(key, *parts).unionByName(looked_up.select(key, *parts))
    rebuilt = words.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*parts))).alias("_words"))

    def text(n: int) -> Column:
        own = F.filter("_words", lambda w: w["field"] == n)
        return F.coalesce(F.array_join(F.transform(own, lambda w: w["word"]), " "), F.lit(""))

    out = df.drop(*columns).join(rebuilt, key, "left").withColumns({c: text(n) for n, c in enumerate(columns)})
    return out.select(*df.columns)


def lemmatize(
    df: DataFrame,
    columns: Sequence[str],
    mapping: DataFrame,
    key: str = "seq",
    limits: Limits = LIMITS,
) -> DataFrame:
    """Replaces each blank-separated word by its lemma; words the map does not list stay. ``key`` is unique.

    Runs one count on ``mapping``, stopped at the bound, to choose the plan.
    """
    if mapping.limit(limits.broadcast_rows + 1).count() <= limits.broadcast_rows:
        return _lookup_in_tasks(df, columns, mapping)
    return _lookup_by_join(df, columns, mapping, key, limits.broadcast_rows)


def with_final_text(cleaned: DataFrame) -> DataFrame:
    return cleaned.withColumn(
        "final_text", tx.collapse_whitespace(F.concat_ws(" ", "cleaned_title", "cleaned_abstract"))
    )


def preprocess(
    papers: DataFrame,
    mapping: DataFrame | None = None,
    stop_words: Sequence[str] = CLEANING_STOP_WORDS,
    key: str = "seq",
    limits: Limits = LIMITS,
) -> DataFrame:
    """Adds ``cleaned_title``, ``cleaned_abstract`` and ``final_text``; lemmas only when a map is given."""
    cleaned = strip_markup(papers, stop_words)
    if mapping is not None:
        cleaned = lemmatize(cleaned, TEXT_COLUMNS, mapping, key, limits)
    return with_final_text(cleaned)
