"""Keyword and pattern search through an index of three-character substrings.

A literal holds all its trigrams and a pattern those of the literals that every match must contain. Rows without them are
never read; the others are read and matched as a scan would match them.
"""

from __future__ import annotations

import re
import re._constants as kinds
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import lookup
from folioscope.operators.carry import carrier
from folioscope.operators.similarity import PUSHED_IDS
from folioscope.settings import LIMITS, SEARCH_LIMIT, Limits
from folioscope.sources.tables import scratch_path, write_parquet

FIELDS = ("title", "abstract")
# characters of texts that are cut into trigrams at once
CHARACTERS = 4_000_000
# rows of a block of postings; trigrams whose rows are intersected before rows are read
BLOCK_ROWS = 4_096
MEETING = 4
# escapes that mean the same to Java and to the parser that looks for literals
SAME_ESCAPES = re.compile(r"\\(?![dDwWsSbBntrf]|[^\w\s])")


@dataclass(frozen=True)
class TrigramIndex:
    """``postings`` (gram, part, n, rows) and ``grams`` (gram, n) of the lower-case fields of ``papers``."""

    postings: DataFrame
    grams: DataFrame
    papers: DataFrame


def _postings_of(seq: np.ndarray, texts: list[list[str]]) -> Iterator[pa.RecordBatch]:
    """``(gram, rows)`` of some rows: their columns' trigrams of code points, a row once for each trigram that it holds."""
    n = len(seq)
    lengths = np.array([len(t) for column in texts for t in column])
    codes = np.frombuffer("".join("".join(column) for column in texts).encode("utf-32-le"), np.uint32)
    present = np.zeros(int(codes.max(initial=0)) + 1, bool)
    present[codes] = True
    known = np.flatnonzero(present).astype(np.uint32)
    place = (np.cumsum(present) - 1)[codes]
    size = len(known)
    if size**3 * n >= 2**63:
        half = n // 2
        yield from _postings_of(seq[:half], [column[:half] for column in texts])
        yield from _postings_of(seq[half:], [column[half:] for column in texts])
        return
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    first = np.flatnonzero(left > 2)
    if not len(first):
        return
    row = np.repeat(np.tile(np.arange(n), len(texts)), lengths)[first]
    found = np.unique(((place[first] * size + place[first + 1]) * size + place[first + 2]) * n + row)
    gram, row = np.divmod(found, n)
    starts = np.flatnonzero(np.diff(gram, prepend=-1))
    gram = gram[starts]
    letters = np.stack([known[gram // size**2], known[gram // size % size], known[gram % size]], axis=1).tobytes().decode("utf-32-le")
    names = pa.array([letters[i : i + 3] for i in range(0, len(letters), 3)], pa.string())
    ends = pa.array(np.append(starts, len(row)), pa.int32())
    yield pa.record_batch([names, pa.ListArray.from_arrays(ends, pa.array(seq[row]))], names=["gram", "rows"])


def _partial_postings(papers: DataFrame) -> DataFrame:
    """``(gram, rows)`` of some hundred rows each, made in the task that reads them: what is grouped later are lists, not single entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, texts, held = [], [[] for _ in FIELDS], 0
        # whatever the size of a batch
        for batch in batches:
            for place, *row in zip(*(batch[c].to_pylist() for c in ("seq", *FIELDS))):
                size = sum(map(len, row))
                if seq and held + size > CHARACTERS:
                    yield from _postings_of(np.array(seq, np.int64), texts)
                    seq, texts, held = [], [[] for _ in FIELDS], 0
                seq.append(place)
                for column, text in zip(texts, row):
                    column.append(text)
                held += size
        if seq:
            yield from _postings_of(np.array(seq, np.int64), texts)

    lowered = papers.where("seq is not null").select("seq", *(F.coalesce(F.lower(c), F.lit("")).alias(c) for c in FIELDS))
    return lowered.mapInArrow(run, "gram string, rows array<bigint>")


def build_index(papers: DataFrame, path: str, limits: Limits = LIMITS) -> TrigramIndex:
    """Write the index of ``papers`` (``seq``, ``title``, ``abstract``) below ``path`` and return it.

    The lists of rows that tasks make of their texts are dealt to parts by a hash, so that a trigram of all rows is grouped
    nowhere. Null fields have no trigrams.
    """
    spark = papers.sparkSession
    write_parquet(_partial_postings(papers), f"{path}/partial")
    partial = spark.read.parquet(f"{path}/partial")
    write_parquet(partial.groupBy("gram").agg(F.sum(F.size("rows")).alias("n")), f"{path}/grams")
    grams = spark.read.parquet(f"{path}/grams")
    parts = grams.where(F.col("n") > BLOCK_ROWS).select("gram", F.ceil(F.col("n") / BLOCK_ROWS).alias("parts"))
    # few trigrams have more than one part: these are known to all tasks, within the bound
    parted = partial.join(carrier(parts, limits)(parts), "gram", "left")
    part = F.pmod(F.xxhash64(F.get("rows", F.lit(0))), F.coalesce("parts", F.lit(1)))
    blocks = parted.groupBy("gram", part.alias("part")).agg(F.collect_list("rows").alias("rows"))
    blocks = blocks.select("gram", "part", F.sort_array(F.flatten("rows")).alias("rows"))
    blocks = blocks.select("gram", "part", F.size("rows").cast("long").alias("n"), "rows")
    write_parquet(blocks.repartitionByRange("gram", "part").sortWithinPartitions("gram", "part"), f"{path}/postings")
    return read_index(spark, path, papers)


def read_index(spark: SparkSession, path: str, papers: DataFrame) -> TrigramIndex:
    """The index stored at ``path`` over the papers that it was built from."""
    return TrigramIndex(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/grams"), papers)


def literal_grams(text: str) -> set[str]:
    return {text[i : i + 3] for i in range(len(text) - 2)}


def required(pattern: str) -> list[set[str]] | None:
    """Trigrams that a match of the pattern contains: all of one of the returned sets. None where nothing is certain.

    Only what the parser and Java surely read alike is used; inline flags, rare escapes and what does not parse give None.
    """
    if SAME_ESCAPES.search(pattern) or re.search(r"\(\?[a-zA-Z^-]|&&|\[[^\]]*\[", pattern):
        return None
    try:
        return _sequence(parser.parse(pattern))
    except (re.error, OverflowError, RecursionError):
        return None


def _sequence(items) -> list[set[str]] | None:
    """Literals in a row make trigrams; of the alternatives inside, the ones with fewest branches count if nothing else does."""
    grams, run, choices = set(), "", []
    for kind, value in items:
        if kind is kinds.LITERAL:
            run += chr(value)
            continue
        grams |= literal_grams(run)
        run = ""
        if kind is kinds.SUBPATTERN:
            choices.append(_sequence(value[3]))
        elif kind is kinds.BRANCH:
            options = [_sequence(option) for option in value[1]]
            choices.append([s for option in options for s in option] if None not in options else None)
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT) and value[0] > 0:
            choices.append(_sequence(value[2]))
        elif kind is kinds.ATOMIC_GROUP:
            choices.append(_sequence(value))
    grams |= literal_grams(run)
    # what must occur once belongs to every alternative
    certain = [c[0] for c in choices if c and len(c) == 1]
    grams = grams.union(*certain)
    if grams:
        return [grams]
    return min((c for c in choices if c), key=len, default=None)


def candidates(index: TrigramIndex, alternatives: list[set[str]], limits: Limits = LIMITS) -> DataFrame:
    """``seq`` of the rows that hold the rarest trigrams of one of the alternatives."""
    spark = index.postings.sparkSession
    wanted = sorted(set().union(*alternatives))
    size = {r.gram: r.n for r in index.grams.where(F.col("gram").isin(wanted)).collect()}
    rarest = [sorted(a, key=lambda g: (size.get(g, 0), g))[:MEETING] for a in alternatives]
    rows = [(n, len(a), gram) for n, a in enumerate(rarest) if all(g in size for g in a) for gram in a]
    asked = spark.createDataFrame(rows, "alternative int, grams int, gram string")
    opened = index.postings.where(F.col("gram").isin([r[2] for r in rows])).join(F.broadcast(asked), "gram")
    held = opened.select("alternative", "grams", F.explode("rows").alias("seq")).groupBy("alternative", "seq").agg(
        F.count("*").alias("n"), F.first("grams").alias("grams")
    )
    return held.where("n = grams").select("seq").distinct()


def search_indexed(
    index: TrigramIndex, query: str, top_k: int = SEARCH_LIMIT, regex: bool = False, limits: Limits = LIMITS, root: str | None = None
) -> DataFrame:
    """The rows that ``lookup.search`` gives, reading candidates only.

    Queries without a certain trigram (short ones, patterns of classes) scan all rows. ``candidates`` below ``root`` holds the
    rows read.
    """
    papers, needle = index.papers, query.lower().strip()
    alternatives = required(needle) if regex else [literal_grams(needle)]
    if not alternatives or not all(alternatives):
        return lookup.search(papers, query, top_k, regex)
    spark = papers.sparkSession
    path = f"{root or scratch_path(spark, 'search')}/candidates"
    write_parquet(candidates(index, alternatives, limits), path)
    found = spark.read.parquet(path)
    few = found.limit(limits.broadcast_rows + 1).count()
    if few <= PUSHED_IDS:
        # named in a filter: the scan skips parts of files that hold none
        papers = papers.where(F.col("seq").isin([r.seq for r in found.collect()]))
    else:
        papers = papers.join(carrier(found, limits, few)(found), "seq", "left_semi")
    return lookup.search(papers, query, top_k, regex)
