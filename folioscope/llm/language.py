"""Language identification: known words by their frequency per language, unseen words by shorter and shorter n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from folioscope.llm.common import map_batches, ready, stored

UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
# longest run of letters looked at as one word; longer ones are cut into words of this length, none of them dropped
LONGEST_WORD = 64
# of the digests of units
SEED = 42
SALTS = 16


@dataclass(frozen=True)
class LanguageParams:
    """Texts of at most ``sample_rows`` labelled keys are learned from, the first by a hash of the key, and beside them the
    first keys of every language up to ``least_rows``, so that each language of the table is learned; the model keeps every
    word and every n-gram of these texts. All texts are scored."""

    sample_rows: int = 20_000
    least_rows: int = 100
    longest: int = 4
    smoothing: float = 0.5
    cache_words: int = 100_000


def words_of(text: str) -> Iterator[str]:
    for run in LETTERS.findall(text.lower()):
        if len(run) <= LONGEST_WORD:
            yield run
        else:
            yield from (run[i : i + LONGEST_WORD] for i in range(0, len(run), LONGEST_WORD))


def units_of(words: Counter, longest: int) -> Iterator[tuple[int, str, int]]:
    """(0, word, n) and (length, n-gram, n) of counted words; words are bounded by blanks for their n-grams."""
    grams: Counter = Counter()
    for word, n in words.items():
        yield 0, word, n
        padded = f" {word} "
        for length in range(1, longest + 1):
            for i in range(len(padded) - length + 1):
                grams[length, padded[i : i + length]] += n
    for (length, gram), n in grams.items():
        if gram != " ":
            yield length, gram, n


def digests(units: Iterable[str]) -> np.ndarray:
    """64-bit digests, the same that Spark's ``xxhash64`` gives."""
    return np.fromiter((xxh64_intdigest(u.encode(), SEED) for u in units), dtype=np.uint64)


@dataclass
class LanguageModel:
    """Known words (length 0) and n-grams by their digests, with the languages that have them.

    ``keys[n]`` has the sorted digests of the units of length n, numbered on over all lengths. Unit ``u`` occurs in the
    languages ``langs[starts[u] : starts[u + 1]]``, where its log frequency is higher by ``gains`` than that of an absent unit,
    ``floors[n]``; so the model grows with the occurrences of units in languages, not with units times languages.
    """

    languages: list[str]
    keys: list[np.ndarray]
    starts: np.ndarray
    langs: np.ndarray
    gains: np.ndarray
    floors: np.ndarray

    @staticmethod
    def of_counts(languages: list[str], length: np.ndarray, key: np.ndarray, lang: np.ndarray, n: np.ndarray, longest: int, smoothing: float) -> LanguageModel:
        """The model of counts ``n`` of units (length, digest) in languages."""
        totals = np.zeros((longest + 1, len(languages)))
        np.add.at(totals, (length, lang), n)
        floors = np.log(smoothing / (totals + 1))
        order = np.lexsort((lang, key, length))
        length, key, lang, n = length[order], key[order], lang[order], n[order]
        gains = np.log((n + smoothing) / (totals[length, lang] + 1)) - floors[length, lang]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (length[1:] != length[:-1])
        heads = np.flatnonzero(new)
        return LanguageModel(languages, [key[heads][length[heads] == k] for k in range(longest + 1)], np.append(heads, len(key)), lang, gains, floors)

    @property
    def first(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum([len(k) for k in self.keys])))

    def units(self, length: int, names: list[str]) -> np.ndarray:
        """Numbers of the units, -1 for unknown ones."""
        keys, asked = self.keys[length], digests(names)
        if not len(keys):
            return np.full(len(names), -1)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where(keys[at] == asked, at + self.first[length], -1)

    def back_off(self, words: list[str]) -> list[list[int]]:
        """N-grams of unseen words: from each place the longest known one, shorter lengths where there is none."""
        longest = len(self.keys) - 1
        padded = [f" {word} " for word in words]
        places = [(w, i) for w, word in enumerate(padded) for i in range(max(1, len(word) - longest + 1))]
        found = np.full(len(places), -1)
        for length in range(longest, 0, -1):
            open_ = np.flatnonzero(found < 0)
            if not len(open_):
                break
            names = [padded[w][i : i + length] for w, i in (places[p] for p in open_.tolist())]
            known = self.units(length, names)
            # a shorter end of the word is a unit of its own length
            known[np.fromiter((len(name) < length for name in names), dtype=bool, count=len(names))] = -1
            found[open_] = known
        grams: list[list[int]] = [[] for _ in words]
        for (w, _), unit in zip(places, found.tolist()):
            if unit >= 0:
                grams[w].append(unit)
        return grams

    def resolve(self, words: list[str]) -> list[list[int]]:
        """The units that stand for each word: itself if it is known, else its n-grams."""
        known = self.units(0, words).tolist()
        unseen = iter(self.back_off([w for w, unit in zip(words, known) if unit < 0]))
        return [[unit] if unit >= 0 else next(unseen) for unit in known]

    def predict(self, texts: list[str | None], cache: dict[str, list[int]], bound: int) -> list[tuple[str, float]]:
        """Language and posterior share of every text; ``cache`` keeps the units of up to ``bound`` words."""
        counted = [Counter(words_of(text or "")) for text in texts]
        new = list({word for counts in counted for word in counts if word not in cache})
        found = dict(zip(new, self.resolve(new))) if self.languages else {}
        room = max(bound - len(cache), 0)
        cache.update(islice(found.items(), room))
        return [self._best(counts, cache, found) for counts in counted]

    def _best(self, counts: Counter, cache: dict[str, list[int]], found: dict[str, list[int]]) -> tuple[str, float]:
        if not counts or not self.languages:
            return UNDETERMINED, 0.0
        units: list[int] = []
        weights: list[float] = []
        for word, n in counts.items():
            own = cache.get(word)
            own = found[word] if own is None else own
            units += own
            weights += [n / max(len(own), 1)] * len(own)
        rows, weight = np.array(units, dtype=np.int64), np.array(weights)
        kind = np.searchsorted(self.first, rows, side="right") - 1
        total = np.bincount(kind, weight, minlength=len(self.keys)) @ self.floors
        sizes = self.starts[rows + 1] - self.starts[rows]
        at = np.repeat(self.starts[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        total += np.bincount(self.langs[at], self.gains[at] * np.repeat(weight, sizes), minlength=len(self.languages))
        share = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.languages[best], float(share[best] / share.sum())


def sampled_keys(keyed: DataFrame, params: LanguageParams) -> DataFrame:
    """``key, lang`` of the first ``sample_rows`` keys by hash and of the first ``least_rows`` keys of every language."""
    pairs = keyed.select("key", "lang").distinct().withColumn("hash", F.xxhash64(F.col("key").cast("string")))
    keys = pairs.select("key", "hash").distinct().orderBy("hash", "key").limit(params.sample_rows)
    first = pairs.join(F.broadcast(keys), "key", "left_semi").select("key", "lang")
    # ranked in salted parts first, so that a language with most of the keys is spread
    quota = pairs.withColumn("salt", F.pmod("hash", F.lit(SALTS)))
    for by in (["lang", "salt"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("hash", "key"))
        quota = quota.withColumn("place", place).where(F.col("place") <= params.least_rows)
    return first.unionByName(quota.select("key", "lang")).distinct()


def learn_languages(labelled: DataFrame, params: LanguageParams, key: str, text: str, lang: str) -> LanguageModel:
    """Counts of words and n-grams per language, taken on Spark over the sampled texts; their digests come to the driver.

    Null keys, languages and texts teach nothing; no labelled rows give a model without languages.
    """
    longest = params.longest
    keyed = labelled.select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    keyed = keyed.where("key is not null and lang is not null and text is not null")
    sample = keyed.join(F.broadcast(sampled_keys(keyed, params)), ["key", "lang"], "left_semi").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, Counter] = {}
            for lang_, text_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang_, Counter()).update(words_of(text_))
            rows = [(name, *unit) for name, words in by_lang.items() for unit in units_of(words, longest)]
            if rows:
                names, lengths, units, n = zip(*rows)
                yield pa.RecordBatch.from_pydict({"lang": names, "length": lengths, "unit": units, "n": n})

    counted = sample.mapInArrow(count, "lang string, length long, unit string, n long").groupBy("lang", "length", "unit").agg(F.sum("n").alias("n"))
    counted = stored(counted, "language-units")
    # every unit of the sampled texts, as digests and numbers
    kept = counted.select("lang", "length", F.xxhash64("unit").alias("key"), "n").toArrow()
    names = kept["lang"].combine_chunks().dictionary_encode()
    ranks = {name: i for i, name in enumerate(sorted(names.dictionary.to_pylist()))}
    place = np.array([ranks[name] for name in names.dictionary.to_pylist()], dtype=np.int32)
    lang = place[names.indices.to_numpy(zero_copy_only=False)] if len(names) else np.zeros(0, dtype=np.int32)
    length, key, n = (kept[c].to_numpy() for c in ("length", "key", "n"))
    return LanguageModel.of_counts(list(ranks), length, key.view(np.uint64), lang, n, longest, params.smoothing)


def identify_languages(docs: DataFrame, model: LanguageModel, params: LanguageParams, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ``lang_pred`` and ``score`` (posterior share of the language, 0 to 1) of every row, in one pass.

    ``und`` with score 0 where the text is null or has no letter, or where nothing was learned. Equal scores go to the
    first language by code point. Repeated rows get equal answers; no rows give no rows.
    """
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(model)
    bound = params.cache_words
    given = docs.select(*[F.col(k) for k in keys], F.col(text).cast("string").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    cache: dict[str, list[int]] = {}

    def convert(batch: pa.RecordBatch):
        answers = shared.value.predict(batch.column(len(keys)).to_pylist(), cache, bound)
        yield from (batch.column(i) for i in range(len(keys)))
        yield [a[0] for a in answers]
        yield [a[1] for a in answers]

    return map_batches(given, convert, f"{kinds}, lang_pred string, score double")
