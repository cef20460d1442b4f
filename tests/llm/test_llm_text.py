"""Tiling, languages, personal data, URL lists, token counts, quality, mixing and the pipeline."""

from __future__ import annotations

import random
import re
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from folioscope.llm import language, mixing, pii, quality, queries, stages, tiling, tokens, url_lists
from folioscope.llm.common import fold, ready, stored, table

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


# ---------------------------------------------------------------- tiling


def plain_tiles(item, text, minimum):
    """Greedy string tiling without hashes: longest free match first, until none is long enough."""
    a, b, tiles = [x >= 0 for x in item], [x >= 0 for x in text], []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for t in range(len(text)):
                k = 0
                while i + k < len(item) and t + k < len(text) and item[i + k] == text[t + k] and a[i + k] and b[t + k]:
                    k += 1
                if (-k, i, t) < (-best[0], best[1], best[2]):
                    best = (k, i, t)
        k, i, t = best
        if k < minimum:
            return tiles
        a[i : i + k] = [False] * k
        b[t : t + k] = [False] * k
        tiles.append((i, t, k))


def test_tiles_equal_plain_tiling():
    rng = np.random.default_rng(4)
    for _ in range(60):
        item = rng.integers(0, 3, rng.integers(1, 14)).astype(np.int64)
        text = rng.integers(-1, 3, rng.integers(1, 30)).astype(np.int64)
        got = tiling.greedy_tiles(item, text, 3)
        wanted = plain_tiles(item.tolist(), text.tolist(), 3)
        assert sum(t[2] for t in got) == sum(t[2] for t in wanted)
        for i, t, k in got:
            assert k >= 3 and (item[i : i + k] == text[t : t + k]).all()


def test_contaminated_pairs(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    turned = "seven eight nine ten eleven twelve and then one two three four five six"
    docs = [
        (1, "Before. One, two THREE four five six seven eight nine ten eleven twelve! after"), (2, turned), (3, "one two three four five six"),
        (4, None), (5, ""), (6, "one two three four"), (None, item), (7, item), (7, item), (8, "word " * 50_000 + item),
    ]
    frame = spark.createDataFrame([(*d, "s", 1.0) for d in docs], DOCS + ", item_id string, coverage double")
    items = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "too short", 0), (4, "", 0), (None, item, 0)], "item_id long, text string, doc_id int")
    for params in (tiling.TilingParams(), tiling.TilingParams(block_words=2)):
        got = tiling.contaminated_pairs(frame, items, params).collect()
        assert Counter((r.doc_id, r.item_id) for r in got) == Counter((d, i) for d in (1, 2, None, 7, 7, 8) for i in (1, None))
        assert {r.tiles for r in got if r.doc_id == 2} == {2} and {r.coverage for r in got} == {1.0}
        clean = tiling.drop_contaminated(frame, items, params)
        assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 6] and clean.columns == frame.columns
    assert tiling.contaminated_pairs(frame.limit(0), items).count() == 0
    assert tiling.contaminated_pairs(frame, items.limit(0)).count() == 0
    assert tiling.drop_contaminated(frame, items.limit(0)).count() == len(docs)


def test_pairs_equal_plain_tiling_of_all_pairs(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(9)]
    items = [(i, " ".join(rng.choices(words[: rng.randint(2, 9)], k=rng.randint(0, 12)))) for i in range(40)] + [(40, "?!"), (41, "w1"), (42, "w1")]
    docs = [(i, " ".join(rng.choices([*words, "other", *(t for _, t in items if t)], k=rng.randint(0, 12)))) for i in range(60)]
    found = tiling.contaminated_pairs(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()
    wanted = set()
    for i, item in items:
        for d, text in docs:
            known = {w: n for n, w in enumerate(dict.fromkeys(tiling.words_of(item)))}
            a, b = [known[w] for w in tiling.words_of(item)], [known.get(w, -1) for w in tiling.words_of(text)]
            covered = sum(t[2] for t in plain_tiles(a, b, min(5, len(a)))) if a else 0
            if a and covered >= 0.8 * len(a) and (len(a) >= 5 or covered == len(a)):
                wanted.add((d, i, covered))
    assert {(r.doc_id, r.item_id, r.covered_words) for r in found} == wanted and len(found) == len(wanted)


def test_items_without_blanks_and_short_items_are_found(spark):
    items = [(1, "東京は日本の首都です"), (2, "42"), (3, "so be it"), (4, "...")]
    docs = [(1, "前置き。東京は日本の首都です。後書き"), (2, "東京は大きい"), (3, "it is 42, so be it"), (4, "so be"), (5, "421 ... so, BE it")]
    got = tiling.contaminated_pairs(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.coverage) for r in got} == {(1, 1, 1.0), (3, 2, 1.0), (3, 3, 1.0), (5, 3, 1.0)}


def test_spare_copies_do_not_change_the_tiling():
    rng = random.Random(2)
    shorter = 0
    for _ in range(600):
        kinds, n = rng.randint(1, 4), rng.randint(3, 8)
        item = np.array([rng.randrange(kinds) for _ in range(n)])
        base, text = [rng.randrange(-1, kinds) for _ in range(rng.randint(1, 12))], []
        while len(text) < rng.randint(100, 500):
            text += base if rng.random() < 0.9 else [rng.randrange(-1, kinds) for _ in range(rng.randint(1, 20))]
        cut = tiling.without_spare_copies(np.array(text), n, 3)
        shorter += len(cut) < len(text)
        assert [(t[0], t[2]) for t in tiling.greedy_tiles(item, cut, 3)] == [(t[0], t[2]) for t in tiling.greedy_tiles(item, np.array(text), 3)]
    assert shorter > 300


def test_a_phrase_of_many_items_repeated_in_a_text():
    rng = random.Random(3)
    phrase = "the quick brown fox jumps"
    rows = [Row(item=i, text=phrase + " " + " ".join(f"w{rng.randrange(50_000)}" for _ in range(30))) for i in range(10_000)]
    block = tiling.ItemBlock([*rows, Row(item=-1, text=phrase), Row(item=-2, text=f"{phrase} over {phrase} and")], tiling.TilingParams())
    text = " ".join([f"{phrase} over lazy"] * 100_000)
    start = time.time()
    assert {block.keys[k] for k, *_ in block.found(text)} == {-1, -2}
    assert time.time() - start < 5


def test_decontamination_finds_all_whole_items(spark):
    docs, items = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    padded = lambda t: " " + " ".join(tiling.words_of(t)) + " "
    texts = [(r.doc_id, padded(r.text)) for r in docs.collect()]
    whole = {(d, r.item_id) for d, t in texts for r in items.collect() if padded(r.text) in t}
    got = {(r.doc_id, r.item_id) for r in queries.op1_decontaminate(spark, SMALL).collect()}
    assert whole and whole <= got


# ---------------------------------------------------------------- languages


def test_languages_of_held_out_documents(spark):
    got = queries.op2_language(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "documents"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and (held.lang == held.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()


def test_language_edge_cases(spark):
    ready(spark)
    params = language.LanguageParams()
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "de"), (None, "le chien", "fr"), (4, "x", None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    model = language.learn_languages(docs, params, "doc_id", "text", "lang")
    assert model.languages == ["de", "en"]
    asked = spark.createDataFrame([(1, "the dogs"), (2, "hunde"), (3, None), (4, "12 !?"), (5, ""), (6, "q" * 100_000), (None, "and")], DOCS)
    got = {r.doc_id: r for r in language.identify_languages(asked, model, params).collect()}
    assert (got[1].lang_pred, got[2].lang_pred, got[None].lang_pred) == ("en", "de", "en")
    assert {got[k].lang_pred for k in (3, 4, 5)} == {"und"} and got[6].lang_pred in model.languages
    none = language.learn_languages(docs.limit(0), params, "doc_id", "text", "lang")
    assert {r.lang_pred for r in language.identify_languages(asked, none, params).collect()} == {"und"}
    assert language.identify_languages(asked.limit(0), model, params).count() == 0


def test_a_rare_language_is_learned_beside_a_full_sample(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(500)] + [(1000 + i, "der hund schläft im garten", "de") for i in range(2)]
    docs = spark.createDataFrame(rows, DOCS + ", lang string")
    params = language.LanguageParams(sample_rows=5)
    model = language.learn_languages(docs, params, "doc_id", "text", "lang")
    assert model.languages == ["de", "en"] and language.LanguageParams().sample_rows == 20_000
    assert model.predict(["der garten"], {}, 10)[0][0] == "de"
    sizes = Counter(r.lang for r in language.sampled_keys(docs.withColumnRenamed("doc_id", "key"), params).collect())
    assert sizes == {"de": 2, "en": params.least_rows}


def made_up_model(counts, longest=4):
    languages = sorted({lang for lang, *_ in counts})
    rows = [(length, int(language.digests([unit])[0]), languages.index(lang), n) for lang, length, unit, n in counts]
    length, key, lang, n = (np.array(c, dtype=t) for c, t in zip(zip(*rows), (np.int64, np.uint64, np.int32, np.int64)))
    return language.LanguageModel.of_counts(languages, length, key, lang, n, longest, 0.5)


def test_back_off_takes_the_longest_known_gram():
    model = made_up_model([("a", 0, "known", 1), ("b", 1, "x", 2), ("b", 1, "y", 2), ("a", 2, "xy", 1)], 2)
    assert model.back_off(["xy", "zz"]) == [[3, 2], []] and model.resolve(["known"]) == [[0]]


def test_scores_equal_plain_counting():
    rng = random.Random(11)
    counts = Counter()
    texts = [(rng.choice("ABC"), " ".join("".join(rng.choices("abcdé", k=rng.randint(1, 5))) for _ in range(6))) for _ in range(30)]
    for lang, text in texts:
        for length, unit, n in language.units_of(Counter(language.words_of(text)), 4):
            counts[lang, length, unit] += n
    model = made_up_model([(*k, n) for k, n in counts.items()])
    totals = Counter()
    for (lang, length, _), n in counts.items():
        totals[lang, length] += n

    def log(lang, length, unit):
        return np.log((counts[lang, length, unit] + 0.5) / (totals[lang, length] + 1))

    def known(length, unit):
        return any((lang, length, unit) in counts for lang in "ABC")

    def plain(text):
        total = dict.fromkeys("ABC", 0.0)
        for word in language.words_of(text):
            if known(0, word):
                units = [(0, word)]
            else:
                padded = f" {word} "
                picks = ([(k, padded[i : i + k]) for k in range(4, 0, -1) if len(padded[i : i + k]) == k and known(k, padded[i : i + k])] for i in range(max(1, len(padded) - 3)))
                units = [p[0] for p in picks if p]
            for lang in total:
                total[lang] += sum(log(lang, *u) for u in units) / max(len(units), 1)
        share = np.exp(np.array(list(total.values())) - max(total.values()))
        return max(total, key=lambda k: (total[k], -ord(k))), share.max() / share.sum()

    asked = [" ".join("".join(rng.choices("abcdéf", k=rng.randint(1, 7))) for _ in range(rng.randint(1, 8))) for _ in range(60)]
    for (lang, score), text in zip(model.predict(asked, {}, 5), asked):
        wanted = plain(text)
        assert lang == wanted[0] and abs(score - wanted[1]) < 1e-9


def test_two_hundred_languages_take_bounded_memory():
    """Units of their own for every language: the model grows with their number, not with units times languages."""
    rng = np.random.default_rng(5)
    langs, units = 200, 10_000
    key = rng.integers(0, 1 << 63, langs * units).astype(np.uint64)
    lang = np.repeat(np.arange(langs, dtype=np.int32), units)
    length = np.tile(np.arange(units) % 5, langs)
    model = language.LanguageModel.of_counts([f"l{i:03}" for i in range(langs)], length, key, lang, np.ones(len(key), dtype=np.int64), 4, 0.5)
    assert sum(a.nbytes for a in (*model.keys, model.starts, model.langs, model.gains, model.floors)) < 40 * langs * units
    assert model.predict(["abc"], {}, 10)[0][0] in model.languages


def test_repeated_and_clashing_rows_get_equal_answers(spark):
    docs = spark.createDataFrame([(1, "der hund", "de", "x")] * 3 + [(2, "the dog", "en", "y")], "doc_id long, text string, lang string, lang_pred string")
    model = language.learn_languages(docs, language.LanguageParams(), "doc_id", "text", "lang")
    got = Counter(map(tuple, language.identify_languages(docs, model, language.LanguageParams()).collect()))
    assert sorted(got.values()) == [1, 3] and {k[1] for k in got} == {"de", "en"}


# ---------------------------------------------------------------- personal data

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    def luhn(digits):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0

    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" and len(m[0]) < 4000 else kind != "ip",
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


ODD_TEXTS = [
    "a@b.c%d@e.f", "x..y@z.w", "1.2.3.4.5.6.7.8", "999.1.1.1 0001.2.3.004", "4532015112830366 4532-0151-1283-0366", "+1 (988) 555-2485)",
    "é😀 a@b.co +44 20 7946 0958", "1" * 30_000, "a" * 30_000 + "@b.c", "a.b@" * 5_000, "1-" * 5_000, "+1+2 3456789012", "@", "", None,
    "😀" * 10 + "1.2.3.4", "a@b.c a@b.c, 1.1.1.1 " * 700, "a@b" + ".c" * 20_000, "+1" + "(" * 30_000,
]


def test_base_spans_equal_plain_patterns(spark):
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(ODD_TEXTS)], DOCS + ", base string, spans int")
    docs = docs.unionByName(table(spark, SMALL, "documents").select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit("k").alias("base"), F.lit(1).alias("spans")))
    got = {r.doc_id: r.base for r in pii.find_pii(docs).select("doc_id", pii.joined_spans(F.col("base")).alias("base")).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == plain_spans(r.text or ""), (r.text or "")[:60]
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_candidates_see_their_surroundings(spark):
    rng = np.random.default_rng(3)
    parts = ["token=", " ", "é", "abc12345", "Q9-" * 6, "a@b.co ", '"', ": ", "1.2.3.4 ", "x" * 40 + "7"]
    texts = ["".join(rng.choice(parts, 60)) for _ in range(20)] + ["abc12345 " * 1_000 + "a@b.co 1.1.1.1 " * 600]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    near = pii.located(F.col("text"), pii.CANDIDATE, context=True)
    for r in docs.select("text", near.alias("near"), pii.base_spans(F.col("text")).alias("base")).collect():
        assert r.near
        for c in r.near:
            assert (r.text[c.start : c.end], r.text[max(c.start - pii.CONTEXT, 0) : c.start], r.text[c.end : c.end + 1]) == (c.hit, c.left, c.right)
    both = docs.select(near.alias("near"), pii.base_spans(F.col("text")).alias("base"))
    met = both.select("near", "base", pii.let(pii.blocked(F.col("base")), lambda b: F.transform("near", lambda c: pii.overlapped(c, b))).alias("met"))
    for r in met.collect():
        assert r.met == [any(b.start < c.end and b.end > c.start for b in r.base) for c in r.near]


def test_secrets_are_learned_and_redacted(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    planted = {(r.doc_id, m[2]) for r in docs.collect() for m in re.finditer(r'(password=|token = ")([0-9a-f]{10,})', r.text)}
    found = pii.find_pii(docs).select("doc_id", F.explode("spans").alias("s")).where("s.kind = 'secret'").join(docs, "doc_id").collect()
    got = {(r.doc_id, r.text[r.s.start : r.s.end]) for r in found}
    assert planted and len(planted & got) >= 0.95 * len(planted) and len(got) <= 1.2 * len(planted)
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert all(v not in clean[d] for d, v in got) and pii.redact(docs).columns == docs.columns
    few = pii.redact(spark.createDataFrame([(1, "write a@b.co or call +1 (988) 555-2485 é"), (2, None), (3, "")], DOCS))
    assert {r.doc_id: r.text for r in few.collect()} == {1: "write [EMAIL] or call [PHONE] é", 2: None, 3: ""}


def test_secrets_around_card_digits_and_assigned_values_go_whole(spark):
    texts = {
        10**9 + 1: ("x password=a4532015112830366bcdef0123456789abcdef01 y", "x password=[SECRET] y"),
        10**9 + 2: ('x token = "4532015112830366f0e01b4ad40cdbb6ae7f578a" y', 'x token = "[CARD]" y'),
        10**9 + 3: ('then password = "correcthorsebattery" was set', 'then password = "[SECRET]" was set'),
        10**9 + 4: ("login with pwd=ab12x, please", "login with pwd=[SECRET], please"),
        10**9 + 5: ("api_key: 'correct horse battery' token=ab&user=x secret=Tr0ub4dor&3", "api_key: '[SECRET]' token=[SECRET]&user=x secret=[SECRET]"),
        10**9 + 6: ("the author: Ann, a token of love, token: a@b.co", "the author: Ann, a token of love, token: [EMAIL]"),
    }
    odd = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], DOCS)
    for docs in (odd, odd.unionByName(table(spark, SMALL, "documents").select("doc_id", "text"))):
        assert {r.doc_id: r.text for r in pii.redact(docs).where("doc_id > 1000000000").collect()} == {k: c for k, (_, c) in texts.items()}
    long = spark.createDataFrame([(1, "token='" * 20_000), (2, 'pwd="' + ",a" * 50_000), (3, "secret" * 20_000 + "=" + "\\x" * 20_000)], DOCS)
    assert pii.find_pii(long).count() == 3


def test_reliabilities_follow_the_votes():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    right = np.array([0.95, 0.9, 0.6])
    votes = np.where(rng.random((4000, 3)) < right, truth[:, None], ~truth[:, None]) * 2
    counted = Counter("".join(map(str, row)) for row in votes)
    model = pii.estimate_reliabilities(sorted(counted), np.array([float(counted[k]) for k in sorted(counted)]))
    assert abs(model.prior - 0.3) < 0.1 and model.votes[0, 1, 2] > model.votes[2, 1, 2]
    assert pii.estimate_reliabilities([], np.zeros(0)).prior == 0.5


# ---------------------------------------------------------------- URL lists


def test_intervals_and_captures(spark):
    changes = [
        ("l", "a.com", "add", "2024-01-05"), ("l", "a.com", "add", "2024-01-08"), ("l", "a.com", "remove", "2024-02-01"),
        ("l", "a.com", "remove", "2024-02-03"), ("l", "a.com", "add", "2024-03-01"), ("l", "a.com", "remove", "2024-03-01"),
        ("m", "b.a.com", "add", "2024-01-20"), (None, "a.com", "add", "2024-01-01"), ("l", None, "add", "2024-01-01"), ("l", "c.com", "other", "2024-01-01"),
    ]
    changes = spark.createDataFrame(changes, "list string, entry string, action string, at string").withColumn("at", F.to_date("at"))
    spans = url_lists.validity_intervals(changes)
    assert {tuple(map(str, r)) for r in spans.collect()} == {("l", "a.com", "2024-01-05", "2024-02-01"), ("m", "b.a.com", "2024-01-20", "None")}
    captures = [
        (1, "https://x.b.A.com/p", "2024-01-25"), (2, "http://a.com:80", "2024-02-01"), (3, "http://a.com", "2024-01-31"), (4, "http://nota.com", "2024-01-10"),
        (5, None, "2024-01-10"), (6, "http://a.com", None), (None, "http://a.com", "2024-01-05"), (3, "http://a.com", "2024-01-31"), (7, "mail", "2024-01-10"),
    ]
    frame = spark.createDataFrame([(*c, "z") for c in captures], "id long, url string, day string, lists string").withColumn("day", F.to_date("day"))
    got = Counter((r.id, ",".join(r.lists), r.blocked) for r in url_lists.judge_captures(frame, spans, "id", "url", "day").collect())
    assert got == Counter({(1, "l,m", True): 1, (2, "", False): 1, (3, "l", True): 2, (4, "", False): 1, (5, "", False): 1, (6, "", False): 1,
                           (None, "l", True): 1, (7, "", False): 1})
    assert url_lists.judge_captures(frame.limit(0), spans, "id", "url", "day").count() == 0
    assert url_lists.judge_captures(frame, spans.limit(0), "id", "url", "day").where("blocked").count() == 0


def test_url_lists_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    mine = queries.op5_url_lists(spark, SMALL)
    theirs = con.execute(queries.ORACLES["op5_url_lists"])
    names = [d[0] for d in theirs.description]
    assert Counter(map(str, theirs.fetchall())) == Counter(map(str, map(tuple, mine.select(*names).collect())))


# ---------------------------------------------------------------- token counts


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts_and_cache(spark, tmp_path, name, monkeypatch):
    path, cache = public_tokenizers.path(name), f"{tmp_path}/cache"
    texts = [(1, "hello world"), (2, None), (3, ""), (4, "hello world"), (None, "é😀 <s> x"), (4, "hello world"), (5, "a b " * 6000)]
    docs = spark.createDataFrame([(*t, "c", 9) for t in texts], DOCS + ", content string, n_tokens int")
    plain = tokens.counter(path)([t or "" for _, t in texts])
    wanted = Counter((i, len((t or "").encode()), n, n > 4096) for (i, t), n in zip(texts, plain))
    got = tokens.count_tokens(docs, path, cache)
    assert Counter(map(tuple, got.collect())) == wanted
    held = spark.read.parquet(cache)
    assert held.count() == 4
    more = docs.unionByName(spark.createDataFrame([(6, "new", "c", 9)], docs.schema))
    assert tokens.count_tokens(more, path, cache).count() == len(texts) + 1
    assert spark.read.parquet(cache).count() == 5
    assert tokens.count_tokens(docs.limit(0), path, cache).count() == 0


def test_equal_texts_under_null_keys_are_encoded_once(spark, tmp_path):
    path, cache = public_tokenizers.path("piece_bpe_32k.model"), f"{tmp_path}/cache"
    docs = spark.createDataFrame([(None, "same words")] * 50 + [(1, "same words")] * 3, DOCS).repartition(7)
    assert tokens.count_tokens(docs, path, cache).count() == 53 and spark.read.parquet(cache).count() == 1
    more = docs.unionByName(spark.createDataFrame([(i, f"text {i % 40}") for i in range(80)], DOCS))
    assert tokens.count_tokens(more, path, cache).count() == 133 and spark.read.parquet(cache).count() == 41


@pytest.mark.parametrize("sent", [0, 200_000])
def test_few_and_many_new_contents(spark, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(tokens, "SENT_DIGESTS", sent)
    path, cache = public_tokenizers.path("piece_bpe_32k.model"), f"{tmp_path}/cache"
    docs = spark.createDataFrame([(i, f"text {i % 9}") for i in range(40)], DOCS)
    assert tokens.count_tokens(docs.where("doc_id < 5"), path, cache).count() == 5
    assert tokens.count_tokens(docs, path, cache).count() == 40 and spark.read.parquet(cache).count() == 9


def test_a_second_call_encodes_nothing(spark, monkeypatch):
    first = sorted(map(tuple, queries.op6_token_counts(spark, SMALL).collect()))
    monkeypatch.setattr(tokens, "encode_misses", None)
    assert sorted(map(tuple, queries.op6_token_counts(spark, SMALL).collect())) == first


# ---------------------------------------------------------------- quality


def test_quality_of_held_out_documents(spark):
    got = queries.op8_quality(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 40 and (held.predicted == held.quality).mean() > 0.93 and got.score.between(0, 1).all()


def test_additive_model_learns_pairs_and_ignores_noise():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_additive(x, y, quality.QualityParams())
    assert model.pairs[0] == (0, 1) and ((model.score(x) > 0.5) == y).mean() > 0.9
    for labels in (np.zeros(5), np.ones(5)):
        assert np.isfinite(quality.fit_additive(x[:5], labels, quality.QualityParams()).score(x)).all()
    assert quality.fit_additive(np.zeros((0, 3)), np.zeros(0), quality.QualityParams()).score(x).tolist() == [0.5] * 3000


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(i, t, 0.1, "f") for i, t in enumerate(["", None, "x", "a b. " * 50_000, "A!! B!!"])], DOCS + ", score double, features string")
    labels = spark.createDataFrame([(2, 1), (2, 1), (4, 0), (None, 1), (3, None), (3, 7)], "doc_id long, quality int")
    ready(spark)
    model = quality.learn_quality(docs, labels, quality.QualityParams())
    assert quality.score_quality(docs, model, ["doc_id"]).count() == 5
    none = quality.learn_quality(docs, labels.limit(0), quality.QualityParams())
    assert stages.drop_low_quality(docs, none).count() == 5
    assert stages.drop_low_quality(docs.limit(0), model).columns == docs.columns


# ---------------------------------------------------------------- mixing


def plain_targets(sizes, weights, share, cap):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    wanted, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = wanted / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in free}
        for s in full:
            target[s] = float(cap * sizes[s])
            wanted -= target[s]
        free -= full
    return target


def test_mix_of_documents(spark):
    got = queries.op9_mix(spark, "/root/testdata/sf0.01").toPandas()
    docs = {r.doc_id: r for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    sizes = defaultdict(int)
    for r in got.itertuples():
        assert r.size == len(re.findall("[^\x20\x09-\x0d]+", docs[r.doc_id].text))
        sizes[r.source] += r.size
    targets = plain_targets(sizes, (3, 1, 2), 1.5, 2)
    assert len(got) == len(docs) and (got.taken <= 2 * got["size"]).all() and (got.taken % got["size"].clip(1) == 0).all()
    for source, mine in got.groupby("source"):
        assert abs(mine.target.iloc[0] - targets[source]) < 1e-6 * targets[source]
        assert (mine.source_size == sizes[source]).all()
        assert abs(mine.taken.sum() - targets[source]) <= 0.02 * targets[source] + 5
        # the rates are the exponential tilt that meets the target
        assert abs((mine.rate * mine["size"]).sum() - targets[source]) < 1e-4 * targets[source]
        inner = mine[(mine.rate < 1.999) & (mine["size"] > 0)]
        tilt = np.log(inner.rate) / inner["size"]
        assert len(tilt) == 0 or tilt.max() - tilt.min() < 1e-6
    again = queries.op9_mix(spark, "/root/testdata/sf0.01").toPandas()
    assert (got.sort_values("doc_id").taken.to_numpy() == again.sort_values("doc_id").taken.to_numpy()).all()


def test_mix_edge_cases(spark):
    rows = [(1, "a b c", "x"), (2, None, "x"), (3, "", None), (4, "a " * 50, None), (5, "b " * 50, None), (None, "q w", "y"), (6, "q w", "y"), (6, "q w", "y")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], DOCS + ", source string, size int, copies int")
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r.size for r in got)
    assert {r.doc_id: r.size for r in got if r.doc_id} == {1: 3, 2: 0, 3: 0, 4: 50, 5: 50, 6: 2}
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    only = spark.createDataFrame([(1, None, None)], DOCS + ", source string")
    assert [tuple(r)[:3] for r in mixing.mix_sources(only).collect()] == [(1, None, 0)]
    kept = stages.mixed(stored(docs, "t"))
    assert kept.columns == ["doc_id", "text", "source", "size", "copies", "taken"] and all(r.copies > 0 for r in kept.collect())
    clash = stages.mixed(stored(docs.select("*", F.lit(5).alias("_mix_copies"), F.lit("r").alias("row")), "t"))
    assert {(r["_mix_copies"], r["row"]) for r in clash.collect()} == {(5, "r")}


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages_take_effect(spark):
    folder = "/root/testdata/sf0.01"
    docs = stored(table(spark, folder, "documents"), "t")
    names = docs.columns
    scores = None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, folder), "t")
        ids, old = {r.doc_id for r in docs.collect()}, {r.doc_id: r.text for r in before.collect()}
        assert ids <= set(old)
        if name != "mix":
            assert docs.columns == names and docs.dtypes == before.dtypes
        if name == "quality":
            labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").where(fold(F.col("doc_id"), 5) == 0).collect()}
            scores = [(d in ids) == bool(q) for d, q in labels.items()]
        if name == "simhash":
            assert len({t for d, t in old.items() if d in ids}) == len(ids) == len(set(old.values()))
        if name == "decontaminate":
            bad = {r.doc_id for r in tiling.contaminated_pairs(before, table(spark, folder, "benchmark")).collect()}
            assert bad and ids == set(old) - bad
        if name == "pii":
            assert ids == set(old) and not any(plain_spans(r.text) for r in docs.collect())
            assert all(r.n_chars == len(r.text) for r in docs.collect())
    assert sum(scores) > 0.93 * len(scores)
    empty = docs.select(*names).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, stored(empty, "t"), folder).count() == 0
