"""SimHash, vectors and byte repeats against brute force, with nulls, copies and empty tables."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from folioscope.llm import bwt, mixing, repeats, simhash, stages, vectors
from folioscope.llm.common import stored
from folioscope.llm.components import connected_components

DOCS = "doc_id long, text string"


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    out, words = 0, [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1 if words else 0))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    for bit in range(64):
        out |= (2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit
    return out


def test_fingerprint_follows_its_definition(spark):
    texts = ["", None, " \t", "One", "one TWO", "a b c d e f g", "É é A b c d", "x " * 500, "w\x0bq\x0cr\nz"]
    for text in texts:
        assert simhash.fingerprint(text) == plain_fingerprint(text), text
    shingle = "one two three"
    spark_hash = spark.range(1).select(F.xxhash64(F.lit(shingle))).first()[0]
    assert xxhash.xxh64_intdigest(shingle.encode(), 42) == spark_hash % 2**64


def test_groups_equal_brute_force(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 12))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(base)] + [(1000 + i, t + " z") for i, t in enumerate(base)] + [(2000, None), (2001, ""), (2001, ""), (None, base[3])]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS + ", fingerprint string, component_id string")
    got = simhash.simhash_groups(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    prints = {t: plain_fingerprint(t) for _, t in rows}
    links = [(a, b) for a, b in combinations(set(prints.values()), 2) if (a ^ b).bit_count() <= 2]
    root = groups(set(prints.values()), links)
    least = {}
    for i, t in rows:
        if i is not None:
            least[root[prints[t]]] = min(i, least.get(root[prints[t]], i))
    wanted = Counter((i, f"{prints[t]:016x}", least[root[prints[t]]]) for i, t in rows)
    assert Counter(map(tuple, got.collect())) == wanted
    kept = simhash.drop_near_copies(stored(docs, "t"))
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least.values())


def test_simhash_of_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.simhash_groups(empty).count() == 0
    assert simhash.drop_near_copies(stored(empty, "t")).count() == 0


def test_kept_rows_keep_all_columns(spark):
    rows = [(1, "a b c d", 7, 1), (2, "a b c d", 8, 2), (3, None, 9, 3), (None, "a b c d", 9, 4)]
    docs = stored(spark.createDataFrame(rows, DOCS + ", _kept_row int, _row int"), "t")
    got = simhash.drop_near_copies(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [rows[0], rows[2]]
    assert spark.conf.get("spark.sql.files.minPartitionNum")


def test_near_pairs_find_every_pair_at_every_distance(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    values = list(base)
    for v in base:
        for bits in (1, 2, 3):
            flips = rng.choice(64, bits, replace=False)
            values.append(v ^ np.uint64(sum(1 << int(b) for b in flips)))
    values = np.unique(np.array(values, dtype=np.uint64))
    wanted = {tuple(sorted((int(a.view(np.int64)), int(b.view(np.int64))))) for a, b in combinations(values, 2) if int(a ^ b).bit_count() <= 2}
    frame = spark.createDataFrame([(int(v.view(np.int64)),) for v in values], "fp long").repartition(3)
    for parts in (1, 2, 3):
        params = simhash.SimhashParams(parts=parts)
        if parts > 1:
            assert {tuple(r) for r in simhash.near_pairs(frame, params).collect()} == wanted


def test_bounds_of_partitions_sum_up(spark):
    layout = simhash.Layout([list(range(32)), list(range(32, 64))], 2, 4)
    values = np.array([1, 2, 3, 2**40], dtype=np.uint64)
    layout.counts = {s: np.bincount(layout.take(values, bits).astype(int), minlength=1 << len(bits)) for s, (_, bits) in enumerate(layout.slots)}
    assert (layout.shares(values).sum(axis=1) == 1).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 16))
    rows = []
    for c in centres:
        for _ in range(6):
            v = c + rng.standard_normal(16) * rng.choice([0.0, 0.02, 0.06, 0.3])
            rows.append((len(rows), [float(np.float32(x)) for x in v], int(rng.integers(0, 2))))
    n = len(rows)
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [1.0] * 8, [2.0] * 8]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)] + [(n + 20, rows[0][1], None), (n + 21, rows[0][1], rows[0][2])]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    got = {r.vec_id: r for r in vectors.vector_groups(frame, vectors.VectorParams(block=4, tables=24, bits=6)).collect()}

    def good(r):
        return r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])

    usable = [r for r in rows if good(r)]
    links = []
    for a, b in combinations(usable, 2):
        if a[2] == b[2] and len(a[1]) == len(b[1]):
            x, y = np.array(a[1]), np.array(b[1])
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links.append((a[0], b[0]))
    degree = Counter(v for link in links for v in link)
    root = groups([r[0] for r in rows], links)
    least = {}
    for v, k in root.items():
        least[k] = min(v, least.get(k, v))
    assert {v: (got[v].n_links, got[v].component_id, got[v].kept) for v in got} == {
        r[0]: (degree[r[0]], least[root[r[0]]], least[root[r[0]]] == r[0]) for r in rows
    }
    assert vectors.vector_groups(frame.limit(0)).count() == 0


def test_very_small_and_large_vectors_link(spark):
    rows = [[1e-200] * 4, [2e-200] * 4, [1e200] * 4, [2e200] * 4, [1.0] * 4, [2.0] * 4, [5e-324] * 4]
    got = vectors.vector_groups(spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")).collect()
    assert [(r.n_links, r.component_id) for r in got] == [(6, 0)] * 7


def test_candidates_grow_with_the_table(spark):
    """Unlike vectors share buckets about as often at every size: four times the rows meet about four times as often."""
    met = []
    for n in (1000, 4000):
        rows = np.random.default_rng(n).normal(size=(n, 16))
        params = vectors.VectorParams(least_bits=4).settled(n)
        frame = spark.createDataFrame([(i, "a", 1, v) for i, v in enumerate(rows.tolist())], "id long, label string, n long, embedding array<double>")
        signed = stored(vectors.sign_vectors(frame, params), "signs")
        buckets = signed.select(F.posexplode("signs").alias("tab", "sig")).groupBy("tab", "sig").count()
        met.append(buckets.agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0] / params.tables / n)
    assert params.bits == 12 and met[1] < 2 * met[0]
    small, large = vectors.VectorParams().settled(100), vectors.VectorParams().settled(1 << 30)
    assert (small.bits, small.tables, large.bits) == (16, 17, 30) and 40 < large.tables < 60


def test_merged_transforms_equal_brute_force():
    rng = random.Random(2)
    for _ in range(150):
        depth = rng.choice([1, 2, 3, 4, 6, 8, 12])
        letters = bytes(range(97, 97 + rng.choice([1, 2, 4]))) + b"\x00\xff"
        texts = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 8))]
        texts.append(texts[0] + b"xx")
        weights = np.array([rng.choice([1, 1, 2]) for _ in texts])
        text, offset = bwt.repeated_places(texts, weights, depth, rng.choice([1, 10, 1000]))
        counts = Counter()
        for t, w in zip(texts, weights):
            for i in range(len(t) - depth + 1):
                counts[t[i : i + depth]] += w
        wanted = {(k, i) for k, t in enumerate(texts) for i in range(len(t) - depth + 1) if counts[t[i : i + depth]] >= 2}
        assert set(zip(text.tolist(), offset.tolist())) == wanted


def test_common_prefixes_of_merged_rows():
    texts = [b"banana\x00", b"bandana\x00"]
    _, symbols = np.unique(bwt.symbols_of(texts, 1), return_inverse=True)
    shards = [bwt.build_shard([t], symbols[a:b], 1, 8) for t, a, b in ((texts[0], 0, 7), (texts[1], 7, 15))]
    common, _, _ = bwt.merge_shards(shards, 8)
    offsets = np.concatenate([shards[0].offset, shards[1].offset])
    mine = dict(zip(offsets[:7].tolist(), common[:7].tolist()))
    assert mine[0] == 3 and mine[3] == 3 and mine[1] == 3  # ban-, ana, anan/ana


def brute_repeats(texts, length):
    counts = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((bytes(x for x, g in zip(b, gone) if not g), len(b), sum(gone), spans))
    return out


def test_repeats_equal_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abé ") for _ in range(6))
    passages = ["".join(word() for _ in range(10)) for _ in range(4)]
    texts = ["", "short", "aaaa" * 30, "ab" * 50, passages[0] * 2]
    for _ in range(60):
        texts.append("".join(rng.choice([word(), rng.choice(passages)]) for _ in range(rng.randint(1, 6))))
    texts += texts[10:14]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[20], None), (900, None, "x")]
    docs = stored(spark.createDataFrame(rows, DOCS + ", kept string").repartition(4), "t")
    wanted = Counter(zip([r[0] for r in rows], brute_repeats([(r[1] or "").encode() for r in rows], 40)))
    # merged transforms, and single windows for all but the smallest groups; texts in parts
    for most, part in ((1000, 1 << 22), (2, 64)):
        params = repeats.RepeatParams(length=40, anchor=20, shard_bytes=500, bucket_bytes=3000, merged_texts=most, part_bytes=part)
        got = repeats.remove_repeats(docs, params).collect()
        assert Counter((r.doc_id, (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans)) for r in got) == wanted
    assert repeats.remove_repeats(stored(docs.limit(0), "t")).count() == 0


def test_rows_without_a_place_are_refused(spark):
    dealt = spark.createDataFrame([(1, "a b c", "s")] * 3, "doc_id long, text string, source string").repartition(3, "text")
    for operator in (simhash.drop_near_copies, repeats.remove_repeats, stages.mixed):
        with pytest.raises(ValueError, match="store the table"):
            operator(dealt)
    assert stages.mixed(stored(dealt, "dealt")).count() >= 0


def test_tilts_that_do_not_settle_are_an_error(spark):
    rows = spark.createDataFrame([(i, "w " * (i % 50 + 1), "ab"[i % 2]) for i in range(200)], "doc_id long, text string, source string")
    with pytest.raises(RuntimeError, match="settle"):
        mixing.mix_sources(rows, mixing.MixParams(max_steps=1)).collect()


def test_very_long_texts_of_fingerprints_and_mixes(spark):
    long = "word " * 200_000
    docs = spark.createDataFrame([(1, long, "a"), (2, long + "x", "a"), (3, "short text", "b")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in simhash.simhash_groups(docs).collect()}
    assert got[1].component_id == got[2].component_id == 1 and got[1].fingerprint == f"{plain_fingerprint(long):016x}"
    assert {r.doc_id: r.size for r in mixing.mix_sources(docs).collect()} == {1: 200_000, 2: 200_001, 3: 2}
