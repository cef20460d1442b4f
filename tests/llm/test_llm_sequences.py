"""Merge lists, periodic runs and prefix tries against libraries and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioscope.llm import bpe, prefix_trie, queries, radix, runs

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def coder():
    return bpe.coder(WORD_BPE)


# merge lists


def ids_of(coder, text, size=bpe.PIECE):
    return [i for part in coder.encode(text, size) for i in part]


def test_every_character_as_the_library(coder, library):
    texts = [f"a{chr(c)}b" for c in range(0, 0x110000, 5) if not 0xD800 <= c < 0xE000]
    for text, wanted in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids_of(coder, text) == wanted.ids, ascii(text)


def test_pieces_of_any_size_give_the_same_ids(coder, library):
    rng = random.Random(3)
    parts = ["a", "e", "th", "ing", "'", "'s", "'re", "S", "é", "é", "́", "Σ", "İ", " ", "\n", "1", "!", "<", "<|endoftext|>", "<|end", "|>",
             "ß", "中", "한", "한", "s", "t", " ", "\x1c", "\x85", "ﬁ", "K", "\U0001f600"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        wanted = library.encode(text, add_special_tokens=False).ids
        for size in (1, 2, 3, 7, 100):
            assert ids_of(coder, text, size) == wanted, (text, size)
        decoder = bpe.Decoder(coder)
        got = "".join(decoder.feed([i]) for i in wanted) + decoder.end()
        assert got == library.decode(wanted, skip_special_tokens=False)


def test_long_words_need_a_fixed_window(coder, library):
    rng = random.Random(4)
    tokens = [t for t in coder.ids if t.isascii() and t.isalpha() and t == t.lower()]
    for _ in range(60):
        word = "".join(rng.choice(tokens) for _ in range(rng.randint(1, 300)))
        machine, got = bpe.Transducer(coder, block=rng.choice([20, 100, 512])), []
        for byte in word.encode():
            got += machine.feed(bytes([byte]))
            assert len(machine.window) <= coder.merges.lookahead + 2 * machine.block + max(coder.sizes.values())
        assert got + [*machine.end()] == library.encode(word, add_special_tokens=False).ids


def test_lookahead_bounds_what_later_text_changes(coder):
    rng = random.Random(5)
    tokens = [t for t in coder.ids if t.isascii() and t.isalpha() and t == t.lower()]
    for _ in range(1500):
        symbols = [coder.inner[b] for b in "".join(rng.choice(tokens) for _ in range(rng.randint(1, 40))).encode()]
        cut = rng.randint(1, len(symbols))

        def starts(part):
            out, at = set(), 0
            for token in coder.merges.merge(part[:]):
                out.add(at)
                at += coder.sizes[token]
            return out

        differ = {p for p in starts(symbols) ^ starts(symbols[:cut]) if p < cut}
        assert all(cut - p <= coder.merges.lookahead for p in differ)


def test_chain_of_rules_reaches_its_lookahead():
    merges = bpe.MergeList([("c", "d"), ("b", "c"), ("a", "b")], {s: i for i, s in enumerate(["a", "b", "c", "d", "cd", "bc", "ab"])})
    assert merges.lookahead == 3
    ids = {s: i for i, s in enumerate(["a", "b", "c", "d", "cd", "bc", "ab"])}
    assert merges.merge([ids[c] for c in "abc"]) == [ids["a"], ids["bc"]]
    assert merges.merge([ids[c] for c in "abcd"]) == [ids["ab"], ids["cd"]]
    with pytest.raises(ValueError):
        bpe.MergeList([("ab", "c"), ("a", "b")], {s: i for i, s in enumerate(["a", "b", "c", "ab", "abc"])})
    with pytest.raises(ValueError):
        bpe.MergeList([("a", "b"), ("ab", "c"), ("b", "c"), ("a", "bc")], {s: i for i, s in enumerate(["a", "b", "c", "ab", "abc", "bc"])})


def test_broken_bytes_decode_like_the_library(coder):
    bytelevel = bpe.coder(WORD_BPE)
    kept, bytelevel.decoder = bytelevel.decoder, {"type": "ByteLevel"}
    try:
        decoder = bpe.Decoder(bytelevel)
        ids = [bytelevel.inner[b] for b in "é😀".encode()]
        assert [decoder.feed([i]) for i in ids] == ["", "é", "", "", "", "😀"] and decoder.end() == ""
        assert decoder.feed(ids[:1]) + decoder.end() == "�"
    finally:
        bytelevel.decoder = kept


def test_bpe_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op11_bpe(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode(doc["text"] or "", add_special_tokens=False).ids
        row = got[doc["doc_id"]]
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert row["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_bpe_edges(spark, library):
    long = "Wort" * 60_000
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b", "x"), (3, "a b", "x"), (3, "a b", "x"), (4, long, "x"), (5, " \n\t", "x")]
    got = bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string, ids string"), WORD_BPE).collect()
    assert sorted(len(r["ids"]) for r in got)[:6] == [0, 0, 0, 2, 2, 2]
    assert max((r["ids"] for r in got), key=len) == library.encode(long, add_special_tokens=False).ids
    assert [r["decoded"] for r in got if r["doc_id"] is None] == ["a</w> b</w>"]
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), WORD_BPE).count() == 0


# periodic runs


def plain_runs(words, shortest=6, exponent=4):
    out = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(shortest, exponent * q):
                if not any(all(words[start + k] == words[start + k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(2500):
        n, kinds = rng.randint(0, 60), rng.randint(1, 4)
        words = [rng.choice("abcd"[:kinds]) for _ in range(n)]
        if n and rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randint(1, 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        for params in (runs.RunParams(), runs.RunParams(6, 2), runs.RunParams(2, 2), runs.RunParams(3, 3)):
            assert runs.find_runs(words, params) == plain_runs(words, params.shortest, params.exponent), (words, params)


def test_runs_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r.asDict() for r in queries.op12_periodic_runs(spark, SMALL).collect()}
    assert len(got) == len(docs)
    looped = 0
    for doc in docs:
        words = runs.WORDS.findall(doc["text"] or "")
        n, h = len(words), zlib.crc32(str(doc["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            looped += 1
        found = plain_runs(words) if n < 3000 else runs.find_runs(words)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        dropped = {i for s, length, q in found for i in range(s + q, s + length)}
        assert got[doc["doc_id"]] == {
            "doc_id": doc["doc_id"], "n_runs": len(found), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": best[0] if best[0] is None else 1000 * best[1] // best[2],
            "runs_sha256": sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            "collapsed_sha256": sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
        }
    assert looped > 5


def test_runs_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a " * 9, "x"), (3, "a " * 9, "x"), (3, "a " * 9, "x"), (4, "x y z " * 60_000, "x"), (5, "\x0b\n", "x"), (6, "é é " * 6, "x")]
    got = runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs string")).collect()
    by_key = defaultdict(list)
    for r in got:
        by_key[r["doc_id"]].append(r)
    assert len(got) == 8 and [len(r["runs"]) for r in by_key[3]] == [1, 1] and by_key[None][0]["collapsed"] == "a"
    assert tuple(by_key[4][0]["best"]) == (0, 180_000, 3) and by_key[4][0]["collapsed"] == "x y z"
    assert by_key[1][0]["best"] is None and by_key[2][0]["collapsed"] == by_key[5][0]["collapsed"] == "" and by_key[6][0]["n_words"] == 6
    assert runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert runs.strongest([(5, 8, 2), (1, 4, 1), (1, 8, 2)]) == (1, 4, 1)


# prefix tries


def plain_trie(sequences):
    """All nodes of {conv: tuple of (role, text)} as in the query's contract."""
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[c] for c in children[node])
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
         sha(",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(node))))
        for node, m in members.items()
    )


def rows_of(df):
    return sorted(
        tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in df.collect()
    )


def made_up(rng, convs, longest, kinds):
    out = {}
    for conv in rng.sample(range(10 * convs), convs):
        old = rng.choice(list(out.values())) if out and rng.random() < 0.6 else ()
        keep = old[: rng.randint(0, len(old))] if rng.random() < 0.7 else old
        out[conv] = keep + tuple((rng.choice(["user", "tool"]), "é" * rng.randint(0, kinds)) for _ in range(rng.randint(0, longest)))
    return out


@pytest.mark.parametrize("params", [
    prefix_trie.TrieParams(task_turns=40, piece=2), prefix_trie.TrieParams(segment=3, task_turns=90, piece=3)
])
def test_trie_equals_brute_force(spark, params):
    rng = random.Random(params.segment)
    sequences = made_up(rng, 70, 5, 3)
    sequences[5001] = sequences[5003] = sequences[5002] = (("user", "x"),) * 8
    sequences[5000] = (("user", "x"),) * 11
    rows = [(c, t, role, text) for c, turns in sequences.items() for t, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    placed = prefix_trie.placed_turns(given, params)
    convs = spark.createDataFrame([(c,) for c in sequences], "conv_id long")
    got = prefix_trie.prefix_trie(placed.unionByName(prefix_trie.present(convs)), params)
    assert rows_of(got) == plain_trie(sequences)


def test_trie_query_equals_brute_force(spark):
    given = defaultdict(list)
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        given[r["conv_id"]].append((r["turn"], (r["role"] or "", r["text"] or "")))
    turns = {c: tuple(t for _, t in sorted(rows, key=lambda r: r[0])) for c, rows in given.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = turns.get(c - c % 100, ())[:h] + own[h:]
    assert rows_of(queries.op13_prefix_trie(spark, SMALL)) == plain_trie(rebuilt)


def test_branches_of_short_and_absent_bases(spark):
    rows = [(100, 0, "u", "a"), (100, None, "u", "n"), *[(c, t, None if t == 1 else "v", None if t == 2 else f"{t}") for c in range(101, 160) for t in range(c % 7 + 1)],
            *[(c, t, "w", "z") for c in range(301, 320) for t in range(3)], (None, 1, "u", "lost")]
    placed = prefix_trie.placed_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    turns = defaultdict(list)
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], -1 if r[1] is None else r[1])):
        turns[c].append((role or "", text or ""))
    rebuilt = {c: tuple(turns.get(c - c % 100, [])[: zlib.crc32(str(c).encode()) % 6] + own[zlib.crc32(str(c).encode()) % 6 :]) for c, own in list(turns.items())}
    assert any(not t for t in rebuilt.values())
    assert rows_of(prefix_trie.prefix_trie(queries.branched(placed))) == plain_trie(rebuilt)


def test_trie_edges(spark):
    schema = "conv_id long, turn long, role string, text string, id string, place long"
    assert prefix_trie.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, 0, "u", "a", "x", 9), (1, 0, "u", "a", "x", 9), (2, None, None, None, "x", 9), (None, 0, "u", "a", "x", 9), (3, 0, "u", "ü" * 100_000, "x", 9)]
    got = rows_of(prefix_trie.conversation_trie(spark.createDataFrame(rows, schema)))
    assert got == plain_trie({1: (("u", "a"),) * 2, 2: (("", ""),), 3: (("u", "ü" * 100_000),)})


def test_radix_nodes_grow_and_split():
    rng = random.Random(2)
    for keys in ([bytes([b]) for b in range(256)], [bytes(rng.randrange(3) for _ in range(rng.randint(0, 12))) for _ in range(400)], [b"ab" * 9, b"ab" * 4, b"abaa", b""]):
        root, wanted = radix.Node(b""), {}
        for key in keys:
            wanted[key] = len(wanted)
            radix.insert(root, key, wanted[key])
        found, stack = {}, [(root, root.path)]
        while stack:
            node, key = stack.pop()
            if node.value is not None:
                found[key] = node.value
            stack += [(kid, key + bytes([b]) + kid.path) for b, kid in node.layout.items()]
            assert all(node.layout.get(b) is kid for b, kid in node.layout.items())
        assert found == wanted
