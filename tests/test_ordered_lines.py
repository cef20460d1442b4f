"""The data source of ordered lines against plain reading."""

from __future__ import annotations

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from folioscope.sources.ordered_lines import PLACE_BITS, OrderedLinesReader
from folioscope.sources.papers import load_ordered_papers, numbered


def lines_of(path, split_bytes):
    reader = OrderedLinesReader(str(path), split_bytes)
    found = [row for split in reader.partitions() for batch in reader.read(split) for row in batch.to_pylist()]
    return [(r["seq"] >> PLACE_BITS, r["seq"] & ((1 << PLACE_BITS) - 1), r["value"]) for r in found]


def plain(data):
    out, place = [], 0
    for line in data.split(b"\n"):
        out.append((place, line.removesuffix(b"\r").decode()))
        place += len(line) + 1
    return out[:-1] if data.endswith(b"\n") or not data else out


@pytest.mark.parametrize("split_bytes", [1, 2, 3, 7, 50, 1 << 20])
def test_splits_of_any_size_give_all_lines_once(tmp_path, split_bytes):
    rng = random.Random(6)
    wanted = []
    for number, name in enumerate(["a", "b", "c", "d"]):
        parts = [rng.choice([b"", b"x", "é€😀".encode(), b"word " * rng.randint(0, 9), b"y\r"]) for _ in range(rng.randint(0, 30))]
        data = b"\n".join(parts) + rng.choice([b"", b"\n", b"\n\n"])
        (tmp_path / f"{name}.jsonl").write_bytes(data)
        wanted += [(number, place, line) for place, line in plain(data)]
    (tmp_path / "_SUCCESS").write_bytes(b"hidden\n")
    assert lines_of(tmp_path, split_bytes) == wanted


def test_compressed_files_and_marks(tmp_path):
    text = "\n".join(f"line {i}" for i in range(50_000)).encode()
    (tmp_path / "a.gz").write_bytes(gzip.compress(text[:100_000]) + gzip.compress(text[100_000:]))
    (tmp_path / "b.txt").write_bytes(b"\xef\xbb\xbfmarked\n")
    found = lines_of(tmp_path, 100)
    assert found == [*((0, p, line) for p, line in plain(text)), (1, 0, "marked")]


def test_missing_empty_and_broken_corpora(spark, tmp_path):
    with pytest.raises(Exception, match="download the metadata"):
        load_ordered_papers(spark, str(tmp_path / "none")).collect()
    (tmp_path / "empty").mkdir()
    assert load_ordered_papers(spark, str(tmp_path / "empty")).count() == 0
    good = {"id": "1", "title": "t", "abstract": "a", "categories": None}
    for bad in ("{", "", json.dumps({"id": "1", "title": "t"})):
        (tmp_path / "bad.jsonl").write_text(json.dumps(good) + "\n" + bad + "\n" + json.dumps(good))
        with pytest.raises(Exception):
            load_ordered_papers(spark, str(tmp_path / "bad.jsonl")).collect()
    (tmp_path / "latin.jsonl").write_bytes(b'{"id": "\xe9"}\n')
    with pytest.raises(Exception, match="utf-8"):
        load_ordered_papers(spark, str(tmp_path / "latin.jsonl")).collect()


def test_papers_keep_their_order(spark, tmp_path):
    records, n = [], 0
    for name, count in (("b", 300), ("a", 2), ("c", 40)):
        own = [{"id": str(n + i), "title": f" t{i}\n", "abstract": "é" * (i % 7), **({"categories": None} if i % 2 else {})} for i in range(count)]
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in own))
        n += count
        records.append((name, own))
    wanted = [r for _, own in sorted(records, key=lambda r: r[0]) for r in own]
    papers = load_ordered_papers(spark, str(tmp_path), split_bytes=500)
    got = sorted(numbered(papers, "seq").collect(), key=lambda r: r.place)
    assert [r.place for r in got] == list(range(n))
    assert [(r.id, r.title, r.categories, r.authors) for r in got] == [(r["id"], r["title"].strip(), None if "categories" in r else "", "") for r in wanted]


def test_numbers_follow_the_order(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("key"))
    got = numbered(rows, "key").orderBy("place").collect()
    assert [r.place for r in got] == list(range(5000)) and [r.key for r in got] == sorted(r.key for r in got)
    assert numbered(rows.limit(0), "key").count() == 0
