from __future__ import annotations

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from folioscope.schemas import SEQUENCED_PAPER
from folioscope.sources import tables
from folioscope.sources.papers import head, load_papers


def write_lines(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def line(**fields):
    return json.dumps({"id": "0704.0010", "title": "T", "abstract": "A", **fields})


def test_load_papers(spark, tmp_path):
    path = write_lines(
        tmp_path / "a.json",
        [
            line(title=" \tA\n  title ", abstract="\n  text $x$\nmore ", categories="hep-ph hep-ex", authors="A. B.", extra=1),
            line(id="2", categories=None),
            line(id="3", title="Ünïcode"),
        ],
    )
    rows = load_papers(spark, path).orderBy("seq").collect()
    assert [r.id for r in rows] == ["0704.0010", "2", "3"]
    assert rows[0].title == "A   title" and rows[0].abstract == "text $x$ more"
    assert rows[0].categories == "hep-ph hep-ex" and rows[0].authors == "A. B."
    assert rows[1].categories is None and rows[1].authors == ""
    assert rows[2].categories == "" and rows[2].title == "Ünïcode"


@pytest.mark.parametrize("bad", ["{broken", "", '{"id": "1", "title": "no abstract"}', '{"title": "t", "abstract": "a"}', "{'id': '1'}"])
def test_bad_lines_fail_the_load(spark, tmp_path, bad):
    path = write_lines(tmp_path / "a.json", [line(), bad, line(id="9")])
    with pytest.raises(Exception):
        load_papers(spark, path).collect()


def test_missing_file_has_a_hint(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="snapshot"):
        load_papers(spark, str(tmp_path / "none.json"))


def test_head(spark, tmp_path):
    path = write_lines(tmp_path / "a.json", [line(id=str(i)) for i in range(20)])
    papers = load_papers(spark, path)
    assert [r.id for r in head(papers, 3).collect()] == ["0", "1", "2"]
    scattered = papers.withColumn("seq", F.col("seq") * 300_000_000_000_000_003 - 7).repartition(4)
    for n in (1, 3, 19, 20, 50):
        assert [r.id for r in head(scattered, n, gathered_rows=0).collect()] == [str(i) for i in range(min(n, 20))]
    assert head(papers.limit(0), 5, gathered_rows=0).count() == 0
    assert head(papers, None).count() == 20 and head(papers, 0).count() == 20


def test_csv_keeps_zeros_quotes_newlines_blanks_and_nulls(spark, tmp_path):
    rows = [("0704.0100", 'say "hi", ok', "two\nlines\\", "", None, 1), ("007", " pad ", "", "a b", "x", 2)]
    df = spark.createDataFrame(rows, SEQUENCED_PAPER)
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), SEQUENCED_PAPER)
    assert [tuple(r) for r in back.orderBy("seq").collect()] == rows


def test_materialize_builds_once(spark, tmp_path):
    path = str(tmp_path / "stage")
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    assert tables.read_or_none(spark, path) is None
    assert tables.materialize(spark, path, build).count() == 3
    assert tables.materialize(spark, path, build).count() == 3
    assert len(built) == 1 and tables.read_or_none(spark, path).count() == 3


def test_keywords_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, ["a", "b"]), (11, ["c"])], "cluster_id int, keywords array<string>")
    tables.write_keywords_json(df, str(tmp_path / "k"))
    assert sorted(map(tuple, tables.read_keywords_json(spark, str(tmp_path / "k")).collect())) == [(0, ["a", "b"]), (11, ["c"])]


def test_scratch_follows_the_cluster_setting(spark):
    assert tables.scratch_root(spark) == tables.scratch_root(spark)
    settings = {"spark.checkpoint.dir": "hdfs://shared/ckpt/"}
    context = SimpleNamespace(applicationId="app-1", getConf=lambda: settings)
    assert tables.scratch_root(SimpleNamespace(sparkContext=context)) == "hdfs://shared/ckpt/folioscope/app-1"


def test_point_lookup_is_pushed_into_the_scan(spark, tmp_path):
    from folioscope.operators.lookup import paper_by_id

    df = spark.createDataFrame([("1", "t", "a", "c", "u", 1)], SEQUENCED_PAPER)
    tables.write_parquet(df, str(tmp_path / "p"))
    plan = paper_by_id(spark.read.parquet(str(tmp_path / "p")), "1")._jdf.queryExecution().toString()
    assert "EqualTo(id,1)" in plan
    assert "seq" not in plan.split("ReadSchema")[-1]


def test_append_metrics(spark, tmp_path):
    for k in (5, 10):
        tables.append_metrics(spark.range(1).select(F.lit(k).alias("k")), str(tmp_path / "m"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "m")).collect()) == [5, 10]
