"""Readers, writers and incremental runs on small folders."""

import json

import pytest
from pyspark.sql import functions as F

from leafmill.sinks import writers as W
from leafmill.sources import readers as S
from leafmill.streaming import landing as L


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1, "b": "x"}\n\n[1, 2]\n{"a": broken\n"s"\n{"a": "two", "b": "é"}\n{"a": 3}}\n')
    got = S.jsonl(spark, str(tmp_path / "a.jsonl"), "a int, b string").collect()
    assert sorted((r.a, r.b) for r in got if r.a) == [(1, "x")] and len(got) == 2
    (tmp_path / "o.json").write_text('{"k": [1, 2]}')
    (tmp_path / "bad.json").write_text("nope")
    assert S.json_object(spark, str(tmp_path / "o.json"), "k array<int>").first().k == [1, 2]
    assert S.json_object(spark, str(tmp_path / "bad.json"), "k array<int>").first().k is None


def test_csv_aliases(spark, tmp_path):
    (tmp_path / "b.csv").write_text("﻿DOI,Paper_Title,Authors,Year,journal\n10.1/x, A title ,\"Doe, J. et al.\",c2001,J\n", encoding="utf-8")
    r = S.bibliographic_csv(spark, str(tmp_path / "b.csv")).first()
    assert (r.doi_raw, r.title, r.author, r.year, r.container, r.url_raw) == ("10.1/x", "A title", "Doe, J.", "2001", "J", "")
    with pytest.raises(ValueError):
        S.resolve_columns(["a"], {"doi": "missing"})
    (tmp_path / "d.csv").write_text("doi\nhttps://doi.org/10.1000/A\n10.1000/a\n\n10.1000/b.\n")
    assert {tuple(r) for r in S.doi_csv(spark, str(tmp_path / "d.csv"), "doi").collect()} == {("10.1000/a", "https://doi.org/10.1000/A"), ("10.1000/b", "10.1000/b.")}


def test_folders(spark, tmp_path):
    d = tmp_path / "g" / "doc_1"
    (d / "pages").mkdir(parents=True)
    (d / "metadata").mkdir()
    (d / "pages" / "0002.md").write_text("two")
    (d / "pages" / "cover.md").write_text("no page")
    (d / "metadata" / "manifest.json").write_text("{}")
    assert [(r.doc, r.page, r.text) for r in S.page_markdown(spark, str(tmp_path)).collect()] == [("doc_1", 2, "two")]
    assert S.document_folders(spark, str(tmp_path)).count() == 1 and S.document_folders(spark, str(tmp_path), named=True).count() == 1


def test_ocr_tables(spark, tmp_path):
    (tmp_path / "table_1_page_3.md").write_text("<table><tr><th>A</th></tr><tr><td>1</td></tr></table>")
    (tmp_path / "table_2_page_3.md").write_text("| B |\n|---|\n| 2 |\n")
    (tmp_path / "table_3_page_4.md").write_text("<table><tr><th>C</th></tr><tr><th>3</th></tr></table>")
    got = {(r.page, r.ordinal): (r.headers, r.rows) for r in S.ocr_tables(spark, str(tmp_path)).collect()}
    assert got == {(3, 1): (["A"], [["1"]]), (3, 2): (["B"], [["2"]]), (4, 3): (["C"], [["3"]])}


def test_pdfs(spark, tmp_path):
    (tmp_path / "my grp").mkdir()
    (tmp_path / "my grp" / "a b.PDF").write_bytes(b"%PDF")
    (tmp_path / "x.txt").write_text("x")
    r = S.pdf_files(spark, str(tmp_path)).collect()
    assert len(r) == 1 and r[0].name == "a_b" and len(r[0].doc_id) == 12 and r[0].sha256.startswith(r[0].doc_id)


def test_tei(spark):
    xml = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>On x</title></titleStmt><publicationStmt><date when="1999-05"/></publicationStmt><sourceDesc><biblStruct><analytic><author><persName><forename>Ann</forename><surname>Bee</surname></persName></author></analytic></biblStruct></sourceDesc></fileDesc></teiHeader><text><body><div><head>Intro</head></div></body><figure coords="1,2,3,4,5;bad"><head>Table 1</head></figure></text></TEI>'
    r = S.tei(spark.createDataFrame([("d", xml)], "doc_id string, tei_xml string")).first()
    assert (r.title, r.authors, r.year, r.sections) == ("On x", ["Bee, Ann"], "1999", ["Intro"])
    assert [(f.label, [(c.page, c.x) for c in f.coords]) for f in r.figures] == [("Table 1", [(1, 2.0)])]


def test_cache_and_charts(spark):
    cache = spark.createDataFrame([("GET u", 200, "b", None, None)], S.BOUNDARY["http_cache"])
    got = {r.url: (r.status, r.from_cache) for r in S.cached_http(spark.createDataFrame([("get", "u"), ("GET", "v")], "method string, url string"), cache).collect()}
    assert got == {"u": (200, True), "v": (0, False)}
    k = [r.kind for r in S.chart_output(spark.createDataFrame([('{"a": 1}',), ("[1]",), ("text",), (None,)], "stdout string")).collect()]
    assert k == ["object", "raw", "raw_text", "raw_text"]


def test_boundary_round_trip(spark, tmp_path):
    for name, schema in S.BOUNDARY.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}")
        assert S.boundary(spark, str(tmp_path), name).count() == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("d", "t", ["A", "B"], [["1", "é"]])], "doc string, table_id string, headers array<string>, rows array<array<string>>")
    W.jsonl(df, f"{tmp_path}/j")
    line = "".join(p.read_text() for p in (tmp_path / "j").glob("part-*"))
    assert json.loads(line)["rows"] == [["1", "é"]] and line.isascii()
    W.table_cells(df, f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/c").count() == 4
    W.snapshot(df, f"{tmp_path}/s", "r1", "input")
    W.snapshot(df, f"{tmp_path}/s", "r1", "rectified")
    assert spark.read.parquet(f"{tmp_path}/s").count() == 2
    report = spark.createDataFrame([("10.1/a", "Success", "f1", 1), ("10.1/a", "Exists", "f2", 2), ("10.1/b", "Failed", "", 3)], "doi string, status string, file_path string, seq int")
    W.fetch_reports(report, f"{tmp_path}/f")
    assert spark.read.option("header", True).csv(f"{tmp_path}/f/index").first().file_path == "f2"
    assert spark.read.option("header", True).csv(f"{tmp_path}/f/failed").count() == 1
    W.resolved_csv(report, f"{tmp_path}/r")
    assert spark.read.option("header", True).csv(f"{tmp_path}/r").columns == list(W.RESOLVED)
    W.documents(spark.createDataFrame([("d", 1, "x")], "doc string, page int, text string"), f"{tmp_path}/p")
    W.text(spark.createDataFrame([("d", "x")], "doc string, t string"), "t", f"{tmp_path}/t", ["doc"])
    assert spark.read.text(f"{tmp_path}/t").count() == 1


def test_stream_is_idempotent(spark, tmp_path):
    schema = "doc_id string, sha256 string, text string"
    land, out, cp = (str(tmp_path / x) for x in ("land", "out", "cp"))

    def put(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(land)
        L.run_available(spark, land, out, cp, schema, L.page_routes).awaitTermination()
        return sorted((r.doc_id, r.sha256) for r in spark.read.parquet(out).collect())

    assert put(("a", "1", "x " * 300), ("a", "1", "x " * 300)) == [("a", "1")]
    assert put(("a", "1", "x"), ("a", "2", "y"), ("b", "1", "")) == [("a", "1"), ("a", "2"), ("b", "1")]


def test_event_windows(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.write.parquet(f"{tmp_path}/e")
    schema = ", ".join(f"{c} {t}" for c, t in e.dtypes)
    q = L.event_counts(spark, f"{tmp_path}/e", schema).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(n) from counts").first()[0] == e.count()
    want = {(r.w, r.event_type, r.n) for r in e.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("w"), "event_type").agg(F.count("*").alias("n")).collect()}
    assert {(r.w, r.event_type, r.n) for r in spark.sql("select window.start w, event_type, n from counts").collect()} == want
