"""Subcommands on small tables in files."""

import json

from leafmill.__main__ import listing, main


def test_export_and_facts(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    html = "<table><tr><th>Sample</th><th>Mass (kg)</th></tr><tr><td>P1</td><td>1.5</td></tr></table>"
    tree = {"children": [{"id": "/page/0/Table/1", "block_type": "Table", "bbox": [0, 1, 9, 9], "html": html}]}
    spark.createDataFrame([("d", json.dumps(tree))], "doc string, payload string").write.parquet(at("layout"))
    spark.createDataFrame([("d", 1, "text")], "doc string, page int, text string").write.parquet(at("pages"))
    spark.createDataFrame([], "doc string, page int, ord int, headers array<string>, rows array<array<string>>").write.parquet(at("ocr"))
    assert main(["export-structured-data", "--layout", at("layout"), "--pages", at("pages"), "--ocr", at("ocr"), "--out", at("out")]) == 0
    assert [r.rows for r in spark.read.parquet(at("out/tables")).collect()] == [[["P1", "1.5"]]]
    spark.read.parquet(at("out/tables")).withColumnRenamed("doc", "doc_id").write.parquet(at("grids"))
    assert main(["export-facts", "--tables", at("grids"), "--out", at("facts")]) == 0
    assert [(r.material_name_raw, r.value_numeric) for r in spark.read.parquet(at("facts")).collect()] == [("P1", 1.5)]


def test_eval(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    schema = "doc string, page int, table_id string, headers array<string>, rows array<array<string>>"
    spark.createDataFrame([("d", 1, "a", ["H"], [["1"]]), ("d", 2, "b", ["H"], [["2"]])], schema).write.parquet(at("gold"))
    spark.createDataFrame([("d", 1, "a", ["H"], [["1"]])], schema).write.parquet(at("pred"))
    (tmp_path / "base.json").write_text('{"precision": 1.0, "recall": 1.0}')
    run = ["eval-table-pipeline", "--gold", at("gold"), "--pred", at("pred"), "--out", at("out"), "--baseline", at("base.json")]
    assert main(run) == 0 and main([*run, "--strict-regression"]) == 1
    assert spark.read.json(at("out/metrics")).first().recall == 0.5


def test_audit(spark, tmp_path):
    root = tmp_path / "data"
    for p in ("corpora/good/source_pdfs/a.pdf", "corpora/Bad Name/source_pdfs/b.pdf", "stray.txt"):
        (root / p).parent.mkdir(parents=True, exist_ok=True)
        (root / p).write_text("x")
    assert {r.path for r in listing(spark, str(root)).where("is_dir").collect()} == {"corpora", "corpora/good", "corpora/Bad Name", "corpora/good/source_pdfs", "corpora/Bad Name/source_pdfs"}
    run = ["data-audit", "--root", str(root), "--out", str(tmp_path / "out")]
    assert main(run) == 0 and main([*run, "--strict"]) == 1
    assert {r.code for r in spark.read.json(str(tmp_path / "out/issues")).where("severity = 'error'").collect()} == {"invalid_slug", "unexpected_top_level_file"}
