"""The registered corpus queries on the smallest tables, and the pipeline stage by stage."""

import pytest
from conftest import DATA, same_rows
from pyspark.sql import functions as F

from leafmill.llm import queries

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs_over_all(spark, name):
    rows = queries.QUERIES[name](spark, DATA).count()
    table = {"op5": "embeddings", "op7": "pages", "op10": "embeddings"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{DATA}/{table}.parquet").count()
    assert rows == n or name.split("_")[0] in ("op1", "op5", "op6") and rows > 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, duck, name):
    assert same_rows(duck, queries.QUERIES[name](spark, DATA), queries.SQL[name])[0] == 0


def test_native_mixing(spark):
    plan = queries.QUERIES["op1_mixing"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    seen = {}
    for i, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{i}")
        docs = seen[name] = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == columns
    ids = lambda name: {r.doc_id for r in seen[name].select("doc_id").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    gone = set(before) - ids("toxicity")
    assert gone and sum(labels.get(i) == 0 for i in gone) <= 2
    assert ids("near_dedup") <= ids("toxicity") and ids("pii") == ids("near_dedup") == ids("mixing") == ids("packing")
    changed = [r for r in seen["pii"].collect() if r.text != before[r.doc_id]]
    assert changed and all(r.n_chars == len(r.text) for r in changed)
    assert seen["mixing"].count() >= seen["pii"].count()
    assert seen["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


ODD = "doc_id long, text string, lang string, source string, n_chars int, _lm_found int, _lm_h string, _lm_score double, count int, `a.b` int"


def odd_docs(spark):
    long = " ".join(f"w{i % 877} y{i % 13}" for i in range(90_000))
    texts = ["clean words of a first document here", None, "", long, long + " end", "call 743-555-3824 or write to me", "call 743-555-3824 or write to me", " \n", "one", "two words", "another text that stands alone in here"]
    rows = [(i, t, "en", None if i % 4 == 0 else f"s{i % 2}", None, 7, "h", 0.9, 3, i) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], rows[3], (None, *rows[0][1:]), (None, "another text without an id", None, None, None, 7, "h", 0.9, 3, 99), (None, "another text without an id", None, None, None, 7, "h", 0.9, 3, 99)]
    rows += [(10, "an id with an unlike text that comes again", "en", "s0", 42, 7, "h", 0.9, 3, 100)]
    return spark.createDataFrame(rows, ODD).repartition(3), rows


@pytest.mark.parametrize("at", range(5))
def test_stages_on_odd_rows(spark, tmp_path, at):
    docs, rows = odd_docs(spark)
    name, stage = pipeline.STAGES[at]
    labels = spark.createDataFrame([(i, int(i in (9, 22, 23, 24)), 0, "x") for i in range(30)] + [(None, 1, 0, "x"), (3, None, 1, "x")], "doc_id long, toxic int, quality int, text string")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = stage(spark, docs, str(tmp_path))
    nothing = stage(spark, docs.limit(0), str(tmp_path))
    if name != "packing":
        assert got.columns == docs.columns == nothing.columns
        assert {r["a.b"] for r in got.collect()} <= {r[9] for r in rows} and {(r._lm_found, r._lm_h, r._lm_score, r["count"]) for r in got.collect()} == {(7, "h", 0.9, 3)}
    assert nothing.count() == 0
    key = lambda r: (str(r[0]), str(r[1]))
    have, all_ = sorted(map(key, got.select(docs.columns[:2]).collect())) if name != "packing" else None, sorted(map(key, rows))
    if name == "toxicity":
        assert set(have) <= set(all_) and all(have.count(k) == all_.count(k) for k in have)
    elif name == "near_dedup":
        ids = sorted(str(k[0]) for k in have)
        # 4 is near 3, 6 equals 5, ids once each, null ids all
        assert ids == sorted(["0", "1", "2", "3", "5", "7", "8", "9", "10", "None", "None", "None"])
        again = sorted(map(key, stage(spark, docs.repartition(7), str(tmp_path)).select(docs.columns[:2]).collect()))
        assert again == have
    elif name == "pii":
        out = {(str(r.doc_id), r["a.b"]): r for r in got.collect()}
        assert got.count() == len(rows) and out["1", 1].text is None and out["2", 2].text == "" and out["3", 3].text == rows[3][1]
        assert out["5", 5].text == out["6", 6].text != rows[5][1] and out["5", 5].n_chars == len(out["5", 5].text) and out["0", 0].n_chars is None
    elif name == "mixing":
        assert set(have) == set(all_) and all(have.count(k) >= all_.count(k) for k in set(all_))
    else:
        n = {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
        assert set(n) == {r[0] for r in rows} and n[1] == n[2] == 1 and n[3] > 100_000
        assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_run(spark):
    assert pipeline.run(spark, DATA).count() > 0
