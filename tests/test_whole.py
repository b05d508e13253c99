"""Page context from whole texts, and from every page."""

from pyspark.sql import functions as F

from leafmill.operators import assembly as Y
from leafmill.operators import pages as P
from leafmill.plans import whole_queries as W

LONG = {(d, p): f"document {d} page {p} " + "word " * 600 + f"end {d}.{p}" for d in range(2) for p in range(1, 6)}


def test_context_holds_whole_pages(spark):
    pages = spark.createDataFrame([(d, p, t) for (d, p), t in LONG.items()], "doc long, page int, text string")
    asked = [(0, 1, 1), (0, 2, 3), (0, 3, 3), (1, 4, 5), (1, 5, 2), (1, 5, 4)]
    got = {r.table_id: r for r in P.window_context(spark.createDataFrame(asked, "doc long, table_id long, page int"), pages).collect()}
    for doc, table in {a[:2] for a in asked}:
        at = sorted({q for d, t, p in asked if (d, t) == (doc, table) for q in (p - 1, p, p + 1) if (doc, q) in LONG})
        texts = [LONG[doc, q] for q in at]
        assert (got[table].pages, got[table].chars, got[table].context) == (len(at), sum(map(len, texts)), " / ".join(texts))
    t = spark.createDataFrame([(0, 1, 2, ["a"], [["b"]])], "doc long, table_id long, page int, headers array<string>, rows array<array<string>>")
    ocr = t.select("doc", "page", F.lit(1).alias("ord"), "headers", "rows").where("false")
    assert Y.evidence(t, ocr, pages).first().evidence == "a\nb\n" + LONG[0, 2]
    r = spark.createDataFrame([(1, 7, ["f"], [2, 3])], "doc long, table_id long, fragment_ids array<string>, pages array<int>")
    f = spark.createDataFrame([(1, "f", "Table 1")], "doc long, frag string, caption string")
    assert Y.review_context(r, f, pages).first().page_text == LONG[1, 2] + "\n" + LONG[1, 3]


def test_every_page_takes_part(spark, tmp_path):
    """Sixty documents of twenty pages: tables meet all of them, not only the first fifty."""
    spark.range(1200).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source")).write.parquet(f"{tmp_path}/documents.parquet")
    o = spark.range(1, 2401).select(F.col("id").alias("o_orderkey"), (F.col("id") % 70).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority"))
    o.write.parquet(f"{tmp_path}/orders.parquet")
    at = W._spread(spark, str(tmp_path), W.v_fragment(spark, str(tmp_path)), "frag").select("doc", "page").distinct()
    assert at.count() == 1200 and W.v_page(spark, str(tmp_path)).join(at, ["doc", "page"]).count() == 1200
    for q in (W.page_window_context, W.review_context, W.born_digital):
        rows = q(spark, str(tmp_path)).collect()
        assert len(rows) == 2400 and {r.doc for r in rows} == set(range(60))
