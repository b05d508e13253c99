"""Context of tables from whole page texts, tables spread over every page of every document, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assembly as Y
from ..operators import pages as P
from .page_queries import HEUR
from .views import PAGES_OF_A_DOC, V_FRAGMENT, V_GRID, V_PAGE, v_fragment, v_grid, v_page


def _spread(spark, sf, tables, key):
    """tables on the documents and pages of v_page in turn: their number grows with the documents."""
    n = (v_page(spark, sf).agg(F.max("doc")).first()[0] or 0) + 1
    return tables.withColumn("doc", F.col(key) % n).withColumn("page", (F.expr(f"{key} div {n}") % PAGES_OF_A_DOC + 1).cast("int"))


def page_window_context(spark, sf):
    t = _spread(spark, sf, v_fragment(spark, sf), "frag").select("doc", F.col("frag").alias("table_id"), "page")
    return P.window_context(t, v_page(spark, sf)).select("doc", "table_id", "pages", "chars", F.md5("context").alias("context_md5"))


def review_context(spark, sf):
    f = _spread(spark, sf, v_fragment(spark, sf), "frag")
    t = f.select("doc", F.col("frag").alias("table_id"), F.array(F.col("frag").cast("string")).alias("fragment_ids"), F.array("page", F.col("page") + 1).alias("pages"))
    return Y.review_context(t, f, v_page(spark, sf)).select("doc", "table_id", "fragments", "captions", F.md5("page_text").alias("page_text_md5"))


def evidence_bundle(spark, sf):
    g = _spread(spark, sf, v_grid(spark, sf), "table_id").select("doc", "page", "table_id", "headers", "rows")
    ocr = v_page(spark, sf).select("doc", "page", F.lit(1).alias("ord"), F.array(F.lit("H")).alias("headers"), F.array(F.array("source")).alias("rows"))
    return Y.evidence(g, ocr, v_page(spark, sf)).select("doc", "table_id", F.md5("evidence").alias("evidence_md5"))


def born_digital(spark, sf):
    pages = v_page(spark, sf).withColumn("route", P.route(P.heuristics(F.col("text")))).select("doc", "page", "route")
    f = _spread(spark, sf, v_fragment(spark, sf), "frag").select("doc", F.col("frag").alias("table_id"), F.explode(F.array("page", F.col("page") + 1)).alias("page"))
    j = f.join(pages, ["doc", "page"], "left").groupBy("doc", "table_id").agg(F.bool_and(F.when(F.col("route").isNotNull(), F.col("route") == "anchored")).alias("b"))
    return j.select("doc", "table_id", F.coalesce("b", F.lit(False)).alias("born_digital"))


QUERIES = {f.__name__: f for f in (page_window_context, review_context, evidence_bundle, born_digital)}
N = "(SELECT coalesce(max(doc), 0) + 1 FROM v_page)"
SPREAD = f"{{0}} % {N} AS doc, ({{0}} // {N} % {PAGES_OF_A_DOC} + 1)::int AS page"
SQL = {
    "page_window_context": f"""WITH {V_PAGE}, {V_FRAGMENT}, t AS (SELECT {SPREAD.format('frag')}, frag AS table_id FROM v_fragment)
SELECT t.doc, table_id, count(*) AS pages, sum(length(text))::bigint AS chars, md5(string_agg(text, ' / ' ORDER BY p.page)) AS context_md5
FROM t JOIN v_page p ON p.doc = t.doc AND p.page BETWEEN t.page - 1 AND t.page + 1 GROUP BY t.doc, table_id""",
    "review_context": f"""WITH {V_PAGE}, {V_FRAGMENT}, f AS (SELECT {SPREAD.format('frag')}, frag, caption FROM v_fragment)
SELECT f.doc, frag AS table_id, 1::bigint AS fragments, any_value(caption) AS captions, md5(coalesce(string_agg(text, chr(10) ORDER BY v.page), '')) AS page_text_md5
FROM f LEFT JOIN v_page v ON v.doc = f.doc AND v.page IN (f.page, f.page + 1) GROUP BY f.doc, frag""",
    "evidence_bundle": f"""WITH {V_PAGE}, {V_GRID}, g AS (SELECT {SPREAD.format('table_id')}, table_id, array_to_string(headers, ' | ') || chr(10) || array_to_string(list_transform(rows, lambda r: array_to_string(r, ' | ')), chr(10)) AS own FROM v_grid)
SELECT g.doc, table_id, md5(concat_ws(chr(10), own, 'H' || chr(10) || source, text)) AS evidence_md5 FROM g LEFT JOIN v_page p ON p.doc = g.doc AND p.page = g.page""",
    "born_digital": f"""WITH {V_PAGE}, {HEUR}, {V_FRAGMENT}, t AS (SELECT {SPREAD.format('frag')}, frag AS table_id FROM v_fragment), f AS (SELECT doc, table_id, unnest([page, page + 1]) AS page FROM t)
SELECT f.doc, table_id, coalesce(bool_and(route = 'anchored'), false) AS born_digital FROM f LEFT JOIN s USING (doc, page) GROUP BY ALL""",
}
