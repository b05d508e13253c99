"""Queries over assembled records, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import assembly as Y
from ..operators import pages as P
from ..operators import tables as B
from .table_queries import NUM
from .views import V_FRAGMENT, V_GRID, V_PAGE, V_ROW, table, v_fragment, v_grid, v_page, v_row


def _fragments(spark, sf):
    """Fragments with a header row and two data rows each, the second repeated where the key is even."""
    f = v_fragment(spark, sf)
    row = F.array(F.col("frag").cast("string"), F.lit("v"))
    return B.chains(f).withColumn("header_rows", F.array("tokens")).withColumn("data_rows", F.array(row, F.when(F.col("frag") % 2 == 0, row).otherwise(F.array(F.lit("x"), F.lit("")))))


def canonical_tables(spark, sf):
    d = Y.canonical(_fragments(spark, sf))
    return d.select("doc", "table_id", "table_group_id", F.array_join("fragment_ids", ",").alias("fragment_ids"), F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages"), "caption", F.size("data_rows").alias("rows"), "merge_confidence")


def continued_tables(spark, sf):
    f = v_fragment(spark, sf).select("doc", F.col("frag").cast("string").alias("table_id"), "page", F.when(F.col("frag") % 2 == 0, F.col("caption")).otherwise("").alias("caption"), (F.col("frag") % 2 == 0).alias("empty_body"))
    pairs = B.continuation_pairs(f.select("doc", "table_id", F.col("page").alias("page_min"), F.col("page").alias("page_max"), "caption", "empty_body"))
    t = f.select("doc", "table_id", F.col("table_id").alias("table_group_id"), F.array("table_id").alias("fragment_ids"), F.array("page").alias("pages"), "caption", F.when(F.col("empty_body"), F.array(F.array(F.lit("Name\nUnit"), F.lit("Value")))).otherwise(F.array().cast("array<array<string>>")).alias("header_rows"), F.when(F.col("empty_body"), F.array().cast("array<array<string>>")).otherwise(F.array(F.array("table_id", F.lit("a"), F.lit("b")))).alias("data_rows"), F.lit(1.0).alias("merge_confidence"))
    d = Y.merge_continuations(t, pairs)
    return d.select("doc", "table_id", F.array_join("fragment_ids", ",").alias("fragment_ids"), B.rows_text(F.col("header_rows")).alias("headers"), B.rows_text(F.col("data_rows")).alias("rows"), "merge_confidence", "cross_page_merged")


def table_crops(spark, sf):
    f = v_fragment(spark, sf)
    t = f.select("doc", F.col("frag").alias("table_id"), "page", F.array(F.concat(F.lit("f"), F.col("frag").cast("string"))).alias("fragment_ids"), F.array(F.concat(F.lit("g"), F.col("frag").cast("string"))).alias("lineage"))
    files = f.where("frag % 3 = 0").select("doc", F.concat(F.lit("f"), F.col("frag").cast("string")).alias("name"), "page", F.concat(F.lit("a/"), F.col("frag").cast("string")).alias("path")).unionByName(f.where("frag % 2 = 0").select("doc", F.concat(F.lit("g"), F.col("frag").cast("string")).alias("name"), "page", F.concat(F.lit("b/"), F.col("frag").cast("string")).alias("path")))
    return Y.crops(t, files)


def group_table_ids(spark, sf):
    f = v_fragment(spark, sf).select("doc", F.col("frag").cast("string").alias("group"), "page")
    return Y.table_ids(f, f.where("page % 2 = 0").select("doc", "group", F.concat(F.lit("t"), "group").alias("table_id")))


def export_totals(spark, sf):
    p = v_page(spark, sf).select("doc", F.get(F.array(*map(F.lit, ("ok", "text_only", "structured_ok", "skipped", "structured_fallback"))), F.col("page") % 5).alias("status"))
    return Y.totals(p, v_fragment(spark, sf).select((F.col("doc") % 40).alias("doc")))


def abstracts(spark, sf):
    """Even documents get an abstract heading before their first page's text, odd ones another heading; pages are whole."""
    head = F.when(F.col("doc") % 2 == 0, "Title words here\n\n## Abstract\n\n").otherwise("# Heading\n")
    return Y.abstract(P.lines(v_page(spark, sf).where("page <= 5").withColumn("text", F.when(F.col("page") == 1, F.concat(head, "text")).otherwise(F.col("text")))))


def best_markdown_table(spark, sf):
    g = v_grid(spark, sf).select((F.col("table_id") % 41).alias("doc"), "page", F.col("table_id").alias("ord"), "headers", "rows")
    return Y.best_markdown_table(g)


def name_builders(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey") % 4
    author = F.when(k == 0, F.lit("Doe, Jane Q.")).when(k == 1, F.concat(F.lit("Ann "), F.regexp_replace("p_brand", "[^A-Za-z]", ""))).when(k == 2, F.lit("")).otherwise(F.lit("Plato"))
    return p.select("p_partkey", Y.folder_name(author, F.when(k == 3, "").otherwise("1999")).alias("folder"), Y.file_name(F.concat("p_name", F.lit(": a/b?.."))).alias("file"), P.is_person(author).alias("person"), Y.is_placeholder(F.when(k == 0, " <Topic> ").when(k == 1, "- _ -").otherwise(F.col("p_name"))).alias("placeholder"), Y.model_id(F.when(k == 0, " models/m1").when(k == 1, "short").otherwise(""), "base", {"short": "long"}).alias("model"))


def message_parts(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id") % 3
    labels = F.when(k == 0, F.array(F.lit("Cancel"), F.lit("Get PDF"))).when(k == 1, F.array(F.lit("Request (12 pts)"), F.lit("✅ yes"))).otherwise(F.array().cast("array<string>"))
    d = e.select("event_id", Y.message_parts(F.concat(F.lit("\n >> "), F.col("event_type"), F.lit("  done\nmore")), labels).alias("m"))
    return d.select("event_id", "m.*")


def discovery_normalize(spark, sf):
    d = v_page(spark, sf).where("page = 1")
    s = F.array(F.struct(F.lit("Intro").alias("title"), (F.col("doc") % 7 - 2).cast("int").alias("start_page"), F.lit(99).alias("end_page"), F.lit("...").alias("summary")), F.struct(F.lit("<section title>").alias("title"), F.lit(1).alias("start_page"), F.lit(1).alias("end_page"), F.lit("x").alias("summary")), F.struct(F.lit(" B ").alias("title"), F.lit(3).alias("start_page"), F.lit(None).cast("int").alias("end_page"), F.lit("s").alias("summary")))
    d = Y.discovery(d.select("doc", F.lit(4).alias("pages"), F.lit("string").alias("summary"), F.array(F.lit("a"), F.lit("<topic>"), F.lit(" ")).alias("topics"), s.alias("sections")))
    return d.select("doc", "summary", F.array_join("topics", "|").alias("topics"), F.posexplode("sections").alias("i", "s")).select("doc", "summary", "topics", "i", F.col("s.title").alias("title"), F.col("s.start_page").alias("start_page"), F.col("s.end_page").alias("end_page"), F.col("s.summary").alias("section_summary"))


def topic_backfill(spark, sf):
    d = v_page(spark, sf)
    found = F.when(F.col("page") % 3 == 0, F.array("source", "lang", F.lit("spark"))).otherwise(F.array(F.upper("lang")))
    return d.select("doc", "page", F.array_join(Y.derive_topics(found, F.array("lang", F.lit("plan")), F.array(F.lit("Plan"), F.lit("sum"), F.lit("end"))), "|").alias("topics"))


def prefilled_grid(spark, sf):
    g = v_grid(spark, sf)
    grid = Y.prefilled(F.array("headers"), F.col("rows"), F.lit(4), (F.col("table_id") % 6).cast("int"))
    return g.select("table_id", B.rows_text(grid).alias("grid"))


def grid_to_markdown(spark, sf):
    g = v_grid(spark, sf)
    return g.select("table_id", Y.grid_markdown(F.concat(F.array("headers"), "rows"), F.lit(2)).alias("markdown"))


def reconcile_payloads(spark, sf):
    g = v_grid(spark, sf)
    k = F.col("table_id") % 4
    answer = F.when(k == 0, F.to_json("rows")).when(k == 1, "nope").when(k == 2, F.to_json(F.slice("rows", 1, 0))).otherwise(F.to_json(F.transform("rows", lambda r: F.transform(r, lambda x, i: F.when(i == 0, "?").otherwise(x)))))
    d = Y.reconcile_payload(g.select("table_id", F.col("rows").alias("grid"), answer.alias("answer")))
    return d.select("table_id", F.split("reason", ":")[0].alias("reason"), F.size("grid").alias("rows"))


def rectified_payloads(spark, sf):
    g = v_grid(spark, sf)
    k = F.col("table_id") % 4
    full = F.to_json(F.struct(F.array("headers").alias("rectified_header_rows_full"), F.slice("rows", 1, 1).alias("rectified_rows"), F.lit(1.7).alias("rectifier_confidence")))
    raw = F.when(k == 0, F.concat(F.lit("```json\n"), full, F.lit("\n```"))).when(k == 1, '{"rectified_rows": [["a"]], "needs_review": true}').when(k == 2, "sorry").otherwise(full)
    d = Y.rectified_payload(g.select("table_id", F.array("headers").alias("header_rows"), F.col("rows").alias("data_rows"), raw.alias("raw")))
    return d.select("table_id", F.size("header_rows").alias("heads"), F.size("data_rows").alias("rows"), "confidence", "needs_review", "context_request", F.array_join("reasons", ",").alias("reasons"))


def prompt_payloads(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", Y.prompt_json(12, lang=F.col("lang"), source=F.concat(F.lit("from the source "), F.col("source"))).alias("prompt"))


def new_manifests(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id"), F.col("source").alias("path"), F.sha2("text", 256).alias("sha256"), F.lit(1).alias("page_count"))
    return Y.manifests(d, "m").select("doc_id", "source_path", "page_count", "model", F.size("pages").alias("pages"), F.col("table_pipeline.merge_scope").alias("scope"), F.col("table_quality.empty_cell_ratio_max").alias("limit"), F.col("table_qa.status").alias("status"))


def span_text(spark, sf):
    """Lines of documents as spans of a page's text blocks, put together again."""
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.lit(1).alias("page"), F.posexplode_outer(F.split("text", "\n")).alias("line", "text"))
    s = d.select("doc_id", "page", F.lit(0).alias("block"), "line", F.lit(0).alias("span"), F.lit(0).alias("type"), "text")
    return P.span_text(s.unionByName(s.withColumn("type", F.lit(1)))).select("doc_id", "page", F.md5("text").alias("text_md5"))


def page_signature(spark, sf):
    d = v_page(spark, sf)
    return d.select("doc", "page", T.stable_id(F.col("doc"), F.col("page"), F.col("source"), sep="|").alias("id"), T.clamp01(F.concat((F.col("page") / 4).cast("decimal(6,3)").cast("string"), F.when(F.col("page") == 3, "x").otherwise(""))).alias("clamped"))


QUERIES = {f.__name__: f for f in (canonical_tables, continued_tables, table_crops, group_table_ids, export_totals, abstracts, best_markdown_table, name_builders, message_parts, discovery_normalize, topic_backfill, prefilled_grid, grid_to_markdown, reconcile_payloads, rectified_payloads, prompt_payloads, new_manifests, span_text, page_signature)}

CHAIN = f"""{V_FRAGMENT}, a AS (SELECT *, {NUM} AS number FROM v_fragment),
b AS (SELECT *, CASE WHEN number = '' THEN 0 WHEN page - lag(page) OVER w BETWEEN 0 AND 1 AND (contains(caption, 'continued') OR contains(lag(caption) OVER w, 'continued') OR len(list_intersect(list_distinct(tokens), list_distinct(lag(tokens) OVER w))) / len(list_distinct(list_concat(tokens, lag(tokens) OVER w))) >= 0.75) THEN 0 ELSE 1 END AS br FROM a WINDOW w AS (PARTITION BY doc, number ORDER BY page, frag)),
c AS (SELECT *, sum(br) OVER (PARTITION BY doc, number ORDER BY page, frag)::int AS chain FROM b),
k AS (SELECT *, CASE WHEN number = '' THEN 'fragment:' || frag ELSE 'number:' || number || ':' || chain END AS g FROM c)"""
JOINED = "array_to_string(list_transform({}, lambda r: array_to_string(r, '|')), chr(10))"
SQL = {
    "canonical_tables": f"""WITH {CHAIN}, t AS (SELECT doc, g AS table_group_id, string_agg(frag::varchar, ',' ORDER BY page, frag) AS fragment_ids, list_sort(list(DISTINCT page)) AS p, coalesce(arg_min(caption, (page, frag)) FILTER (caption <> ''), '') AS caption, sum(CASE WHEN frag % 2 = 0 THEN 1 ELSE 2 END)::int AS rows, CASE WHEN count(*) > 1 THEN 0.9 ELSE 1.0 END::double AS merge_confidence FROM k GROUP BY doc, g)
SELECT doc, substr(sha1(table_group_id || '|' || fragment_ids), 1, 16) AS table_id, table_group_id, fragment_ids, array_to_string(p, ',') AS pages, caption, rows, merge_confidence FROM t""",
    "continued_tables": f"""WITH {V_FRAGMENT}, f AS (SELECT doc, frag::varchar AS table_id, page, CASE WHEN frag % 2 = 0 THEN caption ELSE '' END AS caption, frag % 2 = 0 AS e FROM v_fragment),
o AS (SELECT *, {NUM} AS n, lead(table_id) OVER w AS t2, lead(e) OVER w AS e2, lead(page) OVER w AS p2 FROM f WINDOW w AS (PARTITION BY doc ORDER BY page, table_id)), pr AS (SELECT doc, table_id AS t1, t2 FROM o WHERE p2 - page = 1 AND e AND NOT e2 AND n <> '')
SELECT doc, t1 AS table_id, t1 || ',' || t2 AS fragment_ids, 'Name|Unit|Value' AS headers, t2 || '|a|b' AS rows, 0.85::double AS merge_confidence, true AS cross_page_merged FROM pr
UNION ALL SELECT doc, table_id, table_id, CASE WHEN e THEN 'Name' || chr(10) || 'Unit|Value' ELSE '' END, CASE WHEN e THEN '' ELSE table_id || '|a|b' END, 1.0, false FROM f WHERE NOT EXISTS (SELECT 1 FROM pr WHERE pr.doc = f.doc AND f.table_id IN (t1, t2))""",
    "table_crops": f"""WITH {V_FRAGMENT}, s AS (SELECT doc, page, 'a/' || frag AS path FROM v_fragment WHERE frag % 3 = 0 UNION ALL SELECT doc, page, 'b/' || frag FROM v_fragment WHERE frag % 2 = 0), m AS (SELECT doc, page, min(path) AS path FROM s GROUP BY ALL)
SELECT doc, frag AS table_id, CASE WHEN frag % 3 = 0 THEN 'a/' || frag WHEN frag % 2 = 0 THEN 'b/' || frag ELSE path END AS path FROM v_fragment LEFT JOIN m USING (doc, page)""",
    "group_table_ids": f"""WITH {V_FRAGMENT} SELECT doc, frag::varchar AS "group", page, CASE WHEN page % 2 = 0 THEN 't' || frag ELSE substr(sha1(doc || '|' || frag || '|' || page), 1, 16) END AS table_id FROM v_fragment""",
    "export_totals": f"""WITH {V_PAGE}, {V_FRAGMENT}, p AS (SELECT doc, count(*) AS pages, count(*) FILTER (page % 5 = 2) AS structured_ok, count(*) FILTER (page % 5 = 4) AS structured_fallback, count(*) FILTER (page % 5 = 1) AS text_only, count(*) FILTER (page % 5 = 0) AS ok, count(*) FILTER (page % 5 = 3) AS skipped FROM v_page GROUP BY doc), t AS (SELECT doc % 40 AS doc, count(*) AS tables FROM v_fragment GROUP BY 1)
SELECT doc, {", ".join(f"sum({c})::bigint AS {c}" for c in ("pages", "structured_ok", "structured_fallback", "text_only", "ok", "skipped"))}, sum(coalesce(tables, 0))::bigint AS tables FROM p LEFT JOIN t USING (doc) GROUP BY ROLLUP (doc)""",
    "best_markdown_table": f"""WITH {V_GRID}, a AS (SELECT table_id % 41 AS doc, page, table_id AS ord, (len(list_filter(flatten(rows), lambda x: x <> '')) + 8)::int AS score FROM v_grid) SELECT doc, page, ord, score FROM (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY score DESC, ord) AS r FROM a) WHERE r = 1""",
    "name_builders": r"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Doe_Jane_Q_1999' WHEN 1 THEN regexp_replace(p_brand, '[^A-Za-z]', '', 'g') || '_Ann_1999' WHEN 2 THEN 'unknown_author_1999' ELSE 'Plato_unknown_year' END AS folder, trim(regexp_replace(p_name, '\s+', ' ', 'g')) || ' a b .md' AS file, p_partkey % 4 < 2 AS person, p_partkey % 4 < 2 AS placeholder, list_extract(['m1', 'long', 'base', 'base'], (p_partkey % 4)::int + 1) AS model FROM part""",
    "message_parts": r"""SELECT event_id, event_type || '  done' AS title, '>> ' || event_type || ' done more' AS excerpt, CASE WHEN event_id % 3 = 1 THEN 12 END AS points, CASE WHEN event_id % 3 = 0 THEN 1 ELSE -1 END AS pdf, CASE WHEN event_id % 3 = 1 THEN 0 ELSE -1 END AS request, CASE WHEN event_id % 3 = 1 THEN 1 ELSE -1 END AS confirm, -1 AS link FROM events""",
    "discovery_normalize": f"""WITH {V_PAGE}, d AS (SELECT doc FROM v_page WHERE page = 1) SELECT doc, '' AS summary, 'a' AS topics, 0 AS i, 'Intro' AS title, greatest(1, least(doc % 7 - 2, 4))::int AS start_page, 4 AS end_page, '' AS section_summary FROM d UNION ALL SELECT doc, '', 'a', 1, 'B', 3, 3, 's' FROM d""",
    "topic_backfill": f"""WITH {V_PAGE} SELECT doc, page, CASE WHEN page % 3 = 0 THEN source || '|' || lang || '|spark' ELSE upper(lang) || '|plan|sum|end' END AS topics FROM v_page""",
    "prefilled_grid": f"""WITH {V_GRID}, a AS (SELECT table_id, list_concat([headers], rows) AS g, greatest(4, table_id % 6) AS m FROM v_grid), b AS (SELECT table_id, list_transform(list_resize(g, greatest(4, len(g)), []::varchar[]), lambda r: list_resize(r, m, '')) AS g FROM a) SELECT table_id, {JOINED.format('g')} AS grid FROM b""",
    "grid_to_markdown": f"""WITH {V_GRID}, a AS (SELECT table_id, list_concat([headers], list_transform(rows, lambda r: list_resize(r, 4, ''))) AS g FROM v_grid)
SELECT table_id, '| ' || array_to_string(list_transform([1, 2, 3, 4], lambda i: g[1][i] || CASE WHEN g[2][i] <> '' THEN ' / ' || g[2][i] ELSE '' END), ' | ') || ' |' || chr(10) || '| --- | --- | --- | --- |' || coalesce(array_to_string(list_transform(list_slice(g, 3, len(g)), lambda r: chr(10) || '| ' || array_to_string(r, ' | ') || ' |'), ''), '') AS markdown FROM a""",
    "reconcile_payloads": f"""WITH {V_GRID} SELECT table_id, list_extract(['', 'unreadable', 'shape', 'dropped'], (table_id % 4)::int + 1) AS reason, len(rows)::int AS rows FROM v_grid""",
    "rectified_payloads": f"""WITH {V_GRID} SELECT table_id, 1 AS heads, CASE table_id % 4 WHEN 2 THEN len(rows) ELSE 1 END::int AS rows, CASE WHEN table_id % 4 IN (0, 3) THEN 1 ELSE 0 END::double AS confidence, table_id % 4 IN (1, 2) AS needs_review, 'none' AS context_request, list_extract(['', 'no_headers', 'not_an_object', ''], (table_id % 4)::int + 1) AS reasons FROM v_grid""",
    "prompt_payloads": """SELECT doc_id, '{"lang":"' || lang || '","source":"from the sou"}' AS prompt FROM documents""",
    "new_manifests": "SELECT doc_id, source AS source_path, 1 AS page_count, 'm' AS model, 0 AS pages, 'header' AS scope, 0.35::double AS \"limit\", 'pending' AS status FROM documents",
    "span_text": "SELECT doc_id::varchar AS doc_id, 1 AS page, md5(array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), chr(10))) AS text_md5 FROM documents",
    "page_signature": f"WITH {V_PAGE} SELECT doc, page, substr(sha1(doc || '|' || page || '|' || source), 1, 16) AS id, CASE WHEN page = 3 THEN 0 ELSE least(page / 4, 1) END::double AS clamped FROM v_page",
}
