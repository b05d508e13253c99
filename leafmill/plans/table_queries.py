"""Queries over tables, fragments, cells and facts, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import grid as G
from ..functions import parse
from ..functions import text as T
from ..functions.similarity import ratio
from ..operators import context as C
from ..operators import facts as X
from ..operators import matching as M
from ..operators import pages as P
from ..operators import tables as B
from .page_queries import HEUR
from .stages import settle
from .views import V_FRAGMENT, V_GRID, V_PAGE, V_ROW, table, v_fragment, v_grid, v_page, v_row


def quality_metrics(spark, sf):
    return v_grid(spark, sf).select("table_id", G.quality(F.col("headers"), F.col("rows")).alias("q")).select("table_id", "q.*")


def quality_gate(spark, sf):
    d = v_grid(spark, sf).withColumn("q", G.quality(F.col("headers"), F.col("rows")))
    return d.select("table_id", G.fails_quality(F.col("q")).alias("fails"), G.catastrophic(F.col("headers"), F.filter("rows", lambda r: F.size(r) > 3)).alias("catastrophic"))


def escalation_budget(spark, sf):
    d = v_grid(spark, sf).select((F.col("table_id") % 97).alias("doc"), F.col("table_id").alias("ord"), G.quality(F.col("headers"), F.col("rows")).alias("q"))
    after = F.struct((F.col("q.empty") / 2).alias("empty"), F.col("q.repeated"), (F.col("q.unstable") + F.when(F.col("ord") % 2 == 0, 0.1).otherwise(0.0)).alias("unstable"))
    return B.escalation(d, 3).select("doc", "ord", "fails", "escalate", G.escalation_improves(F.col("q"), after).alias("improves"))


def header_collapse(spark, sf):
    d = v_row(spark, sf).groupBy("table_id").agg(F.max("idx").alias("n"))
    rows = F.array(F.array(*map(F.lit, ("Polymer", "Solvent", "X", "X"))), F.array(F.lit(""), F.lit("Solvent"), F.lit("$a$ \\alpha"), F.col("n").cast("string")), F.array(F.lit(""), F.lit(""), F.lit("b"), F.lit("z"), F.lit("w")))
    return d.select("table_id", F.array_join(G.collapse_headers(rows), "|").alias("headers"))


def header_hierarchy(spark, sf):
    d = v_grid(spark, sf).select("table_id", F.explode(G.hierarchy(F.slice("rows", 1, 2))).alias("h"))
    return d.select("table_id", F.col("h.level").alias("level"), F.array_join("h.cells", "|").alias("cells"))


def transpose_grid(spark, sf):
    d = v_grid(spark, sf).select("table_id", F.posexplode(G.transpose(F.col("headers"), F.col("rows"))).alias("col", "cells"))
    return d.select("table_id", "col", F.array_join("cells", "|").alias("cells"))


def _shifted(spark, sf):
    """Grids with a blank first column in every third table, and headers of numbers in every fourth."""
    g = v_grid(spark, sf)
    rows = F.when(F.col("table_id") % 3 == 0, F.transform("rows", lambda r: F.concat(F.array(F.lit("")), G.fit(r, F.lit(4))))).otherwise(F.col("rows"))
    heads = F.when(F.col("table_id") % 4 == 0, F.array(*[F.lit(str(x)) for x in (10, 20, 30, 40)])).otherwise(F.col("headers"))
    names = F.transform(rows, lambda r: F.transform(r, lambda x, i: F.concat(F.lit("n"), x)))
    return g.select("table_id", heads.alias("headers"), F.when(F.col("table_id") % 8 == 0, names).otherwise(rows).alias("rows"))


def topology_fix(spark, sf):
    d = B.topology(_shifted(spark, sf))
    return d.select("table_id", F.array_join("headers", "|").alias("headers"), B.rows_text(F.col("rows")).alias("rows"), F.array_join("reasons", ",").alias("reasons"))


def completeness_guard(spark, sf):
    r = v_row(spark, sf)
    blank = F.transform("cells", lambda c: F.lit("  "))
    cells = F.when(F.col("table_id") % 5 == 0, blank).when(F.col("idx") % 4 == 2, F.concat(F.array(F.lit("")), F.slice("cells", 2, 9))).otherwise(F.col("cells"))
    return B.complete(r.withColumn("cells", cells), ["table_id"]).select("table_id", "idx", "row_index", "sparse_identifier", F.array_join("cells", "|").alias("cells"))


def required_missing(spark, sf):
    g = v_grid(spark, sf)
    k = F.col("table_id")
    none = F.array().cast("array<string>")
    heads = F.when(k % 2 == 0, F.array(F.lit("Code"), F.lit("x"))).when(k % 7 == 0, F.array(F.lit(""), F.lit("a"))).otherwise(F.col("headers"))
    out = G.required_missing(heads, F.when(k % 3 == 0, F.lit("Table 1: mass in kg")).otherwise(F.lit("Data")), F.when(k % 4 == 0, none).otherwise(F.array(F.lit("m"))), F.when(k % 5 == 0, F.array(F.lit("P2"), F.lit("P1"))).otherwise(none), k % 11 == 0)
    return g.select("table_id", F.array_join(out, ";").alias("missing"))


def flatten_text(spark, sf):
    return v_grid(spark, sf).select("table_id", G.flatten_text(F.col("headers"), F.col("rows")).alias("flat"))


def row_kinds(spark, sf):
    rows = F.transform("rows", lambda r, i: F.when(i % 4 == 1, F.array(F.get(r, F.lit(0)), F.lit(""), F.lit("*"))).when(i % 4 == 3, F.array(F.lit(" "), F.lit(""))).otherwise(r))
    return v_grid(spark, sf).select("table_id", F.array_join(G.row_kinds(rows, F.lit(1)), ",").alias("kinds"))


def cell_normalize(spark, sf):
    c = F.concat(F.lit("  $\\mu_{"), F.col("p_brand"), F.lit("}$\t\\(x\\)<br/>\\alphabet \\Omega  "), F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", T.cell_text(c).alias("cell"), T.ocr_cell(F.when(F.col("p_partkey") % 2 == 0, " <EMPTY> ").otherwise(F.col("p_name"))).alias("ocr"))


def table_numbers(spark, sf):
    return v_fragment(spark, sf).select("frag", T.table_number(F.col("caption")).alias("number"), T.continued(F.col("caption")).alias("continued"))


def fragment_chains(spark, sf):
    return B.chains(v_fragment(spark, sf)).select("doc", "frag", "page", "number", "group_key")


def merged_rows_lineage(spark, sf):
    l = v_row(spark, sf).select("table_id", F.col("page"), (F.col("idx") % 2).alias("frag"), "idx", F.array(F.get("cells", F.lit(0))).alias("cells"))
    return B.merged_rows(l, ["table_id"]).select("table_id", "frag", "idx", "row_index", "source_kind", F.get("cells", F.lit(0)).alias("cell"))


def cross_page_pairs(spark, sf):
    f = v_fragment(spark, sf)
    caption = F.when(F.col("frag") % 2 == 0, F.col("caption")).otherwise(F.replace("caption", F.lit("Table"), F.lit("Cont. table")))
    return B.continuation_pairs(f.select("doc", F.col("frag").alias("table_id"), F.col("page").alias("page_min"), F.col("page").alias("page_max"), caption.alias("caption"), ((F.col("frag") % 4 == 0) | (F.col("frag") % 3 == 1)).alias("empty_body")))


def caption_binding(spark, sf):
    f = v_fragment(spark, sf)
    t = f.where("frag % 2 = 0").select("doc", "page", F.col("frag").alias("table_id"), T.table_number(F.col("caption")).alias("number"), (F.col("frag") * 37 % 800).cast("double").alias("y"))
    c = f.where("frag % 2 = 1").select("doc", "page", F.col("frag").alias("cap_id"), T.table_number(F.col("caption")).alias("cap_number"), F.when(F.col("frag") % 5 != 0, (F.col("frag") * 53 % 800).cast("double")).alias("cap_y"))
    return B.bind_captions(t, c)


def context_codes(spark, sf):
    """Words of pages as definitions of codes that tables of the same pages use."""
    p = v_page(spark, sf)
    word = F.regexp_extract("text", "([a-z]{4,12})", 1)
    line = F.concat(F.lit("P"), (F.col("page") % 6).cast("string"), F.when(F.col("page") % 2 == 0, " = ").otherwise(": "), word, F.lit(" resin.; Q"), (F.col("page") % 4).cast("string"), F.lit(" = "), F.col("source"), F.lit("; made of "), word, F.lit(" (XR"), (F.col("page") % 3).cast("string"), F.lit(")"))
    lines = P.lines(p.withColumn("text", F.concat("text", F.lit("\n"), line)))
    rows = F.array(F.array(F.lit("P1"), F.lit("1")), F.array(F.concat(F.lit("Q"), (F.col("page") % 5).cast("string"))), F.array(F.lit("XR2 blend")), F.array(F.lit("kg")), F.array(F.lit("12")), F.array(F.lit("ab")))
    tables = p.select("doc", F.col("page").alias("table_id"), "page", F.array(F.lit("Sample"), F.lit("v")).alias("headers"), rows.alias("rows"))
    return C.resolve(tables, lines)


def _gold_pred(spark, sf):
    """Grids as gold tables, and a copy with tables dropped and cells changed."""
    g = v_grid(spark, sf).select((F.col("table_id") % 41).cast("int").alias("doc"), "page", F.col("table_id").alias("ord"), "headers", "rows")
    cell = lambda x, i, k: F.when((k % 13 == 0) & (i == 1), F.concat(F.lit("n"), x)).when((k % 17 == 0) & (i == 2), F.concat(x, F.lit(" ±1"))).otherwise(x)
    rows = F.transform("rows", lambda r: F.transform(r, lambda x, i: cell(x, i, F.col("ord"))))
    rows = F.when(F.col("ord") % 19 == 0, F.slice(rows, 1, 2)).otherwise(rows)
    heads = F.when(F.col("ord") % 23 == 0, F.slice("headers", 1, 3)).otherwise(F.col("headers"))
    return g, g.where("ord % 11 <> 0").select("doc", "page", "ord", heads.alias("headers"), rows.alias("rows"))


def reconcile_sources(spark, sf):
    f = v_fragment(spark, sf).withColumn("number", T.table_number(F.col("caption")))
    return M.reconcile(f.select("doc", "page", "number"), f.where("frag % 7 <> 0").select("doc", F.when(F.col("frag") % 5 == 0, F.col("page") + 1).otherwise(F.col("page")).alias("page"), "number"))


def page_match_candidates(spark, sf):
    return M.candidates(*_gold_pred(spark, sf))


def page_match_greedy(spark, sf):
    return M.match(*_gold_pred(spark, sf))


def page_match_fallback(spark, sf):
    g, p = _gold_pred(spark, sf)
    return M.pick_fallback(g, p, M.candidates(g, p, 0.9))


def ocr_patch(spark, sf):
    g, p = _gold_pred(spark, sf)
    return M.patch_grids(g, p, p.select("doc", "page", F.col("ord").alias("l"), F.col("ord").alias("r")), changed=True)


def compare_readings(spark, sf):
    g, p = _gold_pred(spark, sf)
    pairs = p.select("doc", "page", F.col("ord").alias("l"), F.col("ord").alias("r"))
    return M.compare(g, p, pairs)


def ratio_self(spark, sf):
    d = table(spark, sf, "part").select("p_partkey", "p_name", F.reverse("p_name").alias("rev"))
    return d.select("p_partkey", ratio(F.col("p_name"), F.col("rev")).alias("ratio"))


def _doc_grids(spark, sf):
    return v_grid(spark, sf).select((F.col("table_id") % 41).cast("string").alias("doc_id"), "table_id", "page", F.lit("").alias("caption"), "headers", "rows")


def facts_table(spark, sf):
    return X.errors(X.from_tables(_doc_grids(spark, sf))).select("record_id", "doc_id", "material_name_raw", "property_name_normalized", "value_raw", F.col("value_numeric").cast("decimal(18,2)").alias("value_numeric"), "unit_normalized", "confidence", F.col("source.row_index").alias("row_index"), F.col("source.col_index").alias("col_index"), F.size("errors").alias("errors"))


def facts_figures(spark, sf):
    figs = B.figures(_figure_pages(spark, sf)).select(F.col("doc").cast("string").alias("doc_id"), "page", "figure_id", "alt_text", "image_ref")
    u = X.union(X.from_tables(_doc_grids(spark, sf)), X.from_figures(figs))
    return u.groupBy("method_context", "extraction_stage").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"), F.sum((F.col("confidence") * 100).cast("long")).alias("sure"))


def facts_summary(spark, sf):
    return X.summary(X.from_tables(_doc_grids(spark, sf)))


def _figure_pages(spark, sf):
    t = F.concat(F.lit("![ plot "), F.col("source"), F.lit("](img/fig_"), F.col("page").cast("string"), F.lit(".png?x#y) text ![](a.jpg)"))
    return v_page(spark, sf).select("doc", "page", t.alias("text"))


def markdown_figures(spark, sf):
    return B.figures(_figure_pages(spark, sf))


def figure_assets(spark, sf):
    p = v_page(spark, sf).select("doc", "page")
    exact = p.where("page % 2 = 0").select("doc", "page", F.concat(F.lit("img/fig_"), F.col("page").cast("string"), F.lit(".png")).alias("path"))
    other = p.where("page % 5 = 0").select("doc", "page", F.lit("z/a.jpg").alias("path")).unionByName(p.where("page % 3 = 0").select("doc", (F.col("page") + 1).alias("page"), F.concat(F.lit("y/fig_"), F.col("page").cast("string"), F.lit(".png")).alias("path")))
    return B.resolve_figures(B.figures(_figure_pages(spark, sf)), exact.unionByName(other))


def html_grid_round_trip(spark, sf):
    """Grids written as HTML and read back: the text of the grid padded to one width."""
    g = v_grid(spark, sf)
    row = lambda r, tag: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, lambda x: F.concat(F.lit(f"<{tag}>"), x, F.lit(f"</{tag}>"))), ""), F.lit("</tr>"))
    html = F.concat(F.lit("<table>"), row(F.col("headers"), "th"), F.array_join(F.transform("rows", lambda r: row(r, "td")), ""), F.lit("</table>"))
    d = g.select("table_id", parse.html_grid(html).alias("g"))
    return d.select("table_id", B.rows_text(F.col("g.header_rows")).alias("headers"), B.rows_text(F.col("g.data_rows")).alias("rows"))


def markdown_table_round_trip(spark, sf):
    g = v_grid(spark, sf)
    row = lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))
    body = F.array_join(F.transform("rows", lambda r: row(G.fit(r, F.lit(4)))), "\n")
    text = F.concat(F.lit("Intro\n\nTable 1: data\n\n"), row(F.col("headers")), F.lit("\n|---|:--|--:|---|\n"), body, F.lit("\n\nEnd"))
    d = g.select("table_id", F.explode(parse.markdown_tables(text)).alias("t"))
    return d.select("table_id", "t.caption", "t.start_line", F.array_join("t.headers", "|").alias("headers"), B.rows_text(F.col("t.rows")).alias("rows"))


def block_tree_tables(spark, sf):
    """Nested layout JSON of a document's fragments, flattened to raw tables with captions."""
    f = v_fragment(spark, sf)
    node = F.struct(F.concat(F.lit("/page/"), (F.col("page") - 1).cast("string"), F.lit("/Table/"), F.col("frag").cast("string")).alias("id"), F.lit("Table").alias("block_type"), F.array(F.lit(0.0), (F.col("frag") % 500).cast("double"), F.lit(9.0), F.lit(9.0)).alias("bbox"), F.concat(F.lit("<table><tr><th>A</th></tr><tr><td>"), F.col("frag").cast("string"), F.lit("</td></tr></table>")).alias("html"))
    cap = F.struct(F.concat(F.lit("/page/"), (F.col("page") - 1).cast("string"), F.lit("/Caption/"), F.col("frag").cast("string")).alias("id"), F.lit("Caption").alias("block_type"), F.array(F.lit(0.0), (F.col("frag") % 500).cast("double") - 1, F.lit(9.0), F.lit(9.0)).alias("bbox"), F.concat(F.lit("<p>"), F.col("caption"), F.lit("</p>")).alias("html"))
    tree = F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("frag", F.struct(F.array(node, cap).alias("children")).alias("group")))).alias("children")))
    d = f.groupBy("doc").agg(tree.alias("payload")).select("doc", F.explode(parse.block_tree("payload")).alias("b")).select("doc", "b.*")
    t = B.raw_tables(settle(d))  # the blocks are read several times
    frags = B.chains(B.fragments_of(t))
    keys = frags.groupBy("doc").agg(F.countDistinct("group_key").alias("groups"))
    return t.groupBy("doc").agg(F.count("*").alias("tables"), F.count("cap_id").alias("captioned"), F.max("page").alias("last_page"), F.sum(F.get(F.get("data_rows", F.lit(0)), F.lit(0)).cast("long")).alias("cell_sum")).join(keys, "doc")


def html_evidence(spark, sf):
    g = v_row(spark, sf)
    html = F.concat(F.lit("<table><tr><th colspan=2>Head</th><th rowspan='2'>R</th></tr><tr><td>"), F.get("cells", F.lit(0)), F.lit("</td><td>"), F.get("cells", F.lit(1)), F.lit("</td></tr></table>"))
    return g.select("table_id", "idx", parse.html_evidence(html).alias("e")).select("table_id", "idx", F.array_join("e.lines", ";").alias("lines"), F.array_join("e.joins", ";").alias("joins"))


def grid_from_spans(spark, sf):
    r = v_row(spark, sf)
    c = r.select("table_id", F.col("idx").alias("ord"), (F.col("idx") % 4).cast("int").alias("r0"), (F.col("idx") % 4 + F.col("idx") % 2).cast("int").alias("r1"), (F.col("idx") % 3).cast("int").alias("c0"), (F.col("idx") % 3 + 1).cast("int").alias("c1"), F.get("cells", F.lit(1)).alias("text"))
    return B.grid_from_spans(c)


def source_fallback(spark, sf):
    g = v_grid(spark, sf).select((F.col("table_id") % 97).alias("doc"), "table_id", "headers", "rows")
    c = g.select("doc", "table_id", F.explode(F.array(*[F.struct(F.lit(s).alias("source"), F.lit(i).alias("rank")) for i, s in enumerate(("layout", "ocr", "markdown"))])).alias("s"), "headers", "rows").select("doc", "table_id", "s.*", "headers", "rows")
    k = F.col("table_id") + F.col("rank")
    rows = F.when(k % 3 == 0, F.slice("rows", 1, 0)).otherwise(F.col("rows"))
    heads = F.when(k % 5 == 0, F.array(*[F.lit("X")] * 4)).when(k % 7 == 0, F.array(F.lit("a"), *[F.lit("")] * 3)).otherwise(F.col("headers"))
    return B.fallback(c.withColumn("reason", G.catastrophic(heads, rows)))


def export_status(spark, sf):
    f = v_fragment(spark, sf)
    flags = f.where("frag % 9 = 0").select("doc", F.when(F.col("frag") % 27 == 0, "error").when(F.col("frag") % 2 == 0, "info").otherwise("warn").alias("severity"))
    return B.export_status(flags, f)


def flag_upsert(spark, sf):
    f = v_fragment(spark, sf).select((F.col("frag") % 500).cast("string").alias("flag_id"), F.col("frag").alias("ord"))
    return B.add_flags(f.where("ord <= 700 AND ord % 3 = 0").groupBy("flag_id").agg(F.min("ord").alias("ord")), f.where("ord > 700"))


CODE = r"[A-Za-z][A-Za-z0-9\-]{0,11}"
SPACE = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
JOINED = "array_to_string(list_transform(rows, lambda r: array_to_string(r, '|')), chr(10))"
DISTINCT_WORDS = r"list_distinct(list_filter(flatten(list_transform(list_concat(headers, coalesce(rows[1], [])), lambda c: regexp_split_to_array(lower(c), '[^\p{L}\p{N}_]+'))), lambda w: w <> ''))"
Q = f"""{V_GRID},
q0 AS (SELECT *, flatten(rows) AS cells FROM v_grid),
q AS (SELECT table_id, page, headers, rows, len(list_filter(cells, lambda x: trim(x) = '')) / (len(headers) * greatest(len(rows), 1)) AS empty,
  list_max(list_transform(list_distinct(cells), lambda v: len(list_filter(cells, lambda x: x = v)))) / greatest(len(cells), 1) AS repeated,
  len(list_filter(rows, lambda r: len(r) <> len(headers))) / greatest(len(rows), 1) AS unstable FROM q0)"""
FAILS = "(empty > 0.35 OR repeated > 0.45 OR unstable > 0.20)"
CAT = """CASE WHEN len(r) = 0 THEN 'no_data_rows' WHEN len(h) >= 4 AND len(list_filter(h, lambda x: x <> '')) <= 1 THEN 'sparse_headers' WHEN len(list_filter(h, lambda x: x <> '')) >= 3 AND len(list_distinct(list_filter(h, lambda x: x <> ''))) <= 1 THEN 'duplicate_headers' ELSE '' END"""
NUM = r"coalesce(lower(nullif(regexp_extract(caption, '(?i)\b(?:table|tab\.?)\s*([0-9ivxlcdm]+)\b', 1), '')), '')"
GOLD = f"""{V_GRID}, g AS (SELECT (table_id % 41)::int AS doc, page, table_id AS ord, headers, rows FROM v_grid),
p0 AS (SELECT doc, page, ord, CASE WHEN ord % 23 = 0 THEN list_slice(headers, 1, 3) ELSE headers END AS headers,
  list_transform(rows, lambda r: list_transform(r, lambda x, i: CASE WHEN ord % 13 = 0 AND i = 2 THEN 'n' || x WHEN ord % 17 = 0 AND i = 3 THEN x || ' ±1' ELSE x END)) AS rows FROM g WHERE ord % 11 <> 0),
p AS (SELECT doc, page, ord, headers, CASE WHEN ord % 19 = 0 THEN list_slice(rows, 1, 2) ELSE rows END AS rows FROM p0)"""
CAND = f"""{GOLD}, a AS (SELECT *, {DISTINCT_WORDS} AS w FROM g), b AS (SELECT *, {DISTINCT_WORDS} AS w FROM p),
c AS (SELECT a.doc, a.page, a.ord AS l, b.ord AS r, 0.7::double * (CASE WHEN len(a.w) = 0 AND len(b.w) = 0 THEN 1.0 WHEN len(a.w) = 0 OR len(b.w) = 0 THEN 0.0 ELSE len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) END)
  + 0.2::double * (1 - abs(len(a.headers) - len(b.headers)) / greatest(len(a.headers), len(b.headers), 1)) + 0.1::double * (1 - abs(len(a.rows) - len(b.rows)) / greatest(len(a.rows), len(b.rows), 1)) AS score
  FROM a JOIN b ON a.doc = b.doc AND a.page = b.page)"""
FACTS = rf"""{V_GRID}, f0 AS (SELECT (table_id % 41)::varchar AS doc_id, table_id, headers, unnest(rows) AS cells, generate_subscripts(rows, 1) - 1 AS row_index FROM v_grid),
f1 AS (SELECT doc_id, table_id, cells, row_index, unnest(headers) AS prop, generate_subscripts(headers, 1) - 1 AS col_index FROM f0),
f AS (SELECT doc_id, table_id, row_index, col_index, cells[1] AS material, prop, cells[col_index + 1] AS value_raw, regexp_extract(prop, '\(([^)]+)\)', 1) AS unit,
  try_cast(nullif(cells[col_index + 1], '') AS decimal(18,2)) AS num FROM f1 WHERE col_index >= 1 AND col_index < len(cells))"""

QUERIES = {f.__name__: f for f in (quality_metrics, quality_gate, escalation_budget, header_collapse, header_hierarchy, transpose_grid, topology_fix, completeness_guard, required_missing, flatten_text, row_kinds, cell_normalize, table_numbers, fragment_chains, merged_rows_lineage, cross_page_pairs, caption_binding, context_codes, reconcile_sources, page_match_candidates, page_match_greedy, page_match_fallback, ocr_patch, compare_readings, ratio_self, facts_table, facts_figures, facts_summary, markdown_figures, figure_assets, html_grid_round_trip, markdown_table_round_trip, block_tree_tables, html_evidence, grid_from_spans, source_fallback, export_status, flag_upsert)}
SQL = {
    "quality_metrics": f"WITH {Q} SELECT table_id, empty, repeated, unstable FROM q",
    "quality_gate": f"WITH {Q}, z AS (SELECT *, headers AS h, list_filter(rows, lambda x: len(x) > 3) AS r FROM q) SELECT table_id, {FAILS} AS fails, {CAT} AS catastrophic FROM z",
    "escalation_budget": f"""WITH {Q}, a AS (SELECT table_id % 97 AS doc, table_id AS ord, {FAILS} AS fails, empty - empty / 2 AS de, unstable - (unstable + CASE WHEN table_id % 2 = 0 THEN 0.1 ELSE 0 END::double) AS du FROM q),
b AS (SELECT *, row_number() OVER (PARTITION BY doc, fails ORDER BY ord) AS r FROM a)
SELECT doc, ord, fails, fails AND r <= 3 AS escalate, (de >= 0.05 OR du >= 0.05) AND NOT (-de > 0.05 OR -du > 0.05) AS improves FROM b""",
    "header_collapse": f"WITH {V_ROW} SELECT table_id, 'Polymer|Solvent|X (a α / b)|X (' || max(idx) || ' / z)|w' AS headers FROM v_row GROUP BY table_id",
    "header_hierarchy": f"WITH {V_GRID}, a AS (SELECT table_id, unnest(list_slice(rows, 1, 2)) AS c, generate_subscripts(list_slice(rows, 1, 2), 1)::int AS level FROM v_grid) SELECT table_id, level, array_to_string(c, '|') AS cells FROM a",
    "transpose_grid": f"""WITH {V_GRID}, a AS (SELECT table_id, list_concat([headers], rows) AS g, unnest(range(4))::int AS col FROM v_grid)
SELECT table_id, col, array_to_string(list_transform(g, lambda r: coalesce(r[col + 1], '')), '|') AS cells FROM a""",
    "topology_fix": rf"""WITH {V_GRID}, a0 AS (SELECT table_id, CASE WHEN table_id % 4 = 0 THEN ['10', '20', '30', '40'] ELSE headers END AS h,
  CASE WHEN table_id % 3 = 0 THEN list_transform(rows, lambda r: list_concat([''], list_resize(r, 4, ''))) ELSE rows END AS r FROM v_grid),
a AS (SELECT table_id, h, CASE WHEN table_id % 8 = 0 THEN list_transform(r, lambda x: list_transform(x, lambda y: 'n' || y)) ELSE r END AS r FROM a0),
b AS (SELECT *, len(list_filter(r, lambda x: len(x) = 5 AND trim(x[1]) = '')) >= greatest(1, floor(0.7 * len(r))) AS lead, len(list_filter(r, lambda x: len(x) = 5 AND trim(x[-1]) = '')) >= greatest(1, floor(0.7 * len(r))) AS trail FROM a),
c AS (SELECT table_id, h, CASE WHEN lead THEN 'leading_empty_column_shift' WHEN trail THEN 'trailing_empty_column_shift' END AS why,
  CASE WHEN lead THEN list_transform(r, lambda x: CASE WHEN len(x) > 4 THEN list_slice(x, 2, len(x)) ELSE x END) WHEN trail THEN list_transform(r, lambda x: CASE WHEN len(x) > 4 THEN list_slice(x, 1, len(x) - 1) ELSE x END) ELSE r END AS r FROM b),
d AS (SELECT *, greatest(4, list_max(list_transform(r, lambda x: len(x)))) AS w, flatten(r) AS f, list_transform(r, lambda x: x[1]) AS c1 FROM c),
e AS (SELECT *, list_transform(range(w), lambda i: list_transform(list_concat([h], r), lambda x: coalesce(x[i + 1], ''))) AS t FROM d),
o AS (SELECT *, t[1] AS th, t[2:] AS tr FROM e),
s AS (SELECT *, CASE WHEN len(r) < 2 OR len(list_filter(h, lambda x: regexp_full_match(x, '[-+]?[0-9]+(\.[0-9]+)?'))) / len(h) < 0.75 THEN false ELSE
  (0.45 * (0.6 * len(list_filter(th, lambda x: x <> '' AND NOT regexp_full_match(x, '[-+]?[0-9]+(\.[0-9]+)?'))) / len(th) + 0.4 * len(list_filter(th, lambda x: x <> '')) / len(th))
   + 0.3 * len(list_filter(flatten(tr), lambda x: regexp_full_match(x, '[-+]?[0-9]+(\.[0-9]+)?'))) / greatest(len(flatten(tr)), 1) + 0.25 * len(list_filter(list_transform(tr, lambda x: x[1]), lambda x: x <> '' AND NOT regexp_full_match(x, '[-+]?[0-9]+(\.[0-9]+)?'))) / greatest(len(tr), 1))
 - (0.45 * (0.6 * len(list_filter(h, lambda x: x <> '' AND NOT regexp_full_match(x, '[-+]?[0-9]+(\.[0-9]+)?'))) / len(h) + 0.4 * len(list_filter(h, lambda x: x <> '')) / len(h))
   + 0.3 * len(list_filter(f, lambda x: regexp_full_match(x, '[-+]?[0-9]+(\.[0-9]+)?'))) / greatest(len(f), 1) + 0.25 * len(list_filter(c1, lambda x: x <> '' AND NOT regexp_full_match(x, '[-+]?[0-9]+(\.[0-9]+)?'))) / greatest(len(c1), 1)) >= 0.35 END AS turn FROM o),
u AS (SELECT table_id, why, turn, CASE WHEN turn THEN th ELSE h END AS h, CASE WHEN turn THEN tr ELSE r END AS r FROM s)
SELECT table_id, array_to_string(h, '|') AS headers, array_to_string(list_transform(r, lambda x: array_to_string(list_resize(x, len(h), ''), '|')), chr(10)) AS rows,
  array_to_string(list_sort(list_filter([why, CASE WHEN turn THEN 'transpose_recovery' END, CASE WHEN len(list_filter(r, lambda x: len(x) < len(h))) > 0 THEN 'row_padding' END, CASE WHEN len(list_filter(r, lambda x: len(x) > len(h))) > 0 THEN 'row_trimming' END], lambda x: x IS NOT NULL)), ',') AS reasons FROM u""",
    "completeness_guard": f"""WITH {V_ROW}, a AS (SELECT table_id, idx, CASE WHEN table_id % 5 = 0 THEN list_transform(cells, lambda c: '  ') WHEN idx % 4 = 2 THEN list_concat([''], list_slice(cells, 2, 10)) ELSE cells END AS cells FROM v_row),
b AS (SELECT *, list_transform(cells, lambda c: trim(c)) AS sig FROM a), c AS (SELECT *, row_number() OVER (PARTITION BY table_id, sig ORDER BY idx) = 1 AND array_to_string(sig, '') <> '' AS ok FROM b),
d AS (SELECT *, bool_or(ok) OVER (PARTITION BY table_id) AS has FROM c), e AS (SELECT * FROM d WHERE ok OR NOT has)
SELECT table_id, idx, (row_number() OVER (PARTITION BY table_id ORDER BY idx) - 1)::int AS row_index, sum((sig[1] <> '')::int) OVER (PARTITION BY table_id) < greatest(1, floor(0.6 * count(*) OVER (PARTITION BY table_id))) AS sparse_identifier, array_to_string(cells, '|') AS cells FROM e""",
    "required_missing": rf"""WITH {V_GRID}, a AS (SELECT table_id AS k, CASE WHEN table_id % 2 = 0 THEN ['Code', 'x'] WHEN table_id % 7 = 0 THEN ['', 'a'] ELSE headers END AS h FROM v_grid)
SELECT k AS table_id, array_to_string(list_sort(list_filter([CASE WHEN k % 3 = 0 AND NOT regexp_matches(array_to_string(h, ' '), '{T.UNITS.replace(chr(92)+"b", "")[:4]}(mol|g|l|%|ppm|pa\b|wt\b)') THEN 'units_not_propagated_from_caption' END,
  CASE WHEN k % 5 = 0 THEN 'unresolved_code_mappings:P1,P2' END, CASE WHEN len(list_filter(h, lambda x: x <> '')) <= 1 THEN 'missing_required_columns' END, CASE WHEN k % 11 = 0 THEN 'incomplete_identifier_column' END,
  CASE WHEN k % 4 = 0 AND contains(lower(array_to_string(h, ' ')), 'code') THEN 'missing_context_mappings' END], lambda x: x IS NOT NULL)), ';') AS missing FROM a""",
    "flatten_text": f"WITH {V_GRID} SELECT table_id, array_to_string(list_transform(list_concat([headers], rows), lambda r: array_to_string(r, ' | ')), chr(10)) AS flat FROM v_grid",
    "row_kinds": f"WITH {V_GRID} SELECT table_id, array_to_string(list_transform(rows, lambda r, i: CASE WHEN i = 1 THEN 'header' WHEN (i - 1) % 4 = 1 THEN 'group' WHEN (i - 1) % 4 = 3 THEN 'empty' WHEN len(list_filter(r[2:], lambda x: x <> '')) <= 1 THEN 'group' ELSE 'data' END), ',') AS kinds FROM v_grid",
    "cell_normalize": r"""SELECT p_partkey, 'μ_' || trim(regexp_replace(p_brand, '\s+', ' ', 'g')) || ' x \alphabet Ω ' || trim(regexp_replace(p_name, '\s+', ' ', 'g')) AS cell, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE trim(regexp_replace(p_name, '\s+', ' ', 'g')) END AS ocr FROM part""",
    "table_numbers": f"WITH {V_FRAGMENT} SELECT frag, {NUM} AS number, contains(caption, 'continued') AS continued FROM v_fragment",
    "fragment_chains": f"""WITH {V_FRAGMENT}, a AS (SELECT *, {NUM} AS number FROM v_fragment),
b AS (SELECT *, CASE WHEN number = '' THEN 0 WHEN page - lag(page) OVER w BETWEEN 0 AND 1 AND (contains(caption, 'continued') OR contains(lag(caption) OVER w, 'continued') OR len(list_intersect(list_distinct(tokens), list_distinct(lag(tokens) OVER w))) / len(list_distinct(list_concat(tokens, lag(tokens) OVER w))) >= 0.75) THEN 0 ELSE 1 END AS br FROM a WINDOW w AS (PARTITION BY doc, number ORDER BY page, frag)),
c AS (SELECT *, sum(br) OVER (PARTITION BY doc, number ORDER BY page, frag)::int AS chain FROM b)
SELECT doc, frag, page, number, CASE WHEN number = '' THEN 'fragment:' || frag ELSE 'number:' || number || ':' || chain END AS group_key FROM c""",
    "merged_rows_lineage": f"""WITH {V_ROW}, a AS (SELECT table_id, page, idx % 2 AS frag, idx, cells[1] AS cell FROM v_row), b AS (SELECT *, lag(cell) OVER (PARTITION BY table_id ORDER BY page, frag, idx) AS prev FROM a)
SELECT table_id, frag, idx, (row_number() OVER (PARTITION BY table_id ORDER BY page, frag, idx) - 1)::int AS row_index, 'data_row' AS source_kind, cell FROM b WHERE prev IS NULL OR prev <> cell""",
    "cross_page_pairs": f"""WITH RECURSIVE {V_FRAGMENT}, a AS (SELECT doc, frag, page, (frag % 4 = 0 OR frag % 3 = 1) AS e, CASE WHEN frag % 2 = 0 THEN caption ELSE replace(caption, 'Table', 'Cont. table') END AS caption FROM v_fragment),
b AS (SELECT *, {NUM} AS n, row_number() OVER w AS pos FROM a WINDOW w AS (PARTITION BY doc ORDER BY page, frag)),
c AS (SELECT x.doc, x.pos, x.frag AS f1, y.frag AS f2, y.frag IS NOT NULL AND y.page - x.page = 1 AND x.e AND NOT y.e AND x.n <> '' AND (y.n = '' OR y.n = x.n) AND NOT lower(y.caption) LIKE 'table %' AS ok FROM b x LEFT JOIN b y ON x.doc = y.doc AND y.pos = x.pos + 1),
walk AS (SELECT doc, pos, f1, f2, ok, CASE WHEN ok THEN 2 ELSE 1 END AS step FROM c WHERE pos = 1 UNION ALL SELECT c.doc, c.pos, c.f1, c.f2, c.ok, CASE WHEN c.ok THEN 2 ELSE 1 END FROM walk w JOIN c ON c.doc = w.doc AND c.pos = w.pos + w.step)
SELECT doc, f1 AS first, f2 AS second FROM walk WHERE ok""",
    "caption_binding": f"""WITH {V_FRAGMENT}, t AS (SELECT doc, page, frag AS table_id, {NUM} AS n, (frag * 37 % 800)::double AS y FROM v_fragment WHERE frag % 2 = 0),
c AS (SELECT doc, page, frag AS cap_id, {NUM} AS cn, CASE WHEN frag % 5 <> 0 THEN (frag * 53 % 800)::double END AS cy FROM v_fragment WHERE frag % 2 = 1),
j AS (SELECT t.*, cap_id, row_number() OVER (PARTITION BY t.table_id ORDER BY CASE WHEN n <> '' AND n = cn THEN 0 ELSE 1 END, coalesce(abs(y - cy) + CASE WHEN cy <= y THEN 0 ELSE 1000 END, 999999), coalesce(abs(y - cy), 999999), cap_id) AS r FROM t LEFT JOIN c USING (doc, page))
SELECT doc, page, table_id, cap_id, CASE WHEN cap_id IS NULL THEN 0.6 ELSE 0.95 END::double AS caption_confidence FROM j WHERE r = 1""",
    "context_codes": rf"""WITH {V_PAGE}, w AS (SELECT *, regexp_extract(text, '([a-z]{{4,12}})', 1) AS w FROM v_page),
x AS (SELECT doc, page, string_split(replace(text || chr(10) || 'P' || page % 6 || CASE WHEN page % 2 = 0 THEN ' = ' ELSE ': ' END || w || ' resin.; Q' || page % 4 || ' = ' || source || '; made of ' || w || ' (XR' || page % 3 || ')', chr(13) || chr(10), chr(10)), chr(10)) AS ls FROM w),
l AS (SELECT doc, page, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS idx FROM x),
s AS (SELECT doc, page, idx, trim(regexp_replace(line, '{SPACE}+', ' ', 'g')) AS t FROM l WHERE contains(line, ':') OR contains(line, '=') OR contains(line, '(')),
d AS (SELECT doc, page, idx, unnest(regexp_extract_all(t, '^({CODE})\s*[:=]\s*(.+)$', 1)) AS code, unnest(regexp_extract_all(t, '^({CODE})\s*[:=]\s*(.+)$', 2)) AS r, 0.95::double AS confidence, 'equals' AS kind, 1 AS q FROM s
  UNION ALL SELECT doc, page, idx, unnest(regexp_extract_all(t, '\b({CODE})\s*[:=]\s*([^;]+)', 1)), unnest(regexp_extract_all(t, '\b({CODE})\s*[:=]\s*([^;]+)', 2)), 0.88, 'inline_equals', 2 FROM s
  UNION ALL SELECT doc, page, idx, unnest(regexp_extract_all(t, '([A-Za-z][A-Za-z0-9\s,\-]{{2,80}})\(\s*({CODE})\s*\)', 2)), unnest(regexp_extract_all(t, '([A-Za-z][A-Za-z0-9\s,\-]{{2,80}})\(\s*({CODE})\s*\)', 1)), 0.75, 'paren_reverse', 3 FROM s),
e AS (SELECT *, regexp_replace(trim(regexp_replace(r, '{SPACE}+', ' ', 'g')), '[.,;]+$', '') AS resolved FROM d WHERE code IN ('P1', 'Q0', 'Q1', 'Q2', 'Q3', 'Q4', 'XR2')),
t AS (SELECT doc, page, unnest(['P1', 'Q' || page % 5, 'XR2']) AS code FROM v_page),
j AS (SELECT t.doc, t.page AS table_id, t.page, t.code, e.resolved, e.confidence, e.page AS source_page, e.idx AS source_line, e.kind, row_number() OVER (PARTITION BY t.doc, t.page, t.code ORDER BY e.confidence DESC NULLS LAST, e.page, e.idx) AS r FROM t LEFT JOIN e ON t.doc = e.doc AND t.code = e.code AND e.resolved <> '' AND e.page BETWEEN t.page - 1 AND t.page + 1)
SELECT doc, table_id, page, code, resolved, confidence, source_page, source_line::int AS source_line, kind FROM j WHERE r = 1""",
    "reconcile_sources": f"""WITH {V_FRAGMENT}, a AS (SELECT doc, count(*) AS n, list_sort(list(DISTINCT page)) AS p, coalesce(list_sort(list(DISTINCT nullif({NUM}, '')) FILTER ({NUM} <> '')), []) AS k FROM v_fragment GROUP BY doc),
b AS (SELECT doc, count(*) AS n, list_sort(list(DISTINCT CASE WHEN frag % 5 = 0 THEN page + 1 ELSE page END)) AS p, coalesce(list_sort(list(DISTINCT nullif({NUM}, '')) FILTER ({NUM} <> '')), []) AS k FROM v_fragment WHERE frag % 7 <> 0 GROUP BY doc),
j AS (SELECT doc, coalesce(a.n, 0) AS an, coalesce(b.n, 0) AS bn, coalesce(a.p, []) AS ap, coalesce(b.p, []) AS bp, coalesce(a.k, []) AS ak, coalesce(b.k, []) AS bk FROM a FULL JOIN b USING (doc)),
f AS (SELECT doc, 'count_mismatch' AS type, an || ' / ' || bn AS details FROM j WHERE an <> bn
  UNION ALL SELECT doc, 'page_mismatch', array_to_string(ap, ',') || ' / ' || coalesce(array_to_string(bp, ','), '') FROM j WHERE ap <> bp
  UNION ALL SELECT doc, 'caption_number_mismatch', array_to_string(ak, ',') || ' / ' || array_to_string(bk, ',') FROM j WHERE len(ak) > 0 AND len(bk) > 0 AND ak <> bk)
SELECT *, substr(sha1('qa|' || type || '|' || details), 1, 16) AS flag_id FROM f""",
    "page_match_candidates": f"WITH {CAND} SELECT * FROM c WHERE score >= 0.25",
    "page_match_fallback": f"""WITH {CAND}, best AS (SELECT doc, page, l, r, row_number() OVER (PARTITION BY doc, page, l ORDER BY score DESC, r) AS k FROM c WHERE score >= 0.9), sole AS (SELECT doc, page, count(*) AS n, min(ord) AS one FROM p GROUP BY doc, page)
SELECT g.doc, g.page, g.ord AS l, coalesce(b.r, CASE WHEN o.n = 1 THEN o.one END) AS r FROM g LEFT JOIN best b ON b.doc = g.doc AND b.page = g.page AND b.l = g.ord AND b.k = 1 LEFT JOIN sole o ON o.doc = g.doc AND o.page = g.page""",
    "facts_table": f"""WITH {FACTS} SELECT substr(sha1(doc_id || '::' || table_id || '::' || row_index || '::' || col_index || '::' || value_raw), 1, 16) AS record_id, doc_id, material AS material_name_raw, lower(prop) AS property_name_normalized, value_raw, num AS value_numeric, lower(unit) AS unit_normalized,
  (least(65 + CASE WHEN num IS NOT NULL THEN 20 ELSE 0 END + CASE WHEN unit <> '' THEN 10 ELSE 0 END, 99) / 100)::double AS confidence, row_index::int AS row_index, col_index::int AS col_index, 0 AS errors FROM f""",
    "facts_figures": f"""WITH {FACTS}, {V_PAGE}, u AS (SELECT 'table' AS m, 'table_v1' AS e, doc_id, 65 + CASE WHEN num IS NOT NULL THEN 20 ELSE 0 END + CASE WHEN unit <> '' THEN 10 ELSE 0 END AS c FROM f UNION ALL SELECT 'figure', 'figure_v1', doc::varchar, 30 FROM v_page, range(2))
SELECT m AS method_context, e AS extraction_stage, count(*) AS n, count(DISTINCT doc_id) AS docs, sum(c)::bigint AS sure FROM u GROUP BY ALL""",
    "facts_summary": f"""WITH {FACTS} SELECT lower(prop) AS property_name_normalized, lower(unit) AS unit_normalized, count(*) AS facts, count(num) AS numeric_facts, count(DISTINCT doc_id) AS docs, sum(num)::decimal(38,2) AS total, min(num) AS low, max(num) AS high FROM f GROUP BY ALL""",
    "markdown_figures": f"""WITH {V_PAGE} SELECT doc, page, printf('p%04d_f01', page) AS figure_id, 'plot ' || source AS alt_text, 'img/fig_' || page || '.png?x#y' AS image_ref FROM v_page UNION ALL SELECT doc, page, printf('p%04d_f02', page), '', 'a.jpg' FROM v_page""",
    "figure_assets": f"""WITH {V_PAGE}, files AS (SELECT doc, page, 'img/fig_' || page || '.png' AS path FROM v_page WHERE page % 2 = 0 UNION ALL SELECT doc, page, 'z/a.jpg' FROM v_page WHERE page % 5 = 0 UNION ALL SELECT doc, page + 1, 'y/fig_' || page || '.png' FROM v_page WHERE page % 3 = 0),
g AS (SELECT doc, page, printf('p%04d_f01', page) AS figure_id, 'img/fig_' || page || '.png' AS ref FROM v_page UNION ALL SELECT doc, page, printf('p%04d_f02', page), 'a.jpg' FROM v_page),
j AS (SELECT g.*, f.path, row_number() OVER (PARTITION BY g.doc, g.page, figure_id ORDER BY CASE WHEN f.page = g.page AND f.path = ref THEN 0 WHEN f.page = g.page THEN 1 ELSE 2 END, f.path) AS r FROM g LEFT JOIN files f ON f.doc = g.doc AND string_split(f.path, '/')[-1] = string_split(ref, '/')[-1])
SELECT doc, page, figure_id, path AS resolved_path, path IS NOT NULL AS resolved FROM j WHERE r = 1""",
    "html_grid_round_trip": f"WITH {V_GRID} SELECT table_id, array_to_string(headers, '|') AS headers, array_to_string(list_transform(rows, lambda r: array_to_string(list_resize(r, 4, ''), '|')), chr(10)) AS rows FROM v_grid",
    "markdown_table_round_trip": f"WITH {V_GRID} SELECT table_id, 'Table 1: data' AS caption, 5 AS start_line, array_to_string(headers, '|') AS headers, array_to_string(list_transform(rows, lambda r: array_to_string(list_resize(r, 4, ''), '|')), chr(10)) AS rows FROM v_grid",
    "block_tree_tables": f"WITH {V_FRAGMENT} SELECT doc, count(*) AS tables, count(*) AS captioned, max(page) AS last_page, sum(frag)::bigint AS cell_sum, count(*) AS groups FROM v_fragment GROUP BY doc",
    "html_evidence": f"WITH {V_ROW} SELECT table_id, idx, 'Head | R;' || cells[1] || ' | ' || cells[2] AS lines, 'r0: c0-c1 Head' AS joins FROM v_row",
    "grid_from_spans": f"""WITH {V_ROW}, c AS (SELECT table_id, idx, unnest(range(idx % 4, idx % 4 + idx % 2 + 1))::int AS "row", cells[2] AS text FROM v_row), d AS (SELECT *, unnest(range(idx % 3, idx % 3 + 2))::int AS col FROM c)
SELECT table_id, "row", col, text FROM (SELECT *, row_number() OVER (PARTITION BY table_id, "row", col ORDER BY length(text) DESC, idx) AS k FROM d) WHERE k = 1""",
    "source_fallback": f"""WITH {V_GRID}, c AS (SELECT table_id % 97 AS doc, table_id, s.source, s.rank, CASE WHEN (table_id + s.rank) % 3 = 0 THEN [] ELSE rows END AS r, CASE WHEN (table_id + s.rank) % 5 = 0 THEN ['X', 'X', 'X', 'X'] WHEN (table_id + s.rank) % 7 = 0 THEN ['a', '', '', ''] ELSE headers END AS h FROM v_grid, (VALUES ('layout', 0), ('ocr', 1), ('markdown', 2)) s(source, rank)),
d AS (SELECT *, {CAT} AS reason FROM c) SELECT doc, table_id, arg_min(source, rank) FILTER (reason = '') AS source, coalesce(string_agg(source || ':' || reason, ',' ORDER BY rank) FILTER (reason <> ''), '') AS failed FROM d GROUP BY doc, table_id""",
    "export_status": f"""WITH {V_FRAGMENT}, f AS (SELECT doc, count(*) AS tables, count(*) FILTER (frag % 9 = 0 AND frag % 27 = 0) AS errors, count(*) FILTER (frag % 9 = 0 AND frag % 27 <> 0 AND frag % 2 <> 0) AS warnings FROM v_fragment GROUP BY doc)
SELECT *, CASE WHEN errors > 0 THEN 'error' WHEN warnings > 0 THEN 'warnings' ELSE 'ok' END AS status FROM f""",
    "flag_upsert": f"""WITH {V_FRAGMENT}, a AS (SELECT (frag % 500)::varchar AS flag_id, min(frag) AS ord FROM v_fragment WHERE frag <= 700 AND frag % 3 = 0 GROUP BY 1), b AS (SELECT (frag % 500)::varchar AS flag_id, min(frag) AS ord FROM v_fragment WHERE frag > 700 GROUP BY 1)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE flag_id NOT IN (SELECT flag_id FROM a)""",
}
