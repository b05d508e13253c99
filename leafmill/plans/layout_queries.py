"""Queries over geometry, JSON, listings, incremental work and set operations, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as O
from ..functions import text as T
from ..operators import audit as A
from ..operators import incremental as I
from ..operators import structure as U
from ..operators import tables as B
from .views import V_FRAGMENT, V_PAGE, V_ROW, table, v_fragment, v_page, v_row


def _boxes(spark, sf):
    """orders as boxes on pages of 600 x 800 points."""
    f = v_fragment(spark, sf)
    k = F.col("frag")
    return f.select("doc", "page", "frag", (k % 500).cast("double").alias("x"), (k * 7 % 700).cast("double").alias("y"), (k % 90 + 1).cast("double").alias("w"), (k % 70 + 1).cast("double").alias("h"))


BOXES = "bx AS (SELECT doc, page, frag, (frag % 500)::double AS x, (frag * 7 % 700)::double AS y, (frag % 90 + 1)::double AS w, (frag % 70 + 1)::double AS h FROM v_fragment)"


def polygon_bbox(spark, sf):
    b = _boxes(spark, sf)
    point = lambda x, y: F.array(x, y)
    poly = F.array(F.array(point(F.col("x"), F.col("y")), point(F.col("x") + F.col("w"), F.col("y"))), F.when(F.col("frag") % 3 == 0, F.array(F.array(F.lit(1.0)))).otherwise(F.array(point(F.col("x"), F.col("y") + F.col("h")))))
    return b.select("frag", F.posexplode(O.bbox(F.when(F.col("frag") % 10 == 0, F.array().cast("array<array<array<double>>>")).otherwise(poly))).alias("i", "v"))


def affine_px(spark, sf):
    b = _boxes(spark, sf)
    c = O.render_contract(F.lit(612.0), F.lit(792.0), F.lit(1275), F.lit(1650), F.col("page") * 90)
    d = b.withColumn("c", c).withColumn("p", O.box_to_px(F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.col("c.pdf_to_px")))
    size = O.render_size(F.col("w") * 10, F.col("h") * 10, F.col("page") % 2 == 0)
    return d.withColumn("s", size).select("frag", F.col("c.rotation").alias("rotation"), "p.x0", "p.y0", "p.x1", "p.y1", F.col("s.w").alias("rw"), F.col("s.h").alias("rh"))


def bbox_pixels(spark, sf):
    b = _boxes(spark, sf)
    k = F.col("frag")
    box = F.when(k % 2 == 0, F.array(F.col("x") / 512, F.lit(0.0), (F.col("x") + F.col("w")) / 512, F.lit(0.5))).otherwise(F.array(F.col("x") + 2, F.col("y") + 2, F.col("x") + F.col("w") + 2, F.col("y")))
    px = O.bbox_pixels(box, F.lit(400), F.lit(200))
    return b.select("frag", px.alias("p")).where("p IS NOT NULL").select("frag", F.col("p")[0].alias("x0"), F.col("p")[1].alias("y0"), F.col("p")[2].alias("x1"), F.col("p")[3].alias("y1"), O.pad_box(F.col("p"), 0.1, F.lit(400), F.lit(200))[0].alias("padded_x0"))


def cell_boxes(spark, sf):
    b = _boxes(spark, sf)
    rows = F.array(*[F.array(F.lit(0.0), F.lit(10.0 * i), F.lit(100.0), F.lit(10.0 * i + 10)) for i in range(4)])
    cols = F.array(*[F.array(F.lit(25.0 * i), F.lit(0.0), F.lit(25.0 * i + 25), F.lit(40.0)) for i in range(4)])
    r0, c0 = (F.col("frag") % 4).cast("int"), (F.col("frag") % 3).cast("int")
    box = O.cell_box(rows, cols, r0, r0 + (F.col("frag") % 2).cast("int"), c0, c0 + 1)
    return b.select("frag", F.array_join(F.transform(box, lambda x: x.cast("int").cast("string")), ",").alias("box"))


def text_anchors(spark, sf):
    return U.anchors(_boxes(spark, sf).withColumn("text", F.concat(F.lit(" a "), F.col("frag").cast("string"), F.lit("  b"))), F.lit(600.0), F.lit(800.0)).select("frag", "text", "x0", "y0", "x1", "y1")


def coordinate_strings(spark, sf):
    b = _boxes(spark, sf)
    num = lambda c: F.col(c).cast("int").cast("string")
    raw = F.concat_ws(";", F.concat_ws(",", num("page"), num("x"), num("y"), num("w"), num("h")), F.lit("2,a,1,1,1"), F.lit("3,1,2"), F.concat_ws(",", F.lit("4"), num("x"), F.lit("0"), F.lit("1.5"), F.lit("2")))
    return b.select("frag", F.posexplode(U.coordinates(raw)).alias("i", "c")).select("frag", "i", "c.page", "c.x", "c.y", "c.w", "c.h")


def structure_payload(spark, sf):
    b = _boxes(spark, sf)
    k = F.col("frag")
    cells = F.concat(F.lit('[{"row": '), (k % 3).cast("string"), F.lit(', "col": 0, "row_end": '), (k % 3 + 1).cast("string"), F.lit('}, {"row_start": 5, "col_start": '), (k % 4).cast("string"), F.lit(', "col_end": 1}]'))
    body = F.when(k % 2 == 0, F.concat(F.lit('{"structure": {"cells": '), cells, F.lit("}}"))).otherwise(F.concat(F.lit('{"row_count": 9, "num_cols": 7, "header_rows": 2, "cells": '), cells, F.lit("}")))
    d = b.select("frag", U.structure(F.when(k % 10 == 9, "[broken").otherwise(body)).alias("s"))
    return d.select("frag", "s.rows", "s.cols", "s.header_rows", F.size("s.cells").alias("cells"), F.size(U.joined_cells(F.col("s.cells"))).alias("joined"))


def json_lenient(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id") % 5
    line = F.when(k == 1, "[1, 2]").when(k == 2, F.concat("props", F.lit("}x"))).when(k == 3, " ").otherwise(F.col("props"))
    return U.json_objects(e.select("event_id", line.alias("line")), "line").select("event_id")


def json_salvage(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id") % 5
    body = F.concat(F.lit('{"v": '), F.col("event_id").cast("string"), F.lit("}"))
    raw = F.when(k == 0, body).when(k == 1, F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```\nbye"))).when(k == 2, F.concat(F.lit("x "), body, F.lit(" y"))).when(k == 3, "none").otherwise(F.concat(F.lit("{"), body))
    return e.select("event_id", F.get_json_object(T.salvage_json(raw), "$.v").cast("long").alias("v"))


def scalar_or_list(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id") % 3
    raw = F.when(k == 0, '["a", "b"]').when(k == 1, '"c"').otherwise("null")
    return e.select("event_id", F.array_join(U.as_list(raw), "|").alias("items"))


def content_ids(spark, sf):
    d = table(spark, sf, "documents")
    sha = F.sha2(F.col("text").cast("binary"), 256)
    return d.select("doc_id", sha.alias("sha256"), F.substring(sha, 1, 12).alias("short_id"), T.safe_name(F.concat(F.lit("__ "), F.substring(F.regexp_replace("text", r"[^\x20-\x7e]", "?"), 1, 12), F.lit("!!")), F.lit("root")).alias("name"), T.slug(F.concat_ws(" - ", "source", "lang")).alias("slug"))


def portable_paths(spark, sf):
    return table(spark, sf, "documents").select("doc_id", U.portable(F.concat(F.lit("/data/x/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")), "/data/x").alias("path"))


def rerun_skip(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    done = d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit("old")).otherwise(F.col("sha256")).alias("sha256")).where("doc_id % 2 = 0")
    return I.pending(d, done, ["doc_id", "sha256"]).select("doc_id")


def problem_docs(spark, sf):
    d = table(spark, sf, "documents")
    status = F.when(F.col("doc_id") % 4 == 0, " OK ").when(F.col("doc_id") % 4 == 1, "warnings").when(F.col("doc_id") % 4 == 2, "error")
    return d.select("doc_id", status.alias("status")).where(I.is_problem(F.col("status"))).select("doc_id")


def manifest_upsert(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("model"), F.lit("v1").alias("stage"))
    new = d.where("doc_id % 3 = 0").select("doc_id", F.lit("v2").alias("stage")).unionByName(spark.range(3).select((F.col("id") - 10).alias("doc_id"), F.lit("v9").alias("stage")))
    return I.upsert(d, new, "doc_id")


def artifact_status(spark, sf):
    f = v_fragment(spark, sf).select("doc", F.col("frag").alias("table_id"))
    return I.artifact_counts(f, f.where("table_id % 3 = 0"), f.where("table_id % 5 <> 0"), f.where("table_id % 7 = 0"))


def layout_audit(spark, sf):
    return A.audit(_listing(spark, sf))


def layout_report(spark, sf):
    l = _listing(spark, sf)
    return A.report(A.audit(l), l)


def _listing(spark, sf):
    """A folder listing made of documents' ids: corpora and jobs, some of them amiss."""
    d = table(spark, sf, "documents").select("doc_id", (F.col("doc_id") % 40).cast("string").alias("g"), F.col("doc_id").cast("string").alias("n"))
    slug = F.when(F.col("doc_id") % 40 == 7, "Bad Name").otherwise(F.concat(F.lit("set_"), "g"))
    top = F.when(F.col("doc_id") % 3 == 0, "corpora").otherwise("jobs")
    sub = F.get(F.array(*map(F.lit, ("source_pdfs", "pdfs", "reports", "input", "ocr_out", "odd"))), (F.col("doc_id") % 6).cast("int"))
    home = F.concat_ws("/", top, slug)
    dirs = d.select(F.explode(F.array(top, home, F.concat_ws("/", home, sub))).alias("path")).distinct().withColumn("is_dir", F.lit(True))
    files = d.select(F.when(F.col("doc_id") % 50 == 0, F.concat("n", F.lit(".PDF"))).when(F.col("doc_id") % 50 == 1, F.concat(home, F.lit("/x"), "n", F.lit(".txt"))).otherwise(F.concat(home, F.lit("/"), sub, F.lit("/"), "n", F.lit(".pdf"))).alias("path"), F.lit(False).alias("is_dir"))
    return dirs.unionByName(files)


def page_sets(spark, sf):
    r = v_row(spark, sf).select("table_id", "page", F.get("cells", F.lit(0)).alias("part"))
    a, b = r.where("table_id % 2 = 0").select("part"), r.where("table_id % 2 = 1").select("part")
    return a.intersect(b).withColumn("kind", F.lit("both")).unionByName(a.subtract(b).withColumn("kind", F.lit("only_even"))).groupBy("kind").agg(F.count("*").alias("n"), F.min("part").alias("first"))


def ordered_distinct(spark, sf):
    p = v_page(spark, sf).withColumn("w", F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{2,})"), F.lit(1)))
    return p.select("doc", "page", F.size(F.array_distinct("w")).alias("n"), F.md5(F.array_join(F.array_distinct("w"), " ")).alias("words_md5"))


def grid_fit(spark, sf):
    from ..functions import grid as G

    r = v_row(spark, sf)
    return r.select("table_id", "idx", F.array_join(G.fit(F.col("cells"), (F.col("idx") % 6).cast("int")), "|").alias("cells"))


def long_cells(spark, sf):
    r = v_row(spark, sf).select("table_id", F.array("cells").alias("rows"))
    return B.cells_of(r, "table_id").groupBy("table_id").agg(F.count("*").alias("cells"), F.count_if(F.col("text") == "").alias("blanks"), F.max("col").alias("last_col"))


QUERIES = {f.__name__: f for f in (polygon_bbox, affine_px, bbox_pixels, cell_boxes, text_anchors, coordinate_strings, structure_payload, json_lenient, json_salvage, scalar_or_list, content_ids, portable_paths, rerun_skip, problem_docs, manifest_upsert, artifact_status, layout_audit, layout_report, page_sets, ordered_distinct, grid_fit, long_cells)}

LIST = """d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'corpora' ELSE 'jobs' END AS top, CASE WHEN doc_id % 40 = 7 THEN 'Bad Name' ELSE 'set_' || doc_id % 40 END AS slug, list_extract(['source_pdfs', 'pdfs', 'reports', 'input', 'ocr_out', 'odd'], (doc_id % 6)::int + 1) AS sub FROM documents),
dirs AS (SELECT DISTINCT unnest([top, top || '/' || slug, top || '/' || slug || '/' || sub]) AS path FROM d),
files AS (SELECT CASE WHEN doc_id % 50 = 0 THEN doc_id || '.PDF' WHEN doc_id % 50 = 1 THEN top || '/' || slug || '/x' || doc_id || '.txt' ELSE top || '/' || slug || '/' || sub || '/' || doc_id || '.pdf' END AS path FROM d),
dd AS (SELECT path, string_split(path, '/') AS s FROM dirs), ff AS (SELECT path, string_split(path, '/') AS s FROM files), pf AS (SELECT * FROM ff WHERE lower(path) LIKE '%.pdf'),
issues AS (SELECT 'unexpected_top_level_file' AS code, path, 'error' AS severity FROM ff WHERE len(s) = 1
  UNION ALL SELECT 'missing_top_level_dir', t, 'warning' FROM (VALUES ('archive'), ('cache'), ('corpora'), ('jobs'), ('tmp')) v(t) WHERE t NOT IN (SELECT path FROM dd)
  UNION ALL SELECT 'invalid_slug', path, 'error' FROM dd WHERE len(s) = 2 AND s[2] = 'Bad Name'
  UNION ALL SELECT 'missing_source_pdfs_dir', path, 'error' FROM dd WHERE len(s) = 2 AND s[1] = 'corpora' AND path || '/source_pdfs' NOT IN (SELECT path FROM dd)
  UNION ALL SELECT 'unexpected_corpus_subdir', path, 'warning' FROM dd WHERE len(s) = 3 AND s[1] = 'corpora' AND s[3] NOT IN ('source_pdfs', 'metadata', 'notes')
  UNION ALL SELECT 'missing_job_subdir', path, 'error' FROM dd, (VALUES ('pdfs'), ('reports')) n(need) WHERE len(s) = 2 AND s[1] = 'jobs' AND path || '/' || need NOT IN (SELECT path FROM dd)
  UNION ALL SELECT 'unexpected_job_subdir', path, 'warning' FROM dd WHERE len(s) = 3 AND s[1] = 'jobs' AND s[3] NOT IN ('input', 'pdfs', 'reports', 'ocr_out', 'logs')
  UNION ALL SELECT 'unexpected_job_file', path, 'warning' FROM ff WHERE len(s) = 3 AND s[1] = 'jobs'
  UNION ALL SELECT 'deprecated_job_subdir', path, 'warning' FROM dd WHERE len(s) = 3 AND s[1] = 'jobs' AND s[3] IN ('input', 'ocr_out')
  UNION ALL SELECT 'misplaced_pdf', path, 'error' FROM pf WHERE len(s) < 2 OR (s[1] = 'corpora' AND s[3] <> 'source_pdfs') OR (s[1] = 'jobs' AND s[3] NOT IN ('pdfs', 'ocr_out'))
  UNION ALL SELECT 'deprecated_job_ocr_out_pdf', path, 'warning' FROM pf WHERE len(s) >= 4 AND s[1] = 'jobs' AND s[3] = 'ocr_out')"""
SQL = {
    "polygon_bbox": f"""WITH {V_FRAGMENT}, {BOXES}, a AS (SELECT frag, CASE WHEN frag % 10 = 0 THEN [0, 0, 0, 0] WHEN frag % 3 = 0 THEN [x, y, x + w, y] ELSE [x, y, x + w, y + h] END AS b FROM bx) SELECT frag, (generate_subscripts(b, 1) - 1)::int AS i, unnest(b)::double AS v FROM a""",
    "affine_px": f"""WITH {V_FRAGMENT}, {BOXES}, a AS (SELECT *, 1275 / 612.0::double AS sx, 1650 / 792.0::double AS sy, CASE WHEN page % 2 = 0 THEN 200.0 ELSE 300.0 END::double AS dpi FROM bx), b AS (SELECT *, w * 10 / 72 * dpi AS pw, h * 10 / 72 * dpi AS ph FROM a)
SELECT frag, page * 90 % 360 AS rotation, sx * x AS x0, sy * y AS y0, sx * (x + w) AS x1, sy * (y + h) AS y1, floor(pw * least(1, 1288 / greatest(pw, ph)))::int AS rw, floor(ph * least(1, 1288 / greatest(pw, ph)))::int AS rh FROM b""",
    "bbox_pixels": f"""WITH {V_FRAGMENT}, {BOXES}, a AS (SELECT frag, CASE WHEN frag % 2 = 0 THEN [x / 512 * 400, 0, (x + w) / 512 * 400, 100] ELSE [x + 2, y, x + w + 2, y + 2] END AS b FROM bx),
c AS (SELECT frag, greatest(0, least(400, floor(b[1])))::int AS x0, greatest(0, least(200, floor(b[2])))::int AS y0, greatest(0, least(400, ceil(b[3])))::int AS x1, greatest(0, least(200, ceil(b[4])))::int AS y1 FROM a)
SELECT *, greatest(0, x0 - ceil((x1 - x0) * 0.1::double)::int) AS padded_x0 FROM c WHERE x1 > x0 AND y1 > y0""",
    "cell_boxes": f"""WITH {V_FRAGMENT}, a AS (SELECT frag, frag % 4 AS r, frag % 4 + frag % 2 AS s, frag % 3 AS c FROM v_fragment) SELECT frag, CASE WHEN s < 4 THEN (25 * c) || ',' || (10 * r) || ',' || (25 * c + 50) || ',' || (10 * s + 10) END AS box FROM a""",
    "text_anchors": f"WITH {V_FRAGMENT}, {BOXES} SELECT frag, 'a ' || frag || ' b' AS text, x / 600 AS x0, y / 800 AS y0, (x + w) / 600 AS x1, (y + h) / 800 AS y1 FROM bx",
    "coordinate_strings": f"""WITH {V_FRAGMENT}, {BOXES} SELECT frag, 0 AS i, page, x, y, w, h FROM bx UNION ALL SELECT frag, 1, 4, x, 0, 1.5, 2 FROM bx""",
    "structure_payload": f"""WITH {V_FRAGMENT} SELECT frag, CASE WHEN frag % 10 = 9 THEN 0 WHEN frag % 2 = 0 THEN 6 ELSE 9 END AS rows, CASE WHEN frag % 10 = 9 THEN 0 WHEN frag % 2 = 0 THEN greatest(frag % 4, 1) + 1 ELSE 7 END::int AS cols, CASE WHEN frag % 10 = 9 THEN 0 WHEN frag % 2 = 0 THEN 0 ELSE 2 END AS header_rows, CASE WHEN frag % 10 = 9 THEN 0 ELSE 2 END AS cells, CASE WHEN frag % 10 = 9 THEN 0 WHEN frag % 4 = 1 THEN 1 ELSE 2 END AS joined FROM v_fragment""",
    "json_lenient": "SELECT event_id FROM events WHERE event_id % 5 IN (0, 4)",
    "json_salvage": "SELECT event_id, CASE WHEN event_id % 5 < 3 THEN event_id END AS v FROM events",
    "scalar_or_list": "SELECT event_id, list_extract(['a|b', 'c', ''], (event_id % 3)::int + 1) AS items FROM events",
    "content_ids": r"""SELECT doc_id, sha256(text) AS sha256, substr(sha256(text), 1, 12) AS short_id, coalesce(nullif(regexp_replace(regexp_replace('__ ' || substr(regexp_replace(text, '[^\x20-\x7e]', '?', 'g'), 1, 12) || '!!', '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'root') AS name, source || '_' || lang AS slug FROM documents""",
    "portable_paths": "SELECT doc_id, source || '/' || doc_id AS path FROM documents",
    "rerun_skip": "SELECT doc_id FROM documents WHERE NOT (doc_id % 2 = 0 AND doc_id % 3 <> 0)",
    "problem_docs": "SELECT doc_id FROM documents WHERE doc_id % 4 <> 0",
    "manifest_upsert": "SELECT doc_id, lang AS model, CASE WHEN doc_id % 3 = 0 THEN 'v2' ELSE 'v1' END AS stage FROM documents UNION ALL SELECT i - 10, NULL, 'v9' FROM range(3) t(i)",
    "artifact_status": f"""WITH {V_FRAGMENT} SELECT CASE WHEN frag % 3 = 0 THEN 'skipped' WHEN frag % 5 = 0 THEN 'missing_crop' WHEN frag % 7 = 0 THEN 'failed' ELSE 'generated' END AS status, count(*) AS n FROM v_fragment GROUP BY 1""",
    "layout_audit": f"WITH {LIST} SELECT * FROM issues",
    "layout_report": f"WITH {LIST} SELECT count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity <> 'error') AS warnings, (SELECT count(*) FROM pf) AS pdfs FROM issues",
    "page_sets": f"""WITH {V_ROW}, a AS (SELECT DISTINCT cells[1] AS part FROM v_row WHERE table_id % 2 = 0), b AS (SELECT DISTINCT cells[1] AS part FROM v_row WHERE table_id % 2 = 1) SELECT CASE WHEN part IN (SELECT part FROM b) THEN 'both' ELSE 'only_even' END AS kind, count(*) AS n, min(part) AS first FROM a GROUP BY 1""",
    "ordered_distinct": f"""WITH {V_PAGE}, a AS (SELECT doc, page, unnest(f) AS w, generate_subscripts(f, 1) AS i FROM (SELECT doc, page, regexp_extract_all(lower(text), '[a-z]{{2,}}') AS f FROM v_page)), b AS (SELECT doc, page, w, min(i) AS i FROM a GROUP BY ALL), c AS (SELECT doc, page, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS ws FROM b GROUP BY ALL)
SELECT doc, page, coalesce(n, 0)::int AS n, md5(coalesce(ws, '')) AS words_md5 FROM v_page LEFT JOIN c USING (doc, page)""",
    "grid_fit": f"WITH {V_ROW} SELECT table_id, idx, coalesce(array_to_string(list_resize(cells, idx % 6, ''), '|'), '') AS cells FROM v_row",
    "long_cells": f"WITH {V_ROW}, a AS (SELECT table_id, unnest(cells) AS c, generate_subscripts(cells, 1) - 1 AS i FROM v_row) SELECT table_id, count(*) AS cells, count(*) FILTER (c = '') AS blanks, max(i)::int AS last_col FROM a GROUP BY table_id",
}
