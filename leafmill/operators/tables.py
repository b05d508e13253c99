"""Tables: fragments, chains, merged rows and lineage, continuations, captions, grids from spans, quality, export status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import grid as G
from ..functions import parse
from ..functions import text as T


def chains(fragments: DataFrame, similar: float = 0.75) -> DataFrame:
    """fragments (doc, page, frag, caption, tokens[, group]) with number, chain and group_key.

    A named group is one table. Otherwise fragments of one table number chain while the page moves by at most one and one
    of the two captions says it continues or the headers are alike; only the previous fragment counts, so a lag and a
    running sum of breaks give the chains. Fragments without a number stand alone.
    """
    d = fragments if "group" in fragments.columns else fragments.withColumn("group", F.lit(None).cast("string"))
    d = d.withColumn("number", T.table_number(F.col("caption")))
    chained = F.col("group").isNull() & (F.col("number") != "")
    lone = F.when(chained, F.lit("")).otherwise(F.coalesce("group", F.col("frag").cast("string")))
    w = Window.partitionBy("doc", "number", lone).orderBy("page", "frag")
    prev = lambda c: F.lag(c).over(w)
    gap = F.col("page") - prev("page")
    joins = gap.between(0, 1) & (T.continued(F.col("caption")) | T.continued(prev("caption")) | (T.jaccard(F.array_distinct("tokens"), F.array_distinct(prev("tokens"))) >= similar))
    breaks = F.when(chained & ~F.coalesce(joins, F.lit(False)), 1).otherwise(0)
    d = d.withColumn("_break", breaks).withColumn("chain", F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_break")
    key = F.when(F.col("group").isNotNull(), F.concat(F.lit("group:"), "group")).when(F.col("number") == "", F.concat(F.lit("fragment:"), F.col("frag").cast("string"))).otherwise(F.concat_ws(":", F.lit("number"), "number", F.col("chain").cast("string")))
    return d.withColumn("group_key", key)


def merged_rows(rows: DataFrame, table: list[str]) -> DataFrame:
    """rows (table.., page, frag, idx, cells): a row equal to the one kept before it goes; row_index counts what stays.

    A run of equal rows keeps its first, which is the same as comparing with the previous row.
    """
    w = Window.partitionBy(*table).orderBy("page", "frag", "idx")
    d = rows.withColumn("_prev", F.lag(F.struct("cells")).over(w)).where(F.col("_prev").isNull() | ~F.col("cells").eqNullSafe(F.col("_prev.cells"))).drop("_prev")
    return d.withColumn("row_index", (F.row_number().over(w) - 1).cast("int")).withColumn("source_kind", F.lit("data_row"))


def continuation_pairs(tables: DataFrame) -> DataFrame:
    """tables (doc, table_id, page_min, page_max, caption, empty_body, next usable) -> (doc, first, second) merged over a page break.

    A pair is eligible by its two neighbours alone; pairs don't overlap, so within a run of eligible starts the odd ones
    are taken.
    """
    w = Window.partitionBy("doc").orderBy("page_min", "table_id")
    nxt = lambda c: F.lead(c).over(w)
    d = tables.withColumn("n1", T.table_number(F.col("caption"))).withColumn("pos", F.row_number().over(w))
    d = d.withColumn("second", nxt("table_id")).withColumn("n2", nxt("n1")).withColumn("cap2", F.trim(nxt("caption"))).withColumn("page2", nxt("page_min")).withColumn("empty2", nxt("empty_body"))
    fits = (F.col("page2") - F.col("page_max") == 1) & F.col("empty_body") & ~F.col("empty2") & (F.col("n1") != "") & ((F.col("n2") == "") | (F.col("n2") == F.col("n1"))) & ~F.lower("cap2").startswith("table ")
    d = d.where(F.coalesce(fits, F.lit(False)))
    d = d.withColumn("run", F.col("pos") - F.row_number().over(w))
    d = d.withColumn("in_run", F.row_number().over(Window.partitionBy("doc", "run").orderBy("pos")))
    return d.where("in_run % 2 = 1").select("doc", F.col("table_id").alias("first"), "second")


def bind_captions(tables: DataFrame, captions: DataFrame) -> DataFrame:
    """Per table (doc, page, table_id, number, y) its caption (doc, page, cap_id, cap_number, cap_y): same number first, then nearest, below costs 1000."""
    j = tables.join(captions, ["doc", "page"], "left")
    same = F.when((F.col("number") != "") & (F.col("number") == F.col("cap_number")), 1).otherwise(0)
    far = F.abs(F.col("y") - F.col("cap_y"))
    score = F.coalesce(far + F.when(F.col("cap_y") <= F.col("y"), 0.0).otherwise(1000.0), F.lit(999999.0))
    best = F.min_by(F.struct("cap_id", score.alias("score")), F.struct(-same, score, F.coalesce(far, F.lit(999999.0)), "cap_id"))
    return j.groupBy("doc", "page", "table_id").agg(best.alias("b")).select("doc", "page", "table_id", "b.cap_id", F.when(F.col("b.cap_id").isNotNull(), 0.95).otherwise(0.6).alias("caption_confidence"))


def raw_tables(blocks: DataFrame) -> DataFrame:
    """Layout blocks (doc, id, block_type, page, bbox, polygon, html) -> raw table rows with captions, grids and page ordinals."""
    b = blocks.where("page IS NOT NULL").withColumn("kind", F.lower("block_type")).withColumn("plain", T.plain_text(F.col("html"))).withColumn("y", F.get("bbox", F.lit(1)))
    t = b.where("kind = 'table'").withColumn("idx", F.row_number().over(Window.partitionBy("doc", "page").orderBy("id")))
    t = t.select("doc", "page", F.col("id").alias("table_id"), T.table_number(F.col("plain")).alias("number"), F.coalesce("y", F.lit(0.0)).alias("y"), "idx", "html", "bbox", "polygon", "plain")
    c = b.where("kind = 'caption'").select("doc", "page", F.col("id").alias("cap_id"), T.table_number(F.col("plain")).alias("cap_number"), F.col("y").alias("cap_y"), F.col("plain").alias("cap_text"))
    bound = bind_captions(t.select("doc", "page", "table_id", "number", "y"), c.drop("cap_text"))
    j = t.join(bound, ["doc", "page", "table_id"]).join(c.select("doc", "page", "cap_id", "cap_text"), ["doc", "page", "cap_id"], "left")
    text = F.coalesce(F.nullif(F.col("cap_text"), F.lit("")), T.plain_text(F.substring("html", 1, 220)))
    return j.withColumn("grid", parse.html_grid("html")).select("doc", "page", F.format_string("page_%04d_table_%02d", "page", "idx").alias("table_group_id"), "table_id", "cap_id", text.alias("caption_text"), "caption_confidence", "grid.header_rows", "grid.data_rows", "bbox", "polygon")


def fragments_of(raw: DataFrame) -> DataFrame:
    """Raw table rows as typed fragments; ids hash one canonical text of what places the fragment."""
    where = F.concat_ws(",", F.transform(F.coalesce("bbox", F.array().cast("array<double>")), lambda x: x.cast("decimal(18,3)").cast("string")))
    return raw.select("doc", "page", T.stable_id(F.col("doc"), F.col("page"), F.col("table_group_id"), where, sep="|").alias("frag"), F.nullif(F.col("table_group_id"), F.lit("")).alias("group"), F.col("caption_text").alias("caption"), F.array_distinct(F.flatten(F.transform(F.coalesce(F.get("header_rows", F.lit(0)), F.array().cast("array<string>")), T.tokens))).alias("tokens"), "header_rows", "data_rows", "caption_confidence")


def complete(rows: DataFrame, table: list[str]) -> DataFrame:
    """rows (table.., idx, cells): blank rows and repeats of a normalised row go, unless nothing would be left; new row_index."""
    sig = F.transform("cells", T.cell_text)
    d = rows.withColumn("sig", sig).withColumn("blank", ~F.exists("sig", lambda x: x != ""))
    d = d.withColumn("rep", F.row_number().over(Window.partitionBy(*table, "sig").orderBy("idx")))
    d = d.withColumn("ok", ~F.col("blank") & (F.col("rep") == 1)).withColumn("any", F.max(F.col("ok").cast("int")).over(Window.partitionBy(*table)))
    d = d.where(F.col("ok") | (F.col("any") == 0))
    w = Window.partitionBy(*table)
    first = F.coalesce(F.get("sig", F.lit(0)), F.lit("")) != ""
    d = d.withColumn("row_index", (F.row_number().over(w.orderBy("idx")) - 1).cast("int"))
    sparse = F.sum(first.cast("int")).over(w) < F.greatest(F.lit(1), F.floor(F.lit(0.6) * F.count("*").over(w)))
    return d.withColumn("sparse_identifier", sparse).drop("sig", "blank", "rep", "ok", "any")


def topology(grids: DataFrame) -> DataFrame:
    """grids (.., headers, rows) with rows of the headers' width: shifted, turned, padded or cut; and the sorted reasons."""
    rows, why = G.unshift(F.col("headers"), F.col("rows"))
    d = grids.withColumn("_why", why).withColumn("rows", rows)
    turned = G.transpose(F.col("headers"), F.col("rows"))
    d = d.withColumn("_turned", turned).withColumn("_th", F.get("_turned", F.lit(0))).withColumn("_tr", F.slice("_turned", 2, 1 << 30))
    numeric = G.share(F.col("headers"), T.numericish) >= 0.75
    gain = G.orientation(F.col("_th"), F.col("_tr")) - G.orientation(F.col("headers"), F.col("rows")) >= 0.35
    turn = (F.size("headers") >= 4) & (F.size("rows") >= 2) & numeric & gain
    d = d.withColumn("_turn", turn).withColumn("headers", F.when(turn, F.col("_th")).otherwise(F.col("headers"))).withColumn("rows", F.when(F.col("_turn"), F.col("_tr")).otherwise(F.col("rows")))
    n, full = F.size("headers"), F.size("headers") > 0
    reasons = F.array(F.nullif(F.col("_why"), F.lit("")), F.when(F.col("_turn"), "transpose_recovery"), F.when(full & F.exists("rows", lambda r: F.size(r) < n), "row_padding"), F.when(full & F.exists("rows", lambda r: F.size(r) > n), "row_trimming"))
    d = d.withColumn("reasons", F.array_sort(F.filter(reasons, lambda x: x.isNotNull())))
    return d.withColumn("rows", F.when(n > 0, F.transform("rows", lambda r: G.fit(r, n))).otherwise(F.col("rows"))).drop("_why", "_turned", "_th", "_tr", "_turn")


def escalation(tables: DataFrame, most: int) -> DataFrame:
    """tables (doc, ord, q): the first `most` failing ones of a document may be extracted again."""
    judged = G.let(F.col("q"), lambda q: F.struct(q.alias("q"), F.coalesce(G.fails_quality(q), F.lit(False)).alias("_first"), G.fails_quality(q).alias("fails")))  # each grid is read once
    d = tables.withColumn("_j", judged).select(*[c for c in tables.columns if c != "q"], "_j.*")
    pick = F.col("_first") & (F.row_number().over(Window.partitionBy("doc", "_first").orderBy("ord")) <= most) & F.col("doc").isNotNull() & F.col("ord").isNotNull()
    return d.withColumn("escalate", pick).drop("_first")


def fallback(candidates: DataFrame) -> DataFrame:
    """candidates (doc, table_id, source, rank, reason): the first source without a reason against it, and what failed before; null: excluded."""
    best = F.min_by(F.when(F.col("reason") == "", F.col("source")), F.when(F.col("reason") == "", F.col("rank")))
    failed = F.transform(F.array_sort(F.collect_list(F.when(F.col("reason") != "", F.struct("rank", "source", "reason")))), lambda x: F.concat(x["source"], F.lit(":"), x["reason"]))
    return candidates.groupBy("doc", "table_id").agg(best.alias("source"), F.array_join(failed, ",").alias("failed"))


def grid_from_spans(cells: DataFrame) -> DataFrame:
    """cells (table_id, ord, r0, r1, c0, c1, text) -> (table_id, row, col, text): every place a span covers, longest text wins, then the first."""
    d = cells.withColumn("row", F.explode(F.sequence("r0", "r1"))).withColumn("col", F.explode(F.sequence("c0", "c1")))
    return d.groupBy("table_id", "row", "col").agg(F.max_by("text", F.struct(F.length("text"), -F.col("ord"))).alias("text"))


def export_status(flags: DataFrame, tables: DataFrame) -> DataFrame:
    """Per document: tables, flags by severity, and ok, warnings or error."""
    f = flags.groupBy("doc").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warn").alias("warnings"))
    d = tables.groupBy("doc").agg(F.count("*").alias("tables")).join(f, "doc", "left").na.fill(0, ["errors", "warnings"])
    return d.withColumn("status", F.when(F.col("errors") > 0, "error").when(F.col("warnings") > 0, "warnings").otherwise("ok"))


def add_flags(flags: DataFrame, new: DataFrame) -> DataFrame:
    """New QA flags whose id isn't there yet; of new ones with one id the first in order."""
    w = Window.partitionBy("flag_id").orderBy("ord")
    fresh = new.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r").join(flags.select("flag_id"), "flag_id", "left_anti")
    return flags.unionByName(fresh)


def figures(pages: DataFrame, text: str = "text") -> DataFrame:
    """Markdown images of each page, numbered."""
    pattern = F.lit(r"!\[([^\]]*)\]\(([^)]+)\)")
    pairs = F.arrays_zip(F.regexp_extract_all(T.blank(F.col(text)), pattern, F.lit(1)).alias("alt"), F.regexp_extract_all(T.blank(F.col(text)), pattern, F.lit(2)).alias("ref"))
    d = pages.select("doc", "page", F.posexplode(pairs).alias("pos", "f"))
    return d.select("doc", "page", F.format_string("p%04d_f%02d", F.col("page"), F.col("pos") + 1).alias("figure_id"), F.trim(F.col("f")["alt"]).alias("alt_text"), F.trim(F.col("f")["ref"]).alias("image_ref"))


def resolve_figures(figs: DataFrame, files: DataFrame) -> DataFrame:
    """Each figure's file (doc, page, path): that path on its page, its name on its page, its name anywhere; the first by name."""
    ref = F.trim(F.regexp_replace("image_ref", r"[#?].*$", ""))
    f = figs.withColumn("ref", ref).withColumn("name", F.element_at(F.split("ref", "/"), -1))
    g = files.select("doc", F.col("page").alias("fpage"), "path", F.element_at(F.split("path", "/"), -1).alias("name"))
    tier = F.when((F.col("fpage") == F.col("page")) & (F.col("path") == F.col("ref")), 0).when(F.col("fpage") == F.col("page"), 1).otherwise(2)
    j = f.join(g, ["doc", "name"], "left").groupBy("doc", "page", "figure_id").agg(F.min_by("path", F.struct(tier, "path")).alias("resolved_path"))
    return j.withColumn("resolved", F.col("resolved_path").isNotNull())


def cells_of(grids: DataFrame, *keys: str) -> DataFrame:
    """Long form (keys, row, col, text)."""
    return grids.select(*keys, F.posexplode("rows").alias("row", "cells")).select(*keys, "row", F.posexplode("cells").alias("col", "text"))


def rows_text(c: Column) -> Column:
    """Grid rows as one string."""
    return F.array_join(F.transform(c, lambda r: F.array_join(r, "|")), "\n")
