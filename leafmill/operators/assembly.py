"""Putting records together: canonical tables, continuations, contexts and evidence for review, summaries, names, payloads, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grid as G
from ..functions import text as T
from .pages import MARKDOWN_HEADING, PLAIN_HEADING, page_texts

# Texts that stand for a missing answer.
PLACEHOLDERS = ("string", "<summary text>", "<topic>", "<section title>", "<section summary>", "...", "…")


#: Carried along where fragments have it: the least of a table's.
CONFIDENCE = ("caption_confidence",)


def in_order(order: list[str], value: Column) -> Column:
    """value of each row of a group, by order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, value.alias("_v")))), lambda x: x["_v"])


def canonical(chained: DataFrame) -> DataFrame:
    """One record a table of chained fragments (doc, group_key, page, frag, caption, header_rows, data_rows).

    The header is the first fragment's, the caption the first that says something; rows follow in order, a row equal to
    the one before it once.
    """
    g = chained.groupBy("doc", "group_key").agg(
        in_order(["page", "frag"], F.col("frag").cast("string")).alias("fragment_ids"), F.array_sort(F.collect_set("page")).alias("pages"), in_order(["page", "frag"], T.blank(F.col("caption"))).alias("_c"),
        F.min_by("header_rows", F.struct("page", "frag")).alias("header_rows"), *[F.min(c).alias(c) for c in CONFIDENCE if c in chained.columns], F.flatten(in_order(["page", "frag"], F.col("data_rows"))).alias("_r"),
    )
    none = F.array().cast("array<array<string>>")
    rows = F.aggregate("_r", none, lambda a, x: F.when((F.size(a) > 0) & F.element_at(F.concat(F.array(F.array(F.lit("\x00"))), a), -1).eqNullSafe(x), a).otherwise(F.concat(a, F.array(x))))
    return g.select(
        "doc", T.stable_id(F.col("group_key"), F.array_join("fragment_ids", ","), sep="|").alias("table_id"), F.col("group_key").alias("table_group_id"), "fragment_ids", "pages",
        F.coalesce(F.get(F.filter("_c", lambda x: x != ""), F.lit(0)), F.lit("")).alias("caption"), "header_rows", rows.alias("data_rows"), F.when(F.size("fragment_ids") > 1, 0.9).otherwise(1.0).alias("merge_confidence"), *[F.col(c) for c in CONFIDENCE if c in chained.columns],
    )


def split_header(row: Column, n: Column) -> Column:
    """A header row short of n cells with its cells of several lines taken apart, then padded."""
    parts = F.flatten(F.transform(row, lambda c: F.when(F.size(F.filter(F.split(c, "\n"), lambda x: F.trim(x) != "")) >= 2, F.transform(F.filter(F.split(c, "\n"), lambda x: F.trim(x) != ""), lambda x: F.trim(x))).otherwise(F.array(c))))
    return G.pad(F.when((F.size(row) < n) & (F.size(parts) <= n), parts).otherwise(row), n)


def merge_continuations(tables: DataFrame, pairs: DataFrame) -> DataFrame:
    """tables (canonical()'s) with each pair (doc, first, second) as one table over both pages, the rest as they are."""
    a = tables.join(pairs.withColumnRenamed("first", "table_id"), ["doc", "table_id"])
    b = tables.select("doc", F.col("table_id").alias("second"), *[F.col(c).alias(f"_{c}") for c in ("fragment_ids", "pages", "caption", "header_rows", "data_rows", *CONFIDENCE) if c in tables.columns])
    j = a.join(b, ["doc", "second"])
    sure = [F.least(c, f"_{c}").alias(c) for c in CONFIDENCE if c in tables.columns]
    wide = lambda c: F.coalesce(F.array_max(F.transform(c, F.size)), F.lit(0))
    lines = lambda r: F.aggregate(F.transform(r, lambda c: F.greatest(F.lit(1), F.size(F.filter(F.split(c, "\n"), lambda x: F.trim(x) != "")))), F.lit(0), lambda s, x: s + x)
    n = F.greatest(wide("_data_rows"), wide("_header_rows"), F.coalesce(F.array_max(F.transform("header_rows", lines)), F.lit(0)))
    heads = F.transform(F.concat("header_rows", "_header_rows"), lambda r: split_header(r, n))
    heads = F.array_distinct(F.filter(heads, lambda r: F.exists(r, lambda x: F.trim(x) != "")))
    merged = j.select(
        "doc", "table_id", "table_group_id", F.array_distinct(F.concat("fragment_ids", "_fragment_ids")).alias("fragment_ids"), F.array_sort(F.array_distinct(F.concat("pages", "_pages"))).alias("pages"),
        F.coalesce(F.nullif(F.trim("caption"), F.lit("")), F.col("_caption")).alias("caption"), heads.alias("header_rows"), F.transform("_data_rows", lambda r: G.pad(r, n)).alias("data_rows"), F.least("merge_confidence", F.lit(0.85)).alias("merge_confidence"), *sure, F.lit(True).alias("cross_page_merged"),
    )
    used = pairs.select("doc", F.explode(F.array("first", "second")).alias("table_id"))
    return merged.unionByName(tables.join(used, ["doc", "table_id"], "left_anti").withColumn("cross_page_merged", F.lit(False)))


def crops(tables: DataFrame, files: DataFrame) -> DataFrame:
    """Each table's crop: of its fragments in order, of its lineage's, else the first on its page. files (doc, name, page, path)."""
    want = F.concat(F.transform("fragment_ids", lambda x, i: F.struct(x.alias("name"), i.alias("rank"))), F.transform("lineage", lambda x, i: F.struct(x.alias("name"), (i + 1000).alias("rank"))))
    t = tables.select("doc", "table_id", "page", want.alias("want"))
    named = t.select("doc", "table_id", F.explode("want").alias("w")).select("doc", "table_id", "w.name", "w.rank").join(files.select("doc", "name", "path"), ["doc", "name"])
    paged = t.select("doc", "table_id", "page").join(files.select("doc", "page", "path"), ["doc", "page"]).select("doc", "table_id", F.lit(1_000_000).alias("rank"), "path")
    best = named.select("doc", "table_id", "rank", "path").unionByName(paged).groupBy("doc", "table_id").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))
    return tables.select("doc", "table_id").join(best, ["doc", "table_id"], "left")


def table_ids(groups: DataFrame, known: DataFrame) -> DataFrame:
    """groups (doc, group, page) with the known table id of each, or one made from what is there."""
    return groups.join(known.select("doc", "group", "table_id"), ["doc", "group"], "left").withColumn("table_id", F.coalesce("table_id", T.stable_id(F.col("doc"), F.col("group"), F.col("page"), sep="|")))


def review_context(tables: DataFrame, fragments: DataFrame, pages: DataFrame, most: int | None = None) -> DataFrame:
    """tables (doc, table_id, fragment_ids, pages) with their fragments' captions and their pages' texts, whole unless `most` is given."""
    f = tables.select("doc", "table_id", F.posexplode("fragment_ids").alias("i", "frag")).join(fragments.select("doc", F.col("frag").cast("string").alias("frag"), "caption"), ["doc", "frag"])
    f = f.groupBy("doc", "table_id").agg(F.count("*").alias("fragments"), F.array_join(in_order(["i"], F.col("caption")), "; ").alias("captions"))
    t = tables.select("doc", "table_id", F.col("pages").alias("at")).join(f, ["doc", "table_id"], "left")
    # the texts come last: nothing deals them out again once there is a copy for each table
    return page_texts(t, pages, "\n", most, "left").select("doc", "table_id", "fragments", "captions", "page_text").na.fill(0, ["fragments"]).na.fill("", ["captions", "page_text"])


def evidence(tables: DataFrame, ocr: DataFrame, pages: DataFrame, most: int | None = None) -> DataFrame:
    """tables (doc, table_id, page, headers, rows) with one text of all that may back a repair: its own cells, the page's other reading, the page (whole unless `most` is given)."""
    text = F.col("text") if most is None else F.substring("text", 1, most)
    own = tables.select("doc", "page", "table_id", G.flatten_text(F.col("headers"), F.col("rows")).alias("own"))
    other = ocr.groupBy("doc", "page").agg(F.array_join(in_order(["ord"], G.flatten_text(F.col("headers"), F.col("rows"))), "\n").alias("ocr"))
    j = own.join(other, ["doc", "page"], "left").join(pages.select("doc", "page", text.alias("page_text")), ["doc", "page"], "left")
    return j.select("doc", "table_id", F.concat_ws("\n", "own", "ocr", "page_text").alias("evidence"))


def totals(statuses: DataFrame, tables: DataFrame) -> DataFrame:
    """Pages by outcome and tables, for each document and for all (doc null), in one rollup."""
    p = statuses.groupBy("doc").agg(F.count("*").alias("pages"), *[F.count_if(F.col("status") == s).alias(s) for s in ("structured_ok", "structured_fallback", "text_only", "ok", "skipped")])
    d = p.join(tables.groupBy("doc").agg(F.count("*").alias("tables")), "doc", "left").na.fill(0, ["tables"])
    cols = [c for c in d.columns if c != "doc"]
    return d.rollup("doc").agg(*[F.sum(c).alias(c) for c in cols])


def abstract(line_rows: DataFrame, most_pages: int = 5, first_pages: int = 2) -> DataFrame:
    """(doc, abstract) from lines (doc, page, idx, line): two sentences of the lines below 'Abstract' headings up to a blank line, the page's end, another heading or keywords; else of the first paragraph of the first pages.

    Windows run over the lines of a document's first pages, which must fit a task.
    """
    from pyspark.sql.window import Window

    w = Window.partitionBy("doc").orderBy("page", "idx")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    count = lambda c, over: F.coalesce(F.sum(c.cast("int")).over(over), F.lit(0))
    d = line_rows.where(F.col("page") <= most_pages).withColumn("named", F.col("line").rlike(r"(?i)^(?:#{1,6}\s*)?abstract\s*:?$"))
    d = d.withColumn("marked", F.col("line").rlike(MARKDOWN_HEADING) | F.lower("line").rlike("^# page [0-9]+$")).withColumn("text", T.clean_markdown_line(F.col("line")))
    d = d.withColumn("on", count(F.col("named"), before) > 0).withColumn("turn", F.coalesce(F.lag("page").over(w) != F.col("page"), F.lit(False)))
    ends = F.col("on") & ~F.col("named") & (F.col("marked") | F.col("line").rlike(PLAIN_HEADING) | F.lower("line").startswith("keywords"))
    takes = F.col("on") & ~F.col("named") & (F.col("line") != "") & (F.col("text") != "") & ~ends
    starts = (F.col("page") <= first_pages) & (F.col("line") != "") & ~F.col("marked") & (F.col("text") != "") & ~F.lower("text").rlike("^(?:keywords|doi:)")
    d = d.withColumn("takes", takes).withColumn("starts", starts).withColumn("a_n", count(F.col("takes"), before)).withColumn("f_n", count(F.col("starts"), before))
    d = d.withColumn("a_end", count(ends | (F.col("turn") & F.col("on")) | ((F.col("line") == "") & (F.col("a_n") > 0)), w) > 0).withColumn("f_end", count((F.col("turn") | (F.col("line") == "")) & (F.col("f_n") > 0), w) > 0)
    keep = lambda when: F.array_join(F.filter(in_order(["page", "idx"], F.when(when, F.col("text"))), lambda x: x.isNotNull()), " ")
    g = d.groupBy("doc").agg(keep(F.col("takes") & ~F.col("a_end")).alias("a"), keep(F.col("starts") & ~F.col("f_end")).alias("f"))
    return g.select("doc", T.two_sentences(F.when(F.col("a") != "", F.col("a")).otherwise(F.col("f"))).alias("abstract"))


def best_markdown_table(tables: DataFrame) -> DataFrame:
    """tables (doc, page, ord, headers, rows): the fullest of each page (named headers count twice), the first of equals."""
    full = lambda c: F.size(F.filter(c, lambda x: F.trim(x) != ""))
    score = full(F.flatten("rows")) + 2 * full(F.col("headers"))
    return tables.groupBy("doc", "page").agg(F.max_by(F.struct("ord", score.alias("score")), F.struct(score, -F.col("ord"))).alias("b")).select("doc", "page", "b.ord", "b.score")


def is_placeholder(c: Column) -> Column:
    t = F.lower(T.squeeze(c))
    return (t == "") | t.isin(*PLACEHOLDERS) | t.rlike(r"^[._\- ]+$")


def snake(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(T.blank(c), "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")


def author_token(c: Column) -> Column:
    """Last name first, joined by underscores."""
    t = F.trim(T.blank(c))
    parts = F.split(t, r"\s+")
    turned = F.concat(F.array(F.element_at(parts, -1)), F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))))
    comma = F.concat(F.array(F.trim(F.split(t, ",", 2)[0])), F.regexp_extract_all(F.coalesce(F.get(F.split(t, ",", 2), F.lit(1)), F.lit("")), F.lit("([A-Za-z]+)"), F.lit(1)))
    return snake(F.array_join(F.when(F.contains(t, F.lit(",")), comma).otherwise(turned), "_"))


def folder_name(author: Column, year: Column) -> Column:
    who = F.when(T.blank(author) != "", author_token(author)).otherwise("unknown_author")
    return F.coalesce(F.nullif(snake(F.concat_ws("_", who, F.coalesce(F.nullif(year, F.lit("")), F.lit("unknown_year")))), F.lit("")), F.lit("unknown_paper"))


def file_name(title: Column, suffix: str = ".md", fallback: str = "document", most: int = 180) -> Column:
    t = F.regexp_replace(T.squeeze(F.regexp_replace(T.blank(title), r'[\\/:*?"<>|]+', " ")), r"\.+$", "")
    return F.concat(F.coalesce(F.nullif(F.substring(t, 1, most), F.lit("")), F.lit(fallback)), F.lit(suffix))


def message_parts(text: Column, labels: Column) -> Column:
    """struct(title, excerpt, points, pdf, request, confirm, link): first line without leading signs, 180 characters, points asked for, and where buttons are (-1: nowhere)."""
    lines = F.filter(F.transform(F.split(T.blank(text), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    where = lambda p: (F.coalesce(F.array_position(F.transform(labels, lambda x: x.rlike(p)), True), F.lit(0)) - 1).cast("int")
    points = F.filter(F.transform(labels, lambda x: F.nullif(F.regexp_extract(x, r"(?i)([0-9]+)\s*pts?", 1), F.lit(""))), lambda x: x.isNotNull())
    return F.struct(
        F.trim(F.regexp_replace(F.coalesce(F.get(lines, F.lit(0)), F.lit("")), r"^[^A-Za-z0-9]+", "")).alias("title"), F.substring(T.squeeze(text), 1, 180).alias("excerpt"), F.get(points, F.lit(0)).cast("int").alias("points"),
        where("(?i)pdf").alias("pdf"), where("(?i)request").alias("request"), where("(?i)confirm|✅").alias("confirm"), where("(?i)link|🔗").alias("link"),
    )


def model_id(c: Column, default: str, aliases: dict[str, str] | None = None) -> Column:
    """A model's name without its folder, aliases resolved."""
    t = F.regexp_replace(F.trim(T.blank(c)), "^models/", "")
    out = F.when(t == "", default)
    for a, b in (aliases or {}).items():
        out = out.when(t == a, b)
    return out.otherwise(t)


def discovery(raw: DataFrame, pages: str = "pages") -> DataFrame:
    """raw (doc, pages, summary, topics, sections: title, start_page, end_page, summary): placeholders dropped, pages held to 1..n and in order."""
    n = F.greatest(F.col(pages), F.lit(1))
    tidy = lambda c: F.when(is_placeholder(c), "").otherwise(F.trim(c))

    def one(s: Column) -> Column:
        a = F.greatest(F.lit(1), F.least(F.coalesce(s["start_page"], F.lit(1)), n))
        b = F.greatest(a, F.least(F.coalesce(s["end_page"], a), n))
        return F.struct(F.trim(s["title"]).alias("title"), a.alias("start_page"), b.alias("end_page"), tidy(s["summary"]).alias("summary"))

    keep = F.transform(F.filter("sections", lambda s: ~is_placeholder(s["title"])), one)
    return raw.select("doc", tidy(F.col("summary")).alias("summary"), F.transform(F.filter("topics", lambda t: ~is_placeholder(t)), lambda t: F.trim(t)).alias("topics"), keep.alias("sections"))


def derive_topics(found: Column, from_sections: Column, from_summary: Column, least: int = 3, most: int = 8) -> Column:
    """Keyword topics; where fewer than `least`, sections' words are added, then the summary's; once each whatever the case."""
    def add(a: Column, b: Column) -> Column:
        low = F.transform(a, F.lower)
        return F.when(F.size(a) < least, F.concat(a, F.filter(b, lambda x: ~F.array_contains(low, F.lower(x))))).otherwise(a)

    return F.slice(add(add(found, from_sections), from_summary), 1, most)


def prefilled(header_rows: Column, data_rows: Column, rows: Column, cols: Column) -> Column:
    """Header and data rows as one grid of at least the detected size."""
    all_rows = F.transform(F.concat(header_rows, data_rows), lambda r: F.transform(r, T.ocr_cell))

    def full(a: Column, m: Column) -> Column:
        n = F.greatest(F.coalesce(rows, F.lit(0)), F.size(a))
        grid = F.concat(F.transform(a, lambda r: G.fit(r, m)), F.array_repeat(F.array_repeat(F.lit(""), m), n - F.size(a)))
        return F.when((n > 0) & (m > 0), grid).otherwise(F.array().cast("array<array<string>>"))

    widest = lambda a: F.greatest(F.coalesce(cols, F.lit(0)), F.coalesce(F.array_max(F.transform(a, F.size)), F.lit(0)))
    return G.let(all_rows, lambda a: G.let(widest(a), lambda m: full(a, m)))


def grid_markdown(grid: Column, header_rows: Column) -> Column:
    """A grid as a markdown table; header rows are joined by ' / '."""
    wide = lambda g: F.coalesce(F.array_max(F.transform(g, F.size)), F.lit(0))
    return G.let(grid, lambda g: G.let(wide(g), lambda m: G.let(F.transform(g, lambda r: G.fit(r, m)), lambda full: _markdown(full, m, header_rows))))


def _markdown(full: Column, m: Column, header_rows: Column) -> Column:
    """grid_markdown of rows of m cells each."""
    h = F.greatest(F.lit(1), F.least(F.greatest(header_rows, F.lit(1)), F.size(full)))
    heads = F.transform(G.upto(m), lambda c: F.array_join(F.filter(F.transform(F.slice(full, F.lit(1), h), lambda r: F.trim(F.get(r, c))), lambda x: x != ""), " / "))
    line = lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))
    return F.when(F.size(full) > 0, F.array_join(F.concat(F.array(line(heads), line(F.array_repeat(F.lit("---"), m))), F.transform(F.slice(full, h + 1, 1 << 30), line)), "\n")).otherwise("")


def missing_values(before: Column, after: Column) -> Column:
    """Cell texts of a grid of which neither a cell of the other holds them nor is held in them."""
    cells = lambda g: F.array_distinct(F.filter(F.transform(F.flatten(g), T.ocr_cell), lambda x: x != ""))
    return G.let(cells(after), lambda have: F.filter(cells(before), lambda s: ~F.exists(have, lambda o: F.contains(o, s) | F.contains(s, o))))


def reconcile_payload(rows: DataFrame) -> DataFrame:
    """rows (.., grid, answer): the answer's grid (JSON array of arrays) if it has the grid's shape and loses no text, else the grid; and why not."""
    d = rows.withColumn("_g", F.from_json("answer", "array<array<string>>"))
    lost = missing_values(F.col("grid"), F.col("_g"))
    shape = (F.size("_g") != F.size("grid")) | F.exists(F.arrays_zip(F.col("_g").alias("a"), F.col("grid").alias("b")), lambda z: ~F.size(z["a"]).eqNullSafe(F.size(z["b"])))
    why = F.when(F.col("_g").isNull(), "unreadable").when(shape, "shape").otherwise(G.let(lost, lambda x: F.when(F.size(x) > 0, F.concat(F.lit("dropped:"), F.array_join(x, ","))).otherwise("")))
    d = d.withColumn("reason", why)
    return d.withColumn("grid", F.when(F.col("reason") == "", F.col("_g")).otherwise(F.col("grid"))).drop("_g")


RECTIFIED = "rectified_header_rows_full array<array<string>>, rectified_rows array<array<string>>, edits array<struct<type:string,description:string>>, cell_provenance array<struct<row:int,col:int,source:string,evidence_text:string,confidence:double>>, rectifier_confidence double, needs_review boolean, context_request string"


def rectified_payload(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """rows (.., header_rows, data_rows, raw): a repair's answer under its schema; what it lacks falls back to what was there, with the reasons."""
    d = rows.withColumn("_p", F.from_json(T.salvage_json(F.col(raw)), RECTIFIED))
    reasons = F.filter(F.array(F.when(F.col("_p").isNull(), F.lit("not_an_object")), F.when(F.col("_p").isNotNull() & F.col("_p.rectified_header_rows_full").isNull(), F.lit("no_headers")), F.when(F.col("_p").isNotNull() & F.col("_p.rectified_rows").isNull(), F.lit("no_rows"))), lambda x: x.isNotNull())
    keep = [c for c in rows.columns if c not in (raw, "header_rows", "data_rows")]
    return d.select(
        *keep, F.coalesce("_p.rectified_header_rows_full", "header_rows").alias("header_rows"), F.coalesce("_p.rectified_rows", "data_rows").alias("data_rows"), F.coalesce("_p.cell_provenance", F.array().cast("array<struct<row:int,col:int,source:string,evidence_text:string,confidence:double>>")).alias("provenance"),
        T.clamp01(F.col("_p.rectifier_confidence"), 0.0).alias("confidence"), F.coalesce("_p.needs_review", F.size(reasons) > 0).alias("needs_review"), F.coalesce("_p.context_request", F.lit("none")).alias("context_request"), reasons.alias("reasons"),
    )


def prompt_json(most: int, **parts: Column) -> Column:
    """Named parts as JSON, long texts clipped."""
    return F.to_json(F.struct(*[F.substring(v, 1, most).alias(k) for k, v in parts.items()]))


def manifests(files: DataFrame, model: str = "", base_url: str = "") -> DataFrame:
    """A new manifest for each file (doc_id, path, sha256, page_count): fixed nested defaults, nothing that depends on the clock."""
    n = lambda **k: F.struct(*[F.lit(v).alias(a) for a, v in k.items()])
    return files.select(
        "doc_id", F.col("path").alias("source_path"), "sha256", "page_count", F.lit(model).alias("model"), F.lit(base_url).alias("base_url"), F.array().cast("array<struct<page:int,status:string>>").alias("pages"),
        n(table_escalation_max=20, table_ocr_merge=True, merge_scope="header").alias("table_pipeline"), n(empty_cell_ratio_max=0.35, repeated_text_ratio_max=0.45, column_instability_ratio_max=0.20).alias("table_quality"), n(flags=0, status="pending").alias("table_qa"),
    )
