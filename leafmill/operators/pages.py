"""Page text: heuristics, routes, eligibility, sections, topics, context windows, assembly. DataFrame in, DataFrame out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

# Words that name no topic.
STOPWORDS = ("about", "across", "after", "analysis", "approach", "based", "between", "conclusion", "conclusions", "data", "discussion", "from", "into", "introduction", "method", "methods", "paper", "result", "results", "study", "table", "tables", "using", "with")
# Headings of papers without a mark, lines of keywords, line ends.
PLAIN_HEADING = r"(?i)^\s*(?:[0-9]+(?:\.[0-9]+)*\s+)?(?:abstract|introduction|background|methods?|materials and methods|results?|discussion|conclusion|references)\s*$"
KEYWORDS = r"(?i)^\s{0,3}(?:#{1,6}\s*)?keywords?\s*:\s*(.+)$"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
MARKDOWN_HEADING = r"^#{1,6}\s+(.+)$"
# Parts of lines that name places of work, not persons.
AFFILIATION = "(?i)university|department|school|laboratory|institute|college|center|centre|hospital"


def span_text(spans: DataFrame) -> DataFrame:
    """Text blocks' spans, in order, joined by newlines: one row a page, empty where no span says anything, null where none has a text."""
    said = F.when((F.col("type") == 0) & (F.col("text") != ""), F.struct("block", "line", "span", "text"))
    parts = F.array_sort(F.collect_list(said))
    return spans.groupBy("doc_id", "page").agg(F.when(F.count("text") > 0, F.array_join(F.transform(parts, lambda p: p["text"]), "\n")).alias("text"))


def heuristics(text: Column) -> Column:
    """struct of a page text's counts and ratios; white space is the ASCII class."""
    t = T.blank(text)
    dense = F.regexp_replace(t, r"[ \t\n\r\f\x0B]+", "")
    n = F.length(dense)
    words = F.filter(F.split(t, r"[ \t\n\r\f\x0B]+"), lambda x: x != "")
    m = F.greatest(F.size(words), F.lit(1))
    unprintable = n - F.length(F.regexp_replace(dense, r"[\p{C}\p{Z}]", ""))
    return F.struct(
        n.alias("char_count"),
        ((n - unprintable) / F.greatest(n, F.lit(1))).alias("printable_ratio"),
        (F.size(F.filter(words, lambda x: F.lower(x).contains("cid:"))) / m).alias("cid_ratio"),
        ((F.length(t) - F.length(F.replace(t, F.lit("�"), F.lit("")))) / F.greatest(F.length(t), F.lit(1))).alias("replacement_ratio"),
        (n / m).alias("avg_token_length"),
    )


def reliable(h: Column) -> Column:
    return (h["char_count"] >= 160) & (h["printable_ratio"] >= 0.97) & (h["cid_ratio"] <= 0.005) & (h["replacement_ratio"] <= 0.0005) & h["avg_token_length"].between(2.0, 12.0)


def text_only(h: Column) -> Column:
    return (h["char_count"] >= 500) & (h["printable_ratio"] >= 0.9) & (h["cid_ratio"] <= 0.01) & (h["replacement_ratio"] <= 0.001)


def structured(h: Column) -> Column:
    return (h["printable_ratio"] >= 0.85) & (h["cid_ratio"] <= 0.05) & (h["replacement_ratio"] <= 0.01) & (h["char_count"] >= 80)


def route(h: Column, mode: str = "auto") -> Column:
    if mode in ("anchored", "unanchored"):
        return F.lit(mode)
    return F.when(reliable(h) | ((h["char_count"] >= 200) & (h["printable_ratio"] >= 0.85) & (h["cid_ratio"] <= 0.02)), "anchored").otherwise("unanchored")


def eligibility(pages: DataFrame, mode: str = "auto") -> DataFrame:
    """pages (doc, page, text) -> one row a document: is it worth structured extraction."""
    p = pages.withColumn("h", heuristics(F.col("text")))
    p = p.select("doc", "page", structured(F.col("h")).cast("int").alias("ok"), route(F.col("h")).alias("route"))
    first = F.min_by("route", "page")
    g = p.groupBy("doc").agg(F.count("*").alias("pages"), F.sum("ok").alias("oks"), first.alias("first_route"), F.min("page").alias("p0"), F.min_by("ok", "page").alias("ok0"))
    share, body = F.col("oks") / F.col("pages"), (F.col("oks") - F.col("ok0")) / F.greatest(F.col("pages") - 1, F.lit(1))
    auto = (share >= 0.6) & ((F.col("first_route") == "anchored") | ((F.col("pages") >= 3) & (body >= 0.7)))
    return g.select("doc", "pages", "first_route", (auto if mode == "auto" else F.lit(mode == "on")).alias("eligible"))


def page_outcome(attempts: DataFrame) -> DataFrame:
    """attempts (doc, page, attempt, structured, has_text, valid) -> what became of each page, and the attempt that served."""
    served = F.min(F.when(F.col("valid"), F.col("attempt")))
    g = attempts.groupBy("doc", "page").agg(F.first("structured").alias("structured"), F.first("has_text").alias("has_text"), served.alias("attempt"))
    status = F.when(F.col("structured") & (F.col("attempt") == 0), "structured_ok").when(F.col("structured"), "structured_fallback").when(F.col("has_text"), "text_only").when(F.col("attempt").isNull(), "skipped").otherwise("ok")
    return g.select("doc", "page", status.alias("status"), "attempt")


def lines(pages: DataFrame, text: str = "text") -> DataFrame:
    """(doc, page, idx, line), trimmed; blank lines are kept."""
    return pages.select("doc", "page", F.posexplode(F.split(F.replace(T.blank(F.col(text)), F.lit("\r\n"), F.lit("\n")), "\n")).alias("idx", "raw")).select("doc", "page", "idx", F.regexp_replace("raw", r"^[ \t]+|[ \t]+$", "").alias("line"))


def sections(line_rows: DataFrame, most: int = 24, clip: int = 220) -> DataFrame:
    """Headings in order, a repeat on the same page dropped, with their pages' span and the first line below.

    Windows run over a document's lines, so a document is the unit that must fit a task.
    """
    w = Window.partitionBy("doc").orderBy("page", "idx")
    mark = F.col("line").rlike(MARKDOWN_HEADING) | F.col("line").rlike(PLAIN_HEADING)
    d = line_rows.where("line <> ''").withColumn("mark", mark).withColumn("title", F.when(F.col("mark"), T.clean_heading(F.col("line"))))
    d = d.withColumn("head", F.col("mark") & T.is_heading_title(F.col("title")))
    cleaned = T.clean_markdown_line(F.col("line"))
    follows = F.lead(F.struct("page", F.col("mark"), cleaned.alias("text"))).over(w)
    d = d.withColumn("next", follows)
    stops = F.col("next").isNull() | F.col("next.mark") | (F.col("next.page") != F.col("page")) | F.lower("next.text").startswith("keywords")
    d = d.withColumn("last_page", F.max("page").over(Window.partitionBy("doc"))).withColumn("summary", F.when(stops, "").otherwise(F.col("next.text")))
    h = d.where("head").withColumn("before", F.lag(F.struct(F.lower("title").alias("t"), F.col("page").alias("p"))).over(w))
    h = h.where(F.col("before").isNull() | (F.col("before.t") != F.lower("title")) | (F.col("before.p") != F.col("page")))
    h = h.withColumn("n", F.row_number().over(w)).withColumn("after", F.lead("page").over(w)).where(F.col("n") <= most)
    end = F.when(F.col("after").isNull(), F.col("last_page")).when(F.col("after") <= F.col("page"), F.col("page")).otherwise(F.col("after") - 1)
    return h.select("doc", "n", "title", F.col("page").alias("start_page"), end.alias("end_page"), T.clip(F.col("summary"), clip).alias("summary"))


def topics(texts: DataFrame, key: str, text: str = "text", most: int = 8) -> DataFrame:
    """The commonest words of four letters and more of each key, stop words left out."""
    word = F.explode(F.regexp_extract_all(F.lower(T.blank(F.col(text))), F.lit("([a-z][a-z0-9-]{3,})"), F.lit(1)))
    d = texts.select(key, word.alias("word")).where(~F.col("word").isin(*STOPWORDS)).groupBy(key, "word").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "word"))
    return d.withColumn("rank", rank).where(F.col("rank") <= most)


def once(c: Column) -> Column:
    """Texts of an array, the first of those that differ by case only."""
    low = F.transform(c, F.lower)
    return F.filter(c, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


def keyword_topics(text: Column, most: int = 8) -> Column:
    """Terms of the first line that starts with 'Keywords:' and names any, once whatever their case."""
    lines = F.filter(F.split(T.blank(text), LINE_END), lambda x: x.rlike(KEYWORDS))
    terms = lambda x: F.filter(F.transform(F.split(F.regexp_extract(x, KEYWORDS, 1), "[;,]"), lambda y: F.regexp_replace(y, r"^[ .]+|[ .]+$", "")), lambda y: y != "")
    first = F.get(F.filter(F.transform(lines, terms), lambda x: F.size(x) > 0), F.lit(0))
    return F.slice(once(F.coalesce(first, F.array().cast("array<string>"))), 1, most)


def page_texts(tables: DataFrame, pages: DataFrame, separator: str, most: int | None = None, how: str = "inner") -> DataFrame:
    """tables (doc, table_id, at: their pages, ..) with how many of these there are, their length and their texts joined, whole unless `most` is given.

    Each distinct set of pages of a document is joined once, however many tables ask for it. With `how` left, tables
    without a page stay.
    """
    at = F.array_sort(F.array_distinct(F.filter(F.coalesce("at", F.array().cast("array<int>")), lambda p: p.isNotNull())))
    t = tables.withColumn("at", at)
    near = t.select("doc", "at").distinct().select("doc", "at", F.explode("at").alias("page"))
    text = F.col("text") if most is None else F.substring("text", 1, most)
    j = near.join(pages.select("doc", "page", text.alias("t"), F.length("text").alias("n")), ["doc", "page"])
    texts = F.transform(F.array_sort(F.collect_list(F.struct("page", "t"))), lambda x: x["t"])
    sets = j.groupBy("doc", "at").agg(F.count("*").alias("pages"), F.sum("n").alias("chars"), F.array_join(texts, separator).alias("page_text"))
    return t.join(sets, ["doc", "at"], how).drop("at")


def window_context(tables: DataFrame, pages: DataFrame, window: int = 1, most: int | None = None) -> DataFrame:
    """tables (doc, table_id, page; a row for each page of a table) with the lengths and texts of all pages within the window, whole unless `most` is given."""
    own = tables.where("page > 0").groupBy("doc", "table_id").agg(F.collect_set("page").alias("own"))
    at = F.flatten(F.transform("own", lambda p: F.sequence(F.greatest(p - window, F.lit(1)), p + window)))
    return page_texts(own.withColumn("at", at), pages, " / ", most).withColumnRenamed("page_text", "context")


def localization(blocks: DataFrame, page_counts: DataFrame) -> DataFrame:
    """Every page 1..n of a document: has it table, figure or caption blocks, and boxes for them."""
    p = page_counts.select("doc", F.explode(F.sequence(F.lit(1), F.col("pages"))).alias("page"))
    b = blocks.where(F.lower("type").isin("table", "figure", "caption")).groupBy("doc", "page").agg(F.bool_or(F.col("has_box")).alias("has_geometry"), F.lit(True).alias("has_candidate"))
    j = p.join(b, ["doc", "page"], "left").na.fill(False, ["has_candidate", "has_geometry"])
    return j.withColumn("fallback_required", F.col("has_candidate") & ~F.col("has_geometry"))


def assemble(pages: DataFrame) -> DataFrame:
    """Pages in order under '# Page N' headings: one markdown text a document."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: F.concat(F.lit("# Page "), x["page"].cast("string"), F.lit("\n\n"), T.blank(x["text"])))
    return pages.groupBy("doc").agg(F.array_join(parts, "\n\n").alias("markdown"))


def split_pages(docs: DataFrame, markdown: str = "markdown") -> DataFrame:
    """(doc, page, text) of texts with '# Page N' lines; a text without any is page 1."""
    t = F.concat(F.lit("\n"), T.blank(F.col(markdown)))
    has = t.rlike(r"\n# Page [0-9]+[ \t]*(?:\n|$)")
    parts = F.when(has, F.slice(F.split(t, r"\n?\n(?=# Page [0-9]+[ \t]*(?:\n|$))"), 2, 1 << 30)).otherwise(F.array(F.concat(F.lit("# Page 1\n"), T.blank(F.col(markdown)))))
    d = docs.select("doc", F.explode(parts).alias("part"))
    return d.select("doc", F.regexp_extract("part", "^# Page ([0-9]+)", 1).cast("int").alias("page"), F.regexp_replace("part", r"^# Page [0-9]+[ \t]*\n?\n?", "").alias("text"))


def is_person(c: Column) -> Column:
    t = F.trim(T.blank(c))
    words = F.filter(F.transform(F.split(t, r"\s+"), lambda x: F.regexp_replace(x, r"^[.,*]+|[.,*]+$", "")), lambda x: x != "")
    return F.length(t).between(3, 70) & ~t.rlike("(?i)@|http|[0-9]") & ~t.rlike(AFFILIATION) & F.size(words).between(2, 5) & F.forall(words, lambda x: x.rlike("^(?:[A-Za-z]|[A-Z][A-Za-z'`-]*)$"))


# The DOI form and the year of first pages, what starts no title or ends the authors, hints of a journal line.
PAGE_DOI = r"(?i)\b10\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]+\b"
PAGE_YEAR = r"\b(?:19|20)[0-9]{2}\b"
NO_TITLE = ("abstract", "keywords", "introduction", "doi")
JOURNAL_HINTS = ("journal", "proceedings", "conference", "vol.", "volume", "issue", "arxiv", "pp.", "pages")


def _starts(c: Column, names: tuple[str, ...]) -> Column:
    low = F.lower(c)
    found = F.lit(False)
    for n in names:
        found = found | low.startswith(n)
    return found


def _probable_title(x: Column) -> Column:
    words = F.size(F.filter(F.split(x, r"(?U)\s+"), lambda w: w != ""))
    return ~_starts(x, NO_TITLE) & ~x.contains("@") & ~F.lower(x).contains("http") & ~F.lower(x).contains("doi:") & (words >= 3) & F.length(x).between(16, 220)


def _authors_of(line: Column) -> Column:
    parts = F.filter(F.transform(F.split(F.regexp_replace(line, r"(?i)\b(?:and|&)\b", ","), "[;,]"), T.strip), lambda x: x != "")
    return once(F.filter(F.transform(parts, lambda x: F.when(F.size(parts) == 1, x).otherwise(F.regexp_replace(x, r"^[ *]+|[ *]+$", ""))), is_person))


def _without_doi(x: Column) -> Column:
    t = F.regexp_replace(F.regexp_replace(x, r"(?i)https?://(?:dx\.)?doi\.org/\S+", " "), r"(?i)\bdoi\s*:\s*", " ")
    return F.regexp_replace(T.squeeze(F.regexp_replace(t, PAGE_DOI, " ")), "^[ ;,]+|[ ;,]+$", "")


def bibliography(pages: DataFrame) -> DataFrame:
    """First pages' title (first likely line of 30), authors (the first of the next 12 lines that names some), year, DOI and journal line."""
    none = F.array().cast("array<string>")
    lines = F.filter(F.transform(F.split(T.blank(F.col("text")), LINE_END), T.clean_markdown_line), lambda x: x != "")
    d = pages.where("page = 1").select("doc", "text", lines.alias("ls"))
    d = d.withColumn("title", F.coalesce(F.get(F.filter(F.slice("ls", 1, 30), _probable_title), F.lit(0)), F.lit("")))
    d = d.withColumn("near", F.slice("ls", F.greatest(F.array_position("ls", F.col("title")).cast("int"), F.lit(1)) + 1, 12))
    stop = F.coalesce(F.get(F.filter(F.transform("near", lambda x, i: F.when(_starts(x, NO_TITLE[:3]), i)), lambda i: i.isNotNull()), F.lit(0)), F.size("near"))
    named = F.transform(F.slice("near", F.lit(1), stop), lambda x: F.struct(x.alias("line"), _authors_of(x).alias("who")))
    listed = F.filter(named, lambda n: (F.size(n["who"]) >= 2) | ((F.size(n["who"]) == 1) & (n["line"].rlike("[,;]") | F.lower(n["line"]).contains(" and "))))
    d = d.withColumn("authors", F.coalesce(F.get(listed, F.lit(0))["who"], none))
    bare = F.transform("ls", _without_doi)
    year = F.coalesce(F.get(F.filter(F.transform(bare, lambda x: F.regexp_extract(x, PAGE_YEAR, 0)), lambda y: y != ""), F.lit(0)), F.lit(""))
    hint = lambda x: F.exists(F.array(*map(F.lit, JOURNAL_HINTS)), lambda h: F.contains(F.lower(x), h)) | x.rlike(PAGE_YEAR)
    own = lambda x: (F.lower(x) == F.lower(F.trim("title"))) | F.array_contains(F.transform("authors", lambda a: F.lower(F.trim(a))), F.lower(x))
    journal = F.coalesce(F.get(F.filter(bare, lambda x: (x != "") & ~own(x) & hint(x)), F.lit(0)), F.lit(""))
    doi = F.regexp_replace(F.regexp_extract(T.blank(F.col("text")), PAGE_DOI, 0), "[.,;)]+$", "")
    return d.select("doc", "title", "authors", year.alias("year"), doi.alias("doi"), journal.alias("journal_ref"))


def patch_bibliography(base: DataFrame, patch: DataFrame, key: str = "doc") -> DataFrame:
    """Blanks of base filled from patch; the citation made anew."""
    cols = ["title", "year", "doi", "journal_ref"]
    p = patch.select(key, *[F.col(c).alias(f"p_{c}") for c in cols])
    pick = lambda c: F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.nullif(F.trim(F.col(f"p_{c}")), F.lit("")), F.lit(""))
    d = base.join(p, key, "left").select(key, *[pick(c).alias(c) for c in cols])
    return d.withColumn("citation", F.concat_ws(" ", F.nullif(F.col("journal_ref"), F.lit("")), F.concat(F.lit("doi:"), F.nullif(F.col("doi"), F.lit("")))))


def choose_sections(parsed: DataFrame, found: DataFrame) -> DataFrame:
    """Per document the parsed sections if they are 3 or more, reach past page 1, or nothing else was found."""
    p = parsed.groupBy("doc").agg(F.count("*").alias("np"), F.max("start_page").alias("mp"))
    f = found.groupBy("doc").agg(F.count("*").alias("nf"))
    j = p.join(f, "doc", "full_outer").na.fill(0, ["np", "mp", "nf"])
    take = (F.col("np") > 0) & ((F.col("np") >= 3) | (F.col("mp") > 1) | (F.col("nf") == 0))
    return j.select("doc", F.when(take, "parsed").otherwise("found").alias("choice"))


def index_head(group: Column) -> Column:
    return F.concat(F.lit("# Paper Index: "), group, F.lit("\n\nThis index is generated for quick LLM discovery across papers in this folder.\n"))


def index_entries(papers: DataFrame, group: str, most_sections: int = 12) -> DataFrame:
    """(group, folder_name, entry): a document's part of its group's index.

    papers: group, folder_name, consolidated_markdown, title, citation, page_count, summary, topics, sections (title,
    start_page, end_page, summary). Optional lines stand only where there is something to say. No group is gathered: the
    sink sorts entries by folder name within a group's files.
    """
    t = lambda c: T.strip(T.blank(F.col(c)))
    title = F.coalesce(F.nullif(t("title"), F.lit("")), F.nullif(F.replace(t("consolidated_markdown"), F.lit(".md"), F.lit("")), F.lit("")), t("folder_name"))
    line = lambda name, v: F.when(v != "", F.concat(F.lit(f"- {name}: "), v))

    def section(s: Column) -> Column:
        a = F.coalesce(F.nullif(s["start_page"], F.lit(0)), F.lit(1))
        b = F.coalesce(F.nullif(s["end_page"], F.lit(0)), a)
        span = F.when(a == b, F.concat(F.lit("p. "), a.cast("string"))).otherwise(F.concat(F.lit("pp. "), a.cast("string"), F.lit("-"), b.cast("string")))
        about = T.strip(T.blank(s["summary"]))
        return F.concat(F.lit("  - "), T.strip(s["title"]), F.lit(" ("), span, F.lit(")"), F.when(about != "", F.concat(F.lit(": "), about)).otherwise(""))

    sections = F.coalesce("sections", F.array().cast("array<struct<title:string,start_page:int,end_page:int,summary:string>>"))
    named = F.transform(F.filter(F.slice(sections, 1, most_sections), lambda s: T.strip(T.blank(s["title"])) != ""), section)
    parts = F.concat(
        F.array(F.concat(F.lit("## "), title), F.lit(""), F.concat(F.lit("- Location: `"), t("folder_name"), F.lit("/"), t("consolidated_markdown"), F.lit("`")), F.when(F.col("page_count") != 0, F.concat(F.lit("- Pages: "), F.col("page_count").cast("string"))), line("Citation", t("citation")), line("Summary", t("summary")), line("Topics", F.array_join(F.coalesce("topics", F.array().cast("array<string>")), ", "))),
        F.when(F.size(sections) > 0, F.concat(F.array(F.lit("- Key Sections:")), named)).otherwise(F.array().cast("array<string>")),
        F.array(F.lit("")),
    )
    return papers.select(group, "folder_name", F.array_join(F.filter(parts, lambda x: x.isNotNull()), "\n").alias("entry"))
