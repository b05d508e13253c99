"""Queries over page texts, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse
from ..functions import text as T
from ..operators import pages as P
from .views import V_FRAGMENT, V_PAGE, table, v_fragment, v_page

WS = r"[ \t\n\r\f\x0B]"
HEUR = rf"""h0 AS (SELECT *, regexp_replace(text, '{WS}+', '', 'g') AS dense, list_filter(regexp_split_to_array(text, '{WS}+'), lambda x: x <> '') AS words FROM v_page),
h AS (SELECT *, length(dense) AS char_count,
  length(regexp_replace(dense, '[\p{{C}}\p{{Z}}]', '', 'g')) / greatest(length(dense), 1) AS printable_ratio,
  len(list_filter(words, lambda x: contains(lower(x), 'cid:'))) / greatest(len(words), 1) AS cid_ratio,
  (length(text) - length(replace(text, chr(65533), ''))) / greatest(length(text), 1) AS replacement_ratio,
  length(dense) / greatest(len(words), 1) AS avg_token_length FROM h0),
r AS (SELECT *, (char_count >= 160 AND printable_ratio >= 0.97 AND cid_ratio <= 0.005 AND replacement_ratio <= 0.0005 AND avg_token_length BETWEEN 2 AND 12) AS reliable,
  (char_count >= 500 AND printable_ratio >= 0.9 AND cid_ratio <= 0.01 AND replacement_ratio <= 0.001) AS text_only,
  (printable_ratio >= 0.85 AND cid_ratio <= 0.05 AND replacement_ratio <= 0.01 AND char_count >= 80) AS structured FROM h),
s AS (SELECT *, CASE WHEN reliable OR (char_count >= 200 AND printable_ratio >= 0.85 AND cid_ratio <= 0.02) THEN 'anchored' ELSE 'unanchored' END AS route FROM r)"""


def page_heuristics(spark, sf):
    h = P.heuristics(F.col("text"))
    return v_page(spark, sf).withColumn("h", h).select("doc", "page", "h.*")


def page_routes(spark, sf):
    d = v_page(spark, sf).withColumn("h", P.heuristics(F.col("text")))
    h = F.col("h")
    return d.select("doc", "page", P.route(h).alias("route"), P.reliable(h).alias("reliable"), P.text_only(h).alias("text_only"), P.structured(h).alias("structured"))


def doc_eligibility(spark, sf):
    return P.eligibility(v_page(spark, sf))


def page_outcome(spark, sf):
    d = v_page(spark, sf)
    a = d.select("doc", "page", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("attempt"), (F.col("page") % 3 == 0).alias("structured"), (F.length("text") >= 500).alias("has_text"), F.length("text").alias("n"))
    return P.page_outcome(a.withColumn("valid", (F.col("n") + F.col("attempt")) % 5 < 2))


def markdown_normalize(spark, sf):
    t = F.concat(F.lit("#Title  \n- x\n*   y\nTABLE 3.  "), F.regexp_replace("text", r"[\n\r]", " "), F.lit("\n| a|b |\n\n\n\n"), F.col("text"))
    return v_page(spark, sf).select("doc", "page", T.normalize_markdown(t).alias("markdown"))


def html_plain_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.when(F.col("html").isNotNull(), T.plain_text(F.col("html"))).alias("plain"))


def symbols(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.symbols(F.col("text")).alias("symbols"), F.length(T.alnum_signature(F.col("text"))).alias("signature_chars"), F.sha1(T.alnum_signature(F.col("text"))).alias("signature"))


def topics(spark, sf):
    return P.topics(table(spark, sf, "documents"), "doc_id").select("doc_id", "word", "n", "rank")


def keyword_topics(spark, sf):
    """Keyword lines behind whole texts: one without terms, one with repeats in another case, one more."""
    t = F.concat("text", F.lit("\n## Keywords: .;\n keyword : Spark, spark; "), "source", F.lit(" .,"), "lang", F.lit("; SPARK, a é.\r\nKeywords: last"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(P.keyword_topics(t), "|").alias("topics"))


def summary_two_sentences(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.two_sentences(F.col("text")).alias("summary"))


def _headed(spark, sf):
    """Every third line of the pages made a heading."""
    ls = P.lines(v_page(spark, sf))
    return ls.withColumn("line", F.when((F.col("idx") % 3 == 0) & (F.col("line") != ""), F.concat(F.lit("## "), "line")).otherwise(F.col("line")))


def sections(spark, sf):
    return P.sections(_headed(spark, sf))


def localization_status(spark, sf):
    f = v_fragment(spark, sf)
    b = f.where("doc % 3 <> 0").select("doc", "page", F.when(F.col("frag") % 2 == 0, "Table").otherwise("Text").alias("type"), (F.col("frag") % 8 != 0).alias("has_box"))
    return P.localization(b, f.groupBy("doc").agg(F.max("page").alias("pages")))


def group_index(spark, sf):
    d = v_page(spark, sf).groupBy("source", "doc").agg(F.min("page").alias("a"), F.max("page").alias("b"), F.count("*").alias("n"), F.array_sort(F.collect_set("lang")).alias("langs"))
    name, odd = F.concat(F.lit("paper_"), F.col("doc").cast("string")), F.col("doc") % 2 == 1
    section = lambda t, a, b, s: F.struct(F.lit(t).alias("title"), a.cast("int").alias("start_page"), b.cast("int").alias("end_page"), s.alias("summary"))
    many = F.transform(F.sequence(F.lit(1), F.lit(14)), lambda i: F.struct(F.concat(F.lit("S"), i.cast("string")).alias("title"), i.cast("int").alias("start_page"), i.cast("int").alias("end_page"), F.lit("").alias("summary")))
    sections = F.when(F.col("doc") % 3 == 0, F.array(section("Intro", F.col("a"), F.col("b"), F.lit("what it says")), section(" ", F.col("a"), F.col("b"), F.lit("x")), section("End", F.col("b"), F.lit(None), F.lit("")))).when(F.col("doc") % 3 == 1, many)
    papers = d.select("source", name.alias("folder_name"), F.concat(name, F.lit(".md")).alias("consolidated_markdown"), F.when(odd, F.concat(F.lit("Title "), F.col("doc").cast("string"))).alias("title"), F.when(odd, "A. Nother (1999)").alias("citation"), F.when(F.col("doc") % 5 != 0, F.col("n")).cast("int").alias("page_count"), F.when(~odd, "  a summary ").otherwise(" ").alias("summary"), F.when(odd, F.col("langs")).alias("topics"), sections.alias("sections"))
    return P.index_entries(papers, "source")


def assemble_split(spark, sf):
    return P.split_pages(P.assemble(v_page(spark, sf))).select("doc", "page", F.md5("text").alias("text_md5"))


def bibliography_patch(spark, sf):
    d = v_page(spark, sf).where("page = 1")
    base = d.select("doc", F.when(F.col("doc") % 2 == 0, F.split("text", "\n")[0]).otherwise("  ").alias("title"), F.lit("").alias("year"), F.lit("").alias("doi"), F.lit("J").alias("journal_ref"))
    patch = d.select("doc", F.lit("Untitled").alias("title"), F.when(F.col("doc") % 3 != 0, "2001").alias("year"), F.concat(F.lit("10.1000/"), F.col("doc").cast("string")).alias("doi"), F.lit("K").alias("journal_ref"))
    return P.patch_bibliography(base, patch)


def bibliography_first_page(spark, sf):
    d = v_page(spark, sf).withColumn("text", F.concat(F.lit("# On Spark Query Plans\nAda Lovelace, Alan Turing and Grace Hopper\nJournal of Plans, vol. 3, 1999\ndoi:10.1000/"), F.col("doc").cast("string"), F.lit("\n"), F.lower("text")))
    return P.bibliography(d).withColumn("authors", F.array_join("authors", "|"))


def section_choice(spark, sf):
    s = v_page(spark, sf)
    return P.choose_sections(s.where("doc % 4 = 0 AND page <= doc % 5").select("doc", F.col("page").alias("start_page")), s.where("doc % 3 = 0").select("doc", F.col("page").alias("start_page")))


def front_matter(spark, sf):
    t = F.concat(F.lit("---\nlang: "), F.col("lang"), F.lit("\nsource: '"), F.col("source"), F.lit("'\n---\n"), F.col("text"))
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, t).otherwise(F.col("text")).alias("t"))
    return d.withColumn("f", parse.front_matter("t")).select("doc_id", F.col("f.meta")["lang"].alias("lang"), F.col("f.meta")["source"].alias("source"), F.md5("f.body").alias("body_md5"))


SQUEEZE = rf"trim(regexp_replace({{}}, '{WS}+', ' ', 'g'))"
REFERENCES = "t"  # the character references that the pages hold, with or without a semicolon
for _name, _ch in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("nbsp", " "), ("copy", "©"), ("middot", "·"), ("amp", "&")):
    REFERENCES = f"regexp_replace({REFERENCES}, '&{_name};?', '{_ch}', 'g')"
CLEAN_LINE = SQUEEZE.format(r"regexp_replace(regexp_replace(regexp_replace(trim({}), '^#{{1,6}}\s+', ''), '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '[`*_~]+', '', 'g')")
CLIP = "CASE WHEN length({0}) > {1} THEN rtrim(substr({0}, 1, {1} - 3)) || '...' ELSE {0} END"

QUERIES = {f.__name__: f for f in (page_heuristics, page_routes, doc_eligibility, page_outcome, markdown_normalize, html_plain_text, symbols, topics, keyword_topics, summary_two_sentences, sections, localization_status, group_index, assemble_split, bibliography_patch, bibliography_first_page, section_choice, front_matter)}
SQL = {
    "page_heuristics": f"WITH {V_PAGE}, {HEUR} SELECT doc, page, char_count::int AS char_count, printable_ratio, cid_ratio, replacement_ratio, avg_token_length FROM s",
    "page_routes": f"WITH {V_PAGE}, {HEUR} SELECT doc, page, route, reliable, text_only, structured FROM s",
    "doc_eligibility": f"""WITH {V_PAGE}, {HEUR}, g AS (SELECT doc, count(*) AS pages, sum(structured::int) AS oks, arg_min(route, page) AS first_route, arg_min(structured::int, page) AS ok0 FROM s GROUP BY doc)
SELECT doc, pages, first_route, oks / pages >= 0.6 AND (first_route = 'anchored' OR (pages >= 3 AND (oks - ok0) / greatest(pages - 1, 1) >= 0.7)) AS eligible FROM g""",
    "page_outcome": f"""WITH {V_PAGE}, a AS (SELECT doc, page, page % 3 = 0 AS st, length(text) >= 500 AS ht, (SELECT min(i) FROM range(4) t(i) WHERE (length(text) + i) % 5 < 2)::int AS attempt FROM v_page)
SELECT doc, page, CASE WHEN st AND attempt = 0 THEN 'structured_ok' WHEN st THEN 'structured_fallback' WHEN ht THEN 'text_only' WHEN attempt IS NULL THEN 'skipped' ELSE 'ok' END AS status, attempt FROM a""",
    "markdown_normalize": rf"""WITH {V_PAGE},
a AS (SELECT doc, page, {(r"'#Title  ' || chr(10) || '- x' || chr(10) || '*   y' || chr(10) || 'TABLE 3.  ' || regexp_replace(text, '[\n\r]', ' ', 'g') || chr(10) || '| a|b |' || repeat(chr(10), 4) || text")} AS t FROM v_page),
b AS (SELECT doc, page, regexp_replace(regexp_replace(regexp_replace(t, '(?m)[ \t]+$', '', 'g'), '(?m)^(#{{1,6}})([^\s#])', '\1 \2', 'g'), '(?m)^(\s*[-*+])\s{{2,}}', '\1 ', 'g') AS t FROM a),
c AS (SELECT doc, page, array_to_string(list_transform(string_split(t, chr(10)), lambda x: CASE
    WHEN regexp_full_match(trim(x), '\|.*\|') THEN '| ' || array_to_string(list_transform(string_split(regexp_extract(trim(x), '^\|+(.*?)\|+$', 1), '|'), lambda y: trim(y)), ' | ') || ' |'
    WHEN regexp_matches(x, '(?i)^(figure|table)\s+([0-9]+)\s*[:.\-]?\s*(.+)$') THEN upper(substr(regexp_extract(x, '(?i)^(figure|table)', 1), 1, 1)) || lower(substr(regexp_extract(x, '(?i)^(figure|table)', 1), 2)) || ' ' || regexp_extract(x, '(?i)^(figure|table)\s+([0-9]+)', 2) || ': ' || trim(regexp_extract(x, '(?i)^(figure|table)\s+([0-9]+)\s*[:.\-]?\s*(.+)$', 3))
    ELSE x END), chr(10)) AS t FROM b)
SELECT doc, page, regexp_replace(regexp_replace(t, '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') || chr(10) AS markdown FROM c""",
    "html_plain_text": rf"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?i)<br\s*/?>', chr(10), 'g'), '<[^>]+>', ' ', 'g') AS t FROM pages)
SELECT page_id, {SQUEEZE.format(REFERENCES)} AS plain FROM a""",
    "symbols": r"""WITH s AS (SELECT doc_id, regexp_extract_all(text, '([^\x00-\x7F])') AS f, regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') AS g FROM documents)
SELECT doc_id, coalesce(array_to_string(list_filter(f, lambda x, i: list_position(f, x) = i), ''), '') AS symbols, length(g)::int AS signature_chars, sha1(g) AS signature FROM s""",
    "topics": rf"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9-]{{3,}}')) AS word FROM documents),
c AS (SELECT doc_id, word, count(*) AS n FROM w WHERE word NOT IN {P.STOPWORDS} GROUP BY ALL)
SELECT * FROM (SELECT doc_id, word, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word)::int AS rank FROM c) WHERE rank <= 8""",
    "keyword_topics": r"""WITH a AS (SELECT doc_id, regexp_split_to_array(text || chr(10) || '## Keywords: .;' || chr(10) || ' keyword : Spark, spark; ' || source || ' .,' || lang || '; SPARK, a é.' || chr(13) || chr(10) || 'Keywords: last', '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]') AS ls FROM documents),
b AS (SELECT doc_id, list_filter(list_transform(list_filter(ls, lambda x: regexp_matches(x, '(?i)^\s{0,3}(?:#{1,6}\s*)?keywords?\s*:\s*(.+)$')), lambda x: list_filter(list_transform(regexp_split_to_array(regexp_extract(x, '(?i)^\s{0,3}(?:#{1,6}\s*)?keywords?\s*:\s*(.+)$', 1), '[;,]'), lambda y: regexp_replace(y, '^[ .]+|[ .]+$', '', 'g')), lambda y: y <> '')), lambda x: len(x) > 0)[1] AS f FROM a)
SELECT doc_id, array_to_string(list_slice(list_filter(f, lambda x, i: list_position(list_transform(f, lambda y: lower(y)), lower(x)) = i), 1, 8), '|') AS topics FROM b""",
    "summary_two_sentences": rf"""WITH a AS (SELECT doc_id, {SQUEEZE.format('text')} AS t FROM documents),
b AS (SELECT doc_id, array_to_string(list_slice(string_split(regexp_replace(t, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), 1, 2), ' ') AS s FROM a)
SELECT doc_id, {CLIP.format('s', 480)} AS summary FROM b""",
    "sections": rf"""WITH {V_PAGE},
l0 AS (SELECT doc, page, unnest(string_split(t, chr(10))) AS raw, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS idx FROM (SELECT doc, page, replace(text, chr(13) || chr(10), chr(10)) AS t FROM v_page)),
l1 AS (SELECT doc, page, idx, regexp_replace(raw, '^[ \t]+|[ \t]+$', '', 'g') AS raw FROM l0),
l AS (SELECT doc, page, idx, CASE WHEN idx % 3 = 0 THEN '## ' || raw ELSE raw END AS line FROM l1 WHERE raw <> ''),
m AS (SELECT *, regexp_matches(line, '{P.MARKDOWN_HEADING}') OR regexp_matches(line, '{P.PLAIN_HEADING}') AS mark, {CLEAN_LINE.format('line')} AS clean FROM l),
t AS (SELECT *, CASE WHEN mark THEN {SQUEEZE.format(r"regexp_replace(regexp_replace(clean, '^[0-9]+(?:\.[0-9]+)*\s+', ''), '^[:.\- ]+|[:.\- ]+$', '', 'g')")} END AS title,
  lead(mark) OVER w AS nm, lead(page) OVER w AS np, lead(clean) OVER w AS nc, max(page) OVER (PARTITION BY doc) AS last_page FROM m WINDOW w AS (PARTITION BY doc ORDER BY page, idx)),
h AS (SELECT *, CASE WHEN nc IS NULL OR nm OR np <> page OR lower(nc) LIKE 'keywords%' THEN '' ELSE nc END AS below, lag(lower(title)) OVER w AS bt, lag(page) OVER w AS bp FROM t
  WHERE mark AND length(title) BETWEEN 2 AND 120 AND NOT lower(title) LIKE 'page %' AND NOT regexp_full_match(title, '[-_=*.]+') WINDOW w AS (PARTITION BY doc ORDER BY page, idx)),
n AS (SELECT *, row_number() OVER w AS n, lead(page) OVER w AS after FROM h WHERE bt IS NULL OR bt <> lower(title) OR bp <> page WINDOW w AS (PARTITION BY doc ORDER BY page, idx))
SELECT doc, n::int AS n, title, page AS start_page, CASE WHEN after IS NULL THEN last_page WHEN after <= page THEN page ELSE after - 1 END AS end_page, {CLIP.format('below', 220)} AS summary FROM n WHERE n <= 24""",
    "localization_status": f"""WITH {V_FRAGMENT}, p AS (SELECT doc, unnest(range(1, max(page) + 1))::int AS page FROM v_fragment GROUP BY doc),
b AS (SELECT doc, page, bool_or(frag % 8 <> 0) AS g FROM v_fragment WHERE doc % 3 <> 0 AND frag % 2 = 0 GROUP BY ALL)
SELECT doc, page, g IS NOT NULL AS has_candidate, coalesce(g, false) AS has_geometry, g IS NOT NULL AND NOT g AS fallback_required FROM p LEFT JOIN b USING (doc, page)""",
    "group_index": f"""WITH {V_PAGE}, d AS (SELECT source, doc, min(page) AS a, max(page) AS b, count(*) AS n, list_sort(list(DISTINCT lang)) AS langs FROM v_page GROUP BY ALL)
SELECT source, 'paper_' || doc AS folder_name, '## ' || CASE WHEN doc % 2 = 1 THEN 'Title ' || doc ELSE 'paper_' || doc END || chr(10) || chr(10) || '- Location: `paper_' || doc || '/paper_' || doc || '.md`' || chr(10)
  || CASE WHEN doc % 5 <> 0 THEN '- Pages: ' || n || chr(10) ELSE '' END || CASE WHEN doc % 2 = 1 THEN '- Citation: A. Nother (1999)' || chr(10) || CASE WHEN len(langs) > 0 AND array_to_string(langs, ', ') <> '' THEN '- Topics: ' || array_to_string(langs, ', ') || chr(10) ELSE '' END ELSE '- Summary: a summary' || chr(10) END
  || CASE doc % 3 WHEN 0 THEN '- Key Sections:' || chr(10) || '  - Intro (' || CASE WHEN a = b THEN 'p. ' || a ELSE 'pp. ' || a || '-' || b END || '): what it says' || chr(10) || '  - End (p. ' || b || ')' || chr(10)
    WHEN 1 THEN '- Key Sections:' || chr(10) || array_to_string(list_transform(range(1, 13), lambda i: '  - S' || i || ' (p. ' || i || ')'), chr(10)) || chr(10) ELSE '' END AS entry FROM d""",
    "bibliography_patch": f"""WITH {V_PAGE}, d AS (SELECT doc, string_split(text, chr(10))[1] AS t FROM v_page WHERE page = 1),
m AS (SELECT doc, CASE WHEN doc % 2 = 0 AND trim(t) <> '' THEN trim(t) ELSE 'Untitled' END AS title, CASE WHEN doc % 3 <> 0 THEN '2001' ELSE '' END AS year, '10.1000/' || doc AS doi, 'J' AS journal_ref FROM d)
SELECT *, journal_ref || ' doi:' || doi AS citation FROM m""",
    "bibliography_first_page": f"""WITH {V_PAGE} SELECT doc, 'On Spark Query Plans' AS title, 'Ada Lovelace|Alan Turing|Grace Hopper' AS authors, '1999' AS year, '10.1000/' || doc AS doi, 'Journal of Plans, vol. 3, 1999' AS journal_ref FROM v_page WHERE page = 1""",
    "section_choice": f"""WITH {V_PAGE}, p AS (SELECT doc, count(*) AS n, max(page) AS m FROM v_page WHERE doc % 4 = 0 AND page <= doc % 5 GROUP BY doc), f AS (SELECT doc, count(*) AS k FROM v_page WHERE doc % 3 = 0 GROUP BY doc)
SELECT doc, CASE WHEN n > 0 AND (n >= 3 OR m > 1 OR k IS NULL) THEN 'parsed' ELSE 'found' END AS choice FROM p FULL JOIN f USING (doc)""",
    "assemble_split": f"WITH {V_PAGE} SELECT doc, page, md5(text) AS text_md5 FROM v_page",
    "front_matter": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS lang, CASE WHEN doc_id % 2 = 0 THEN source END AS source, md5(text) AS body_md5 FROM documents",
}
