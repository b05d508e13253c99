"""Queries over bibliographic rows, fetch reports, pages' links and metadata, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import doi as D
from .views import table


def _events(spark, sf):
    """events as a fetch log: user_id names the paper."""
    e = table(spark, sf, "events")
    prefix = F.get(F.array(*map(F.lit, ("https://doi.org/", "doi: ", "10.", " http://dx.doi.org/"))), (F.col("event_id") % 4).cast("int"))
    k = F.col("user_id") % 500
    raw = F.concat(F.when(F.col("event_id") % 4 == 2, F.lit("")).otherwise(prefix), F.lit("10.1000/AB"), k.cast("string"), F.when(F.col("event_id") % 3 == 0, ".,").otherwise(""))
    status = F.get(F.array(*map(F.lit, ("Success", "Exists", "Failed", "Timeout", "NotFound"))), (F.col("event_id") % 5).cast("int"))
    return e.select(F.col("event_id").alias("seq"), raw.alias("doi_raw"), status.alias("status"), F.concat(F.lit("f"), F.col("event_id").cast("string"), F.lit(".pdf")).alias("file_path"), "event_type", k.alias("k"))


EVENTS = """ev AS (SELECT event_id AS seq, list_extract(['https://doi.org/', 'doi: ', '', ' http://dx.doi.org/'], (event_id % 4)::int + 1) || '10.1000/AB' || user_id % 500 || CASE WHEN event_id % 3 = 0 THEN '.,' ELSE '' END AS doi_raw,
  list_extract(['Success', 'Exists', 'Failed', 'Timeout', 'NotFound'], (event_id % 5)::int + 1) AS status, 'f' || event_id || '.pdf' AS file_path, event_type, user_id % 500 AS k FROM events)"""


def doi_normalize(spark, sf):
    return _events(spark, sf).select("seq", T.normalize_doi(F.col("doi_raw")).alias("doi"))


def doi_candidates(spark, sf):
    e = _events(spark, sf)
    t = F.concat(F.lit("see "), F.col("doi_raw"), F.lit(" and https%3A%2F%2Fdoi.org%2F10.5555%2Fx"), F.col("k").cast("string"), F.lit(" (10.1000/ab"), F.col("k").cast("string"), F.lit(")"))
    return e.select("seq", F.array_join(T.doi_candidates(t), "|").alias("dois"))


def doi_in_urls(spark, sf):
    """DOIs in a URL's parameters, behind the resolver, with characters of every kind."""
    k = (F.col("event_id") % 500).cast("string")
    t = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("https://publisher.example/view?id=1&doi=10.7777%2FA_b*"), k, F.lit("&x=100%"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit(" https://dx.doi.org//10.8888/(S)"), k, F.lit("é;p?q=1 "))).otherwise(F.concat(F.lit("no url, doi=10.9999/x+"), k, F.lit("#z \"10.1234/quoted\" <10.4321/angle>")))
    return table(spark, sf, "events").select("event_id", F.array_join(T.doi_candidates(t), "|").alias("dois"))


def _parts(spark, sf):
    """part as bibliographic rows, and as works found for them."""
    p = table(spark, sf, "part")
    year = (1990 + F.col("p_size") % 30).cast("int")
    k = F.col("p_partkey")
    author = F.when(k % 5 == 0, "unknown").when(k % 3 == 0, F.concat(F.col("p_brand"), F.lit(", A. et al."))).otherwise(F.concat(F.lit("Ann B "), F.col("p_brand"), F.lit("; Other")))
    rows = p.select(k.alias("row_index"), F.when(k % 7 == 0, F.concat(F.lit("doi:10.1000/p"), k.cast("string"))).otherwise(F.lit("")).alias("doi_raw"), F.lit("").alias("url_raw"), F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(F.col("p_name"), F.lit(" by "), F.col("p_type"))).alias("title"), author.alias("author"), year.cast("string").alias("year"), F.col("p_brand").alias("container"))
    def work(n: int):
        return p.select(k.alias("row_index"), F.concat(F.lit(f"10.1000/w{n}_"), k.cast("string")).alias("doi"), F.concat(F.col("p_name"), F.lit(" by " if n == 0 else " on "), F.col("p_type") if n == 0 else F.col("p_brand")).alias("title2"), F.array(F.lower("p_brand"), F.lit("zed")).alias("families"), (year + n).alias("year2"), F.lit("journal-article" if n == 0 else "book").alias("type"), F.when(k % 2 == 0, F.col("p_brand")).otherwise(F.lit("Elsewhere")).alias("container2"))
    return rows, work(0).where("row_index % 13 <> 0").unionByName(work(1).where("row_index % 17 <> 0"))


def title_similarity(spark, sf):
    return D.score(*_parts(spark, sf)).select("row_index", "doi", "title_similarity", "author_match", "year_match", "container_similarity", "score", "rank", "gap")


def _resolved(spark, sf):
    rows, items = _parts(spark, sf)
    agencies = rows.where("row_index % 14 = 0").select(T.normalize_doi(F.col("doi_raw")).alias("doi"), F.when(F.col("row_index") % 28 == 0, "Crossref").otherwise("DataCite").alias("agency"))
    works = agencies.select("doi", F.concat("doi", F.lit("c")).alias("canonical"))
    return D.resolve(rows, agencies, works, D.accepted(D.score(rows, items)))


def doi_resolution(spark, sf):
    return _resolved(spark, sf)


def resolution_counts(spark, sf):
    e = _events(spark, sf).select(F.col("status").alias("doi_status"), F.col("event_type").alias("doi_match_method"), F.when(F.col("seq") % 3 == 0, "").otherwise(F.concat(F.lit("a"), (F.col("seq") % 4).cast("string"))).alias("doi_agency"))
    return D.counts(e)


def fetch_ready(spark, sf):
    e = _events(spark, sf)
    status = F.when(F.col("status") == "Success", "canonicalized_crossref").when(F.col("status") == "Exists", "inferred_crossref").otherwise("needs_review")
    return D.fetch_ready(e.select(F.col("seq").alias("row_index"), T.normalize_doi(F.col("doi_raw")).alias("doi_canonical"), status.alias("doi_status")))


def fetch_report_failed(spark, sf):
    return D.failed(_events(spark, sf)).select("seq", "status")


def download_index(spark, sf):
    return D.download_index(_events(spark, sf).withColumn("doi", T.normalize_doi(F.col("doi_raw"))))


def unique_dois(spark, sf):
    d = _events(spark, sf).select(T.normalize_doi(F.col("doi_raw")).alias("doi"), "seq", F.col("doi_raw").alias("original"))
    return D.keep_first(d, "doi", "seq")


def filter_variants(spark, sf):
    rows, _ = _parts(spark, sf)
    return D.filter_variants(rows.withColumn("year", F.when(F.col("row_index") % 4 == 0, "n.d.").otherwise(F.col("year")))).select("row_index", "variant", "filter")


def search_fallback(spark, sf):
    e = _events(spark, sf).select(F.col("k").alias("query_key"), (F.col("seq") % 5).cast("int").alias("variant"), "seq").where("(query_key + variant) % 3 <> 0")
    return D.first_hits(e)


def fill_from_work(spark, sf):
    rows, items = _parts(spark, sf)
    r = rows.select("row_index", F.concat(F.lit("10.1000/w0_"), F.col("row_index").cast("string")).alias("doi"), "title", F.lit(" ").alias("author"), "year", F.lit("").alias("container"))
    w = items.where("doi LIKE '10.1000/w0%'").select("doi", F.col("title2").alias("title"), F.get("families", F.lit(0)).alias("author"), F.col("year2").cast("string").alias("year"), F.col("container2").alias("container"))
    return D.fill_from_work(r, w)


def author_helpers(spark, sf):
    rows, _ = _parts(spark, sf)
    return rows.select("row_index", T.first_author(F.col("author")).alias("first_author"), T.author_last_name(F.col("author")).alias("last_name"), T.searchable_title(F.concat(F.lit("HS-12: "), F.col("title"), F.lit("... (source 10.1/x)"))).alias("searchable"))


def message_kinds(spark, sf):
    e = _events(spark, sf)
    t = F.get(F.array(*map(F.lit, ("Article NOT FOUND", "Searching, please wait", "Send a request", "paper.pdf", "hello"))), (F.col("seq") % 5).cast("int"))
    return e.select("seq", D.message_kind(t).alias("kind"))


def link_extract(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.posexplode(D.links(F.col("html"))).alias("pos", "link"))


def landing_metadata(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url", "html", F.regexp_extract("html", "<title>([^<]*)", 1).alias("t"))
    k = F.col("page_id") % 4
    tag = lambda n, v: F.concat(F.lit(f'<meta name="{n}" content="'), v, F.lit('">'))
    title = F.regexp_replace("t", "[^A-Za-z ]", "")
    ld = F.concat(F.lit('<script type="application/ld+json">{"name": "LD '), title, F.lit('", "author": [{"name": "Ld Author"}], "datePublished": "2003-04-05", "isPartOf": {"name": "Journal"}}</script>'))
    html = F.concat(F.when((k == 0) | (k == 3), tag("citation_title", F.concat(F.lit("C"), title))).otherwise(""), F.when(k != 2, F.concat(tag("DC.title", F.concat(F.lit("D"), title)), tag("dc.date", F.lit("on 1999-01-02")))).otherwise(""), F.when(k >= 2, ld).otherwise(""), "html")
    return p.select("page_id", D.landing_metadata(html).alias("m")).select("page_id", F.trim("m.title").alias("title"), "m.first_author", "m.year", "m.container")


PARTS = r"""rw AS (SELECT p_partkey AS row_index, CASE WHEN p_partkey % 7 = 0 THEN 'doi:10.1000/p' || p_partkey ELSE '' END AS doi_raw, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_name || ' by ' || p_type END AS title,
  CASE WHEN p_partkey % 5 = 0 THEN 'unknown' WHEN p_partkey % 3 = 0 THEN p_brand || ', A. et al.' ELSE 'Ann B ' || p_brand || '; Other' END AS author, (1990 + p_size % 30)::varchar AS year, p_brand AS container, p_name, p_type FROM part)"""
DIST = "list_filter(f, lambda x, i: list_position(f, x) = i)"

QUERIES = {f.__name__: f for f in (doi_normalize, doi_candidates, doi_in_urls, title_similarity, doi_resolution, resolution_counts, fetch_ready, fetch_report_failed, download_index, unique_dois, filter_variants, search_fallback, fill_from_work, author_helpers, message_kinds, link_extract, landing_metadata)}
SQL = {
    "doi_normalize": "SELECT event_id AS seq, '10.1000/ab' || user_id % 500 AS doi FROM events",
    "doi_candidates": "SELECT event_id AS seq, '10.1000/ab' || user_id % 500 || '|10.5555/x' || user_id % 500 AS dois FROM events",
    "doi_in_urls": """SELECT event_id, CASE event_id % 3 WHEN 0 THEN '10.7777/a_b*' || event_id % 500 || '|10.7777/a_b*' || event_id % 500 || '&x=100%' WHEN 1 THEN '10.8888/(s)' || event_id % 500 || 'é;p?q=1|10.8888/(s)' || event_id % 500 || 'é' ELSE '10.9999/x+' || event_id % 500 || '#z|10.1234/quoted|10.4321/angle' END AS dois FROM events""",
    "resolution_counts": f"""WITH {EVENTS} SELECT 'status' AS kind, status AS key, count(*) AS n FROM ev GROUP BY 2 UNION ALL SELECT 'method', event_type, count(*) FROM ev GROUP BY 2 UNION ALL SELECT 'agency', CASE WHEN seq % 3 = 0 THEN 'unknown' ELSE 'a' || seq % 4 END, count(*) FROM ev GROUP BY 2""",
    "fetch_ready": f"""WITH {EVENTS} SELECT '10.1000/ab' || k AS doi_canonical, min(seq) AS row_index, arg_min(CASE status WHEN 'Success' THEN 'canonicalized_crossref' ELSE 'inferred_crossref' END, seq) AS doi_status FROM ev WHERE status IN ('Success', 'Exists') GROUP BY k""",
    "fetch_report_failed": f"WITH {EVENTS} SELECT seq, status FROM ev WHERE status NOT IN ('Success', 'Exists')",
    "download_index": f"WITH {EVENTS} SELECT '10.1000/ab' || k AS doi, arg_max(file_path, seq) AS file_path FROM ev WHERE status IN ('Success', 'Exists') GROUP BY k",
    "unique_dois": f"WITH {EVENTS} SELECT '10.1000/ab' || k AS doi, min(seq) AS seq, arg_min(doi_raw, seq) AS original FROM ev GROUP BY k",
    "filter_variants": f"""WITH {PARTS}, a AS (SELECT row_index, CASE WHEN row_index % 4 = 0 THEN ['type:journal-article', ''] ELSE ['from-pub-date:' || year || ',until-pub-date:' || year || ',type:journal-article', 'from-pub-date:' || year::int - 1 || ',until-pub-date:' || year::int + 1 || ',type:journal-article', 'from-pub-date:' || year || ',until-pub-date:' || year, 'type:journal-article', ''] END AS f FROM rw)
SELECT row_index, (generate_subscripts(f, 1) - 1)::int AS variant, unnest(f) AS filter FROM a""",
    "search_fallback": "WITH a AS (SELECT user_id % 500 AS query_key, (event_id % 5)::int AS variant, event_id AS seq FROM events WHERE (user_id % 500 + event_id % 5) % 3 <> 0), b AS (SELECT *, min(variant) OVER (PARTITION BY query_key) AS m FROM a) SELECT query_key, variant, seq FROM b WHERE variant = m",
    "fill_from_work": f"""WITH {PARTS} SELECT row_index, '10.1000/w0_' || row_index AS doi, CASE WHEN title <> '' THEN title WHEN row_index % 13 <> 0 THEN p_name || ' by ' || p_type ELSE '' END AS title, CASE WHEN row_index % 13 <> 0 THEN lower(container) ELSE '' END AS author, year, CASE WHEN row_index % 13 = 0 THEN '' WHEN row_index % 2 = 0 THEN container ELSE 'Elsewhere' END AS container FROM rw""",
    "author_helpers": rf"""WITH {PARTS} SELECT row_index, CASE WHEN row_index % 5 = 0 THEN '' WHEN row_index % 3 = 0 THEN container || ', A.' ELSE 'Ann B ' || container END AS first_author, CASE WHEN row_index % 5 = 0 THEN '' WHEN row_index % 3 = 0 THEN lower(container) ELSE lower(string_split(container, ' ')[-1]) END AS last_name, trim(regexp_replace(title, '\s+', ' ', 'g')) AS searchable FROM rw""",
    "message_kinds": "SELECT event_id AS seq, list_extract(['hard_failure', 'searching', 'request', 'file', 'other'], (event_id % 5)::int + 1) AS kind FROM events",
    "link_extract": rf"""WITH a AS (SELECT page_id, list_filter(list_transform(list_concat(regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]+)"', 1), regexp_extract_all(html, '(?i)<iframe\s[^>]*?src="([^"]+)"', 1), regexp_extract_all(html, '(?i)<object\s[^>]*?data="([^"]+)"', 1), regexp_extract_all(html, '(?i)"([^"\s]+\.pdf)([?#][^"]*)?"', 1)), lambda x: regexp_replace(x, '#.*$', '')), lambda x: x <> '') AS f FROM pages), b AS (SELECT page_id, {DIST} AS l FROM a)
SELECT page_id, (generate_subscripts(l, 1) - 1)::int AS pos, unnest(l) AS link FROM b""",
    "landing_metadata": r"""WITH a AS (SELECT page_id, page_id % 4 AS k, regexp_replace(regexp_extract(html, '<title>([^<]*)', 1), '[^A-Za-z ]', '', 'g') AS t FROM pages)
SELECT page_id, trim(CASE k WHEN 0 THEN 'C' || t WHEN 3 THEN 'C' || t WHEN 1 THEN 'D' || t ELSE 'LD ' || t END) AS title, CASE WHEN k >= 2 THEN 'Ld Author' ELSE '' END AS first_author, CASE WHEN k = 2 THEN '2003' ELSE '1999' END AS year, CASE WHEN k >= 2 THEN 'Journal' ELSE '' END AS container FROM a""",
}
