"""Bibliographic resolution: candidates scored, accepted and turned into one status a row; fetch reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import similarity as S
from ..functions import text as T

# Statuses from which a paper may be fetched, and reports that need no retry.
READY = ("canonicalized_crossref", "canonicalized_non_crossref", "inferred_crossref")
DONE = ("Success", "Exists")


def filter_variants(rows: DataFrame) -> DataFrame:
    """Search filters of each row, narrowest first: its year, a year around, any type, any year, none."""
    y = T.year_in(F.col("year"))
    n = F.nullif(y, F.lit("")).cast("int")
    span = lambda a, b: F.concat(F.lit("from-pub-date:"), a.cast("string"), F.lit(",until-pub-date:"), b.cast("string"))
    kind = F.lit("type:journal-article")
    dated = F.array(F.concat_ws(",", span(n, n), kind), F.concat_ws(",", span(n - 1, n + 1), kind), span(n, n), kind, F.lit(""))
    return rows.select("row_index", F.posexplode(F.when(n.isNotNull(), dated).otherwise(F.array(kind, F.lit("")))).alias("variant", "filter"))


def first_hits(items: DataFrame) -> DataFrame:
    """items (query_key, variant, ..): those of each query's first variant that found any."""
    return items.withColumn("_m", F.min("variant").over(Window.partitionBy("query_key"))).where("variant = _m").drop("_m")


def score(rows: DataFrame, items: DataFrame) -> DataFrame:
    """rows (row_index, title, author, year, container) with items (row_index, doi, title2, families, year2, type, container2): scored candidates.

    rank 1 is best; gap is the lead over the runner-up.
    """
    j = rows.join(items, "row_index").withColumn("doi", T.normalize_doi(F.col("doi"))).where("doi <> ''")
    year = lambda c: F.nullif(T.year_in(F.col(c).cast("string")), F.lit("")).cast("int")
    j = j.withColumn("title_similarity", S.title_similarity(F.col("title"), F.col("title2"))).withColumn("author_match", S.author_similarity(F.col("author"), F.col("families")))
    j = j.withColumn("year_match", S.year_similarity(year("year"), year("year2"))).withColumn("type_preference", F.when(F.lower(F.trim("type")) == "journal-article", 1.0).otherwise(0.0)).withColumn("container_similarity", S.container_similarity(F.col("container"), F.col("container2")))
    j = j.withColumn("score", 0.55 * F.col("title_similarity") + 0.20 * F.col("author_match") + 0.15 * F.col("year_match") + 0.10 * F.col("type_preference"))
    w = Window.partitionBy("row_index").orderBy(F.desc("score"), "doi")
    return j.withColumn("rank", F.row_number().over(w)).withColumn("gap", F.col("score") - F.coalesce(F.lead("score").over(w), F.lit(0.0)))


def confirmed() -> Column:
    full = (T.blank(F.col("title")) != "") & (T.blank(F.col("author")) != "") & (T.blank(F.col("year").cast("string")) != "")
    place = (F.trim(T.blank(F.col("container"))) == "") | (F.col("container_similarity") >= 0.6)
    return full & (F.col("title_similarity") >= 0.92) & (F.col("author_match") >= 1.0) & (F.col("year_match") >= 0.5) & place


def balanced() -> Column:
    with_author = (F.col("score") >= 0.62) & (F.col("title_similarity") >= 0.38) & (F.col("author_match") >= 1.0) & (F.col("year_match") >= 1.0) & (F.col("gap") >= 0.03)
    without = (F.col("score") >= 0.50) & (F.col("title_similarity") >= 0.46) & (F.col("year_match") >= 1.0) & (F.col("container_similarity") >= 0.30) & (F.col("gap") >= 0.04)
    return F.when(T.first_author(F.col("author")) != "", with_author).otherwise(without)


def accepted(scored: DataFrame) -> DataFrame:
    """The best candidate of each row with the rule that takes it: auto, confirmed, balanced or none."""
    auto = (F.col("score") >= 0.88) & (F.col("title_similarity") >= 0.92) & (F.col("gap") >= 0.08) & (F.col("author_match") > 0)
    return scored.where("rank = 1").withColumn("rule", F.when(auto, "auto").when(confirmed(), "confirmed").when(balanced(), "balanced").otherwise("none"))


def resolve(rows: DataFrame, agencies: DataFrame, works: DataFrame, picks: DataFrame) -> DataFrame:
    """One status a row.

    rows (row_index, doi_raw, url_raw, title, ..); agencies (doi, agency); works (doi, canonical); picks: accepted().
    A DOI in the row's own text, registered somewhere, wins; else an accepted candidate; else review or not found.
    """
    d = rows.withColumn("doi_extracted", F.coalesce(F.get(T.doi_candidates(F.concat_ws(" ", "doi_raw", "url_raw")), F.lit(0)), F.lit("")))
    d = d.join(agencies.select(F.col("doi").alias("doi_extracted"), F.lower("agency").alias("doi_agency")), "doi_extracted", "left").join(works.select(F.col("doi").alias("doi_extracted"), "canonical"), "doi_extracted", "left")
    d = d.join(picks.select("row_index", F.col("doi").alias("inferred"), "rule", F.col("score").alias("candidate_score")), "row_index", "left")
    own, agency = F.col("doi_extracted") != "", F.coalesce("doi_agency", F.lit(""))
    nothing = ~own & (F.trim(T.blank(F.col("title"))) == "")
    taken = F.coalesce(F.col("rule") != "none", F.lit(False))
    status = F.when(nothing, "invalid_input").when(own & (agency == "crossref"), "canonicalized_crossref").when(own & (agency != ""), "canonicalized_non_crossref").when(taken, "inferred_crossref").when(F.col("inferred").isNotNull(), "needs_review").otherwise("not_found")
    method = F.when(status.startswith("canonicalized"), "doi").when(status == "inferred_crossref", F.col("rule")).otherwise("none")
    canonical = F.when(status.startswith("canonicalized"), F.coalesce("canonical", "doi_extracted")).when(status == "inferred_crossref", F.col("inferred")).otherwise("")
    return d.select("row_index", "doi_extracted", canonical.alias("doi_canonical"), agency.alias("doi_agency"), status.alias("doi_status"), method.alias("doi_match_method"))


def fill_from_work(rows: DataFrame, works: DataFrame) -> DataFrame:
    """Blanks of rows filled from the looked-up work."""
    cols = ("title", "author", "year", "container")
    j = rows.join(works.select("doi", *[F.col(c).alias(f"w_{c}") for c in cols]), "doi", "left")
    return j.select("row_index", "doi", *[F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.col(f"w_{c}"), F.lit("")).alias(c) for c in cols])


def counts(resolved: DataFrame) -> DataFrame:
    """Rows by status, by method and by agency (none: unknown), in one pass of grouping sets."""
    d = resolved.select(F.col("doi_status").alias("status"), F.col("doi_match_method").alias("method"), F.coalesce(F.nullif("doi_agency", F.lit("")), F.lit("unknown")).alias("agency"))
    g = d.groupingSets([["status"], ["method"], ["agency"]], "status", "method", "agency").agg(F.count("*").alias("n"), F.grouping_id("status", "method", "agency").alias("g"))
    return g.select(F.when(F.col("g") == 3, "status").when(F.col("g") == 5, "method").otherwise("agency").alias("kind"), F.coalesce("status", "method", "agency").alias("key"), "n")


def keep_first(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c != key]), order).alias("r")).select(key, "r.*")


def fetch_ready(resolved: DataFrame) -> DataFrame:
    """First row of each canonical DOI whose status allows fetching."""
    return keep_first(resolved.where(F.col("doi_status").isin(*READY) & (F.trim("doi_canonical") != "")).select("doi_canonical", "row_index", "doi_status"), "doi_canonical", "row_index")


def failed(report: DataFrame) -> DataFrame:
    return report.where(~F.col("status").isin(*DONE))


def download_index(report: DataFrame) -> DataFrame:
    """Last file of each DOI that was fetched."""
    return report.where(F.col("status").isin(*DONE) & (T.blank(F.col("file_path")) != "")).groupBy("doi").agg(F.max_by("file_path", "seq").alias("file_path"))


def message_kind(c: Column) -> Column:
    """What a service's message says: hard_failure, searching, request, file or other."""
    t = F.lower(T.blank(c))
    return F.when(t.rlike("not found|unavailable|no results|cannot"), "hard_failure").when(t.rlike("searching|please wait|looking"), "searching").when(t.rlike("request"), "request").when(t.rlike(r"\.pdf\b"), "file").otherwise("other")


def links(html: Column) -> Column:
    """Targets of a page's links, frames and objects without fragments, in order, once."""
    found = F.concat(*[F.regexp_extract_all(T.blank(html), F.lit(p), F.lit(1)) for p in (r'(?i)<a\s[^>]*?href="([^"]+)"', r'(?i)<iframe\s[^>]*?src="([^"]+)"', r'(?i)<object\s[^>]*?data="([^"]+)"', r'(?i)"([^"\s]+\.pdf)(?:[?#][^"]*)?"')])
    return F.array_distinct(F.filter(F.transform(found, lambda x: F.regexp_replace(x, "#.*$", "")), lambda x: x != ""))


def landing_metadata(html: Column) -> Column:
    """struct(title, first_author, year, container): citation_ tags, then dc., then linked data."""
    tags = F.regexp_extract_all(T.blank(html), F.lit(r"(?i)(<meta\s+[^>]*>)"), F.lit(1))
    pairs = F.transform(tags, lambda t: F.struct(F.lower(F.regexp_extract(t, r"(?i)(?:name|property)\s*=\s*['\"]([^'\"]*)['\"]", 1)).alias("k"), F.trim(F.regexp_extract(t, r"(?i)content\s*=\s*['\"]([^'\"]*)['\"]", 1)).alias("v")))

    def tag(name: str) -> Column:
        return F.nullif(F.get(F.filter(pairs, lambda p: p["k"] == name), F.lit(0))["v"], F.lit(""))

    def meta(*names: str) -> Column:
        return F.coalesce(*map(tag, names), F.lit(None).cast("string"))

    ld = F.from_json(F.regexp_extract(T.blank(html), r"(?is)<script[^>]*type=['\"]application/ld\+json['\"][^>]*>(.*?)</script>", 1), "name string, headline string, datePublished string, author array<struct<name:string>>, isPartOf struct<name:string>")
    year = lambda c: F.nullif(T.year_in(c), F.lit(""))
    none = F.lit("")
    return F.struct(
        F.coalesce(meta("citation_title", "dc.title"), ld["name"], ld["headline"], none).alias("title"),
        F.coalesce(meta("citation_author", "dc.creator"), F.get(ld["author"], F.lit(0))["name"], none).alias("first_author"),
        F.coalesce(year(meta("citation_publication_date", "citation_date")), year(meta("dc.date")), year(ld["datePublished"]), none).alias("year"),
        F.coalesce(ld["isPartOf"]["name"], none).alias("container"),
    )
