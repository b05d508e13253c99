"""Sources: explicit schemas, lenient JSON lines, CSV with aliased columns, page and table files, PDFs by content, TEI, boundary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse
from ..functions import text as T
from ..operators.structure import coordinates, json_objects

# Column names under which bibliographic tables come, by what they hold.
ALIASES = {
    "doi": ("doi", "doi_raw"),
    "url": ("url", "url_landing", "landing_url", "link"),
    "title": ("title", "paper_title"),
    "author": ("first_author", "authors_first_last", "author", "authors"),
    "year": ("year", "publication_year"),
    "container": ("journal_or_repository", "container_title", "journal"),
}

#: What the engine takes from outside programs and services as tables: name -> schema.
BOUNDARY = {
    "page_spans": "doc_id string, page int, block int, line int, span int, type int, text string, bbox array<double>",
    "layout_blocks": "doc_id string, payload string",
    "tei_docs": "doc_id string, tei_xml string",
    "http_cache": "cache_key string, status int, body string, headers map<string,string>, error string",
    "crossref_agency": "doi string, agency string",
    "crossref_works": "doi string, canonical string, title string, author string, year string, container string",
    "crossref_search_items": "query_key string, variant int, rank int, DOI string, title array<string>, author array<struct<family:string,name:string>>, issued struct<date_parts:array<array<int>>>, type string, container_title array<string>",
    "model_responses": "request_key string, content string, attempt int, prompt_tokens long, completion_tokens long",
    "chart_extractions": "doc_id string, figure_id string, stdout string",
    "structure_payloads": "table_id string, payload string",
    "page_images": "doc_id string, page int, route string, width_pt double, height_pt double",
    "table_crops": "doc_id string, table_id string, path string",
}


def boundary(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A boundary table (Parquet) under its fixed schema; missing columns are null, so older tables still read."""
    return spark.read.schema(BOUNDARY[name]).parquet(f"{path}/{name}")


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects of JSON lines under an explicit schema; blank, broken and other lines are dropped."""
    rows = json_objects(spark.read.text(path), "value")
    return rows.select(F.from_json("value", schema).alias("r")).select("r.*")


def json_object(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row from a file with a JSON object; all null if it is broken or something else."""
    d = spark.read.text(path, wholetext=True)
    return d.select(F.when(T.is_json_object(F.trim("value")), F.from_json("value", schema)).alias("r")).select("r.*")


def resolve_columns(names: list[str], overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Column of each kind: the override, which must be there, or the first alias found, whatever its case."""
    found: dict[str, str] = {}
    for n in names:
        found.setdefault(n.strip().lstrip("﻿").lower(), n)
    out = {}
    for kind, aliases in ALIASES.items():
        asked = (overrides or {}).get(kind)
        if asked and asked.strip().lower() not in found:
            raise ValueError(f"no column {asked!r} in the input")
        out[kind] = found[asked.strip().lower()] if asked else next((found[a] for a in aliases if a in found), "")
    return out


def bibliographic_csv(spark: SparkSession, path: str, overrides: dict[str, str] | None = None) -> DataFrame:
    """(row_index, doi_raw, url_raw, title, author, year, container) of a CSV with a header."""
    d = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    d = d.toDF(*[c.lstrip("﻿") for c in d.columns])
    at = resolve_columns(d.columns, overrides)
    pick = lambda k: F.trim(T.blank(F.col(f"`{at[k]}`"))) if at[k] else F.lit("")
    return d.select(F.monotonically_increasing_id().alias("row_index"), pick("doi").alias("doi_raw"), pick("url").alias("url_raw"), pick("title").alias("title"), T.first_author(pick("author")).alias("author"), T.year_in(pick("year")).alias("year"), pick("container").alias("container"))


def doi_csv(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(doi, original): normalised DOIs of one column, first spelling kept."""
    d = spark.read.option("header", True).csv(path)
    d = d.toDF(*[c.lstrip("﻿") for c in d.columns]).select(F.monotonically_increasing_id().alias("row_index"), F.col(column).alias("original"))
    d = d.withColumn("doi", T.normalize_doi(F.col("original"))).where("doi <> ''")
    return d.groupBy("doi").agg(F.min_by("original", "row_index").alias("original"))


def _path() -> Column:
    return F.col("_metadata.file_path")


def page_markdown(spark: SparkSession, root: str) -> DataFrame:
    """(doc, page, text) of <doc>/pages/<number>.md under root; other names are no pages."""
    d = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True).select(_path().alias("path"), F.col("value").alias("text"))
    return d.where(F.col("path").rlike(r"/pages/[0-9]+\.md$")).select(F.regexp_extract("path", r"([^/]+)/pages/[0-9]+\.md$", 1).alias("doc"), F.regexp_extract("path", r"/([0-9]+)\.md$", 1).cast("int").alias("page"), "text")


def document_folders(spark: SparkSession, root: str, named: bool = False) -> DataFrame:
    """Folders with metadata/manifest.json and pages/ (or, named, whose name starts with doc_)."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    if named:
        return d.select(F.regexp_extract("path", r"^(.*/doc_[^/]*)/", 1).alias("folder")).where("folder <> ''").distinct()
    has = d.where(F.col("path").endswith("/metadata/manifest.json")).select(F.regexp_replace("path", "/metadata/manifest.json$", "").alias("folder"))
    pages = d.where(F.col("path").rlike("/pages/[^/]+$")).select(F.regexp_replace("path", "/pages/[^/]+$", "").alias("folder"))
    return has.join(pages, "folder", "left_semi").distinct()


def ocr_tables(spark: SparkSession, root: str) -> DataFrame:
    """(page, ordinal, headers, rows) of table_<ordinal>_page_<page>.md files: an HTML grid, else the first markdown table."""
    from ..functions import grid as G

    d = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True).select(_path().alias("path"), F.col("value").alias("t"))
    d = d.where(F.lower("path").rlike(r"table_[0-9]+_page_[0-9]+\.md$"))
    d = d.withColumn("g", parse.html_grid("t")).withColumn("m", F.get(parse.markdown_tables("t"), F.lit(0)))
    none = F.array().cast("array<array<string>>")
    html = (F.size("g.header_rows") > 0) | (F.size("g.data_rows") > 0)
    only_heads = (F.size("g.data_rows") == 0) & (F.size("g.header_rows") > 1)
    clean = lambda c: F.transform(c, lambda r: F.transform(r, T.cell_text))
    heads = F.when(only_heads, F.transform(F.get("g.header_rows", F.lit(0)), T.cell_text)).when(html, G.collapse_headers(F.col("g.header_rows"))).otherwise(F.coalesce("m.headers", F.array().cast("array<string>")))
    rows = F.when(only_heads, clean(F.slice("g.header_rows", 2, 1 << 20))).when(html, clean(F.col("g.data_rows"))).otherwise(F.coalesce("m.rows", none))
    return d.select(F.regexp_extract(F.lower("path"), r"_page_([0-9]+)\.md$", 1).cast("int").alias("page"), F.regexp_extract(F.lower("path"), r"table_([0-9]+)_page", 1).cast("int").alias("ordinal"), heads.alias("headers"), rows.alias("rows"))


def pdf_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, sha256, doc_id, name, grp) of PDF files by any case of the suffix; ids come from the content."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).where(F.lower("path").endswith(".pdf"))
    sha, s = F.sha2("content", 256), F.split("path", "/")
    stem = F.regexp_replace(F.element_at(s, -1), r"(?i)\.pdf$", "")
    return d.select("path", sha.alias("sha256"), F.substring(sha, 1, 12).alias("doc_id"), T.safe_name(stem, F.substring(sha, 1, 12)).alias("name"), T.safe_name(F.element_at(s, -2), F.lit("root")).alias("grp"))


def tei(docs: DataFrame) -> DataFrame:
    """docs (doc_id, tei_xml) with title, authors ('Surname, Given'), year and the figure index (type, label, caption, coordinates)."""
    x = F.regexp_replace("tei_xml", r'\sxmlns(?::\w+)?="[^"]*"', "")
    one = lambda p: F.trim(T.blank(F.xpath_string(x, F.lit(p))))
    many = lambda p: F.xpath(x, F.lit(p))
    names = F.transform(F.arrays_zip(many("//analytic/author/persName/surname/text()").alias("s"), many("//analytic/author/persName/forename[1]/text()").alias("g")), lambda a: F.concat_ws(", ", a["s"], a["g"]))
    figs = F.transform(F.arrays_zip(many("//figure/head/text()").alias("h"), many("//figure/@coords").alias("c")), lambda f: F.struct(f["h"].alias("label"), coordinates(f["c"]).alias("coords")))
    return docs.select("doc_id", one("//titleStmt/title").alias("title"), names.alias("authors"), T.year_in(one("//publicationStmt/date/@when")).alias("year"), many("//body/div/head/text()").alias("sections"), figs.alias("figures"))


def cached_http(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """requests (method, url) answered from the cache table; a miss has status 0. Nothing is fetched."""
    key = F.concat_ws(" ", F.upper("method"), "url")
    return requests.withColumn("cache_key", key).join(cache, "cache_key", "left").withColumn("from_cache", F.col("status").isNotNull()).na.fill(0, ["status"])


def chart_output(rows: DataFrame) -> DataFrame:
    """stdout of a chart reader as kind (object, raw, raw_text) and text."""
    t = F.trim(T.blank(F.col("stdout")))
    kind = F.when(T.is_json_object(t), "object").when(F.try_parse_json(t).isNotNull(), "raw").otherwise("raw_text")
    return rows.withColumn("kind", kind).withColumn("text", t)


def unwrap_structure(rows: DataFrame) -> DataFrame:
    from ..operators.structure import structure

    return rows.select("table_id", structure(F.col("payload")).alias("s")).select("table_id", "s.*")
