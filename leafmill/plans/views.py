"""Inputs of the registered queries, derived from the driver's tables by the same relations in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import let

PAGES_OF_A_DOC = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as pages: twenty ids make a document."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.expr(f"doc_id div {PAGES_OF_A_DOC}").alias("doc"), (F.col("doc_id") % PAGES_OF_A_DOC + 1).cast("int").alias("page"), "text", "lang", "source")


V_PAGE = f"v_page AS (SELECT doc_id // {PAGES_OF_A_DOC} AS doc, (doc_id % {PAGES_OF_A_DOC} + 1)::int AS page, text, lang, source FROM documents)"

HEADERS = ("Part", "Quantity (kg)", "Price (USD)", "Discount")


# Fixed value: what orders the rows of a table.
ROW_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity")


def _cells(of) -> Column:
    """Cells of a table row from its lineitem columns."""
    text = lambda c: of(c).cast("decimal(18,2)").cast("string")
    cells = F.array(F.concat(F.lit("P"), of("l_partkey").cast("string")), text("l_quantity"), F.when(of("l_partkey") % 5 == 0, "").otherwise(text("l_extendedprice")), text("l_discount"))
    return F.when(of("l_suppkey") % 9 == 0, F.slice(cells, 1, 3)).otherwise(cells)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's lines as numbers, in order, the first twice: one shuffle without a window; cells are written behind it."""
    l = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "table_id")
    lines = let(F.array_sort(F.collect_list(F.struct(*ROW_ORDER, "l_discount"))), lambda x: F.concat(F.slice(x, 1, 1), x))
    return l.groupBy("table_id", (F.col("table_id") % 7 + 1).cast("int").alias("page")).agg(lines.alias("lines"))


def v_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as table rows: one table an order; blanks, ragged rows and repeated rows by arithmetic on keys."""
    return _lines(spark, sf_dir).select("table_id", "page", F.posexplode_outer("lines").alias("idx", "line")).select("table_id", "page", "idx", _cells(lambda c: F.col("line")[c]).alias("cells"))


V_ROW = """v_line AS (
  SELECT l_orderkey AS table_id, (l_orderkey % 7 + 1)::int AS page,
         (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity))::int AS rn,
         CASE WHEN l_suppkey % 9 = 0 THEN list_slice(c, 1, 3) ELSE c END AS cells
  FROM (SELECT *, ['P' || l_partkey, l_quantity::decimal(18,2)::varchar, CASE WHEN l_partkey % 5 = 0 THEN '' ELSE l_extendedprice::decimal(18,2)::varchar END, l_discount::decimal(18,2)::varchar] AS c FROM lineitem)),
v_row AS (SELECT table_id, page, rn AS idx, cells FROM v_line UNION ALL SELECT table_id, page, 0, cells FROM v_line WHERE rn = 1)"""


def v_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows nested by table."""
    rows = F.transform("lines", lambda r: _cells(lambda c: r[c]))
    return _lines(spark, sf_dir).select("table_id", "page", rows.alias("rows"), F.array(*[F.lit(h) for h in HEADERS]).alias("headers"))


V_GRID = V_ROW + f", v_grid AS (SELECT table_id, page, list(cells ORDER BY idx) AS rows, {list(HEADERS)} AS headers FROM v_row GROUP BY table_id, page)"


def v_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as table fragments: a customer's orders are a document, in order of their keys over its pages."""
    o = table(spark, sf_dir, "orders")
    caption = F.concat(F.lit("Table "), (F.col("o_orderkey") % 3 + 1).cast("string"), F.when(F.col("o_orderpriority").startswith("1"), " (continued)").otherwise(": data"))
    return o.select(
        F.col("o_custkey").alias("doc"), F.expr("int(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + 1) div 2").cast("int").alias("page"), F.col("o_orderkey").alias("frag"),
        F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(caption).alias("caption"),
        F.array(F.lit("sample"), F.lower("o_orderstatus"), F.lower(F.substring("o_orderpriority", 3, 20))).alias("tokens"),
        (F.col("o_orderkey") % 4 == 0).alias("empty_body"),
    )


V_FRAGMENT = """v_fragment AS (
  SELECT o_custkey AS doc, ((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + 1) // 2)::int AS page, o_orderkey AS frag,
         CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'Table ' || (o_orderkey % 3 + 1) || CASE WHEN o_orderpriority LIKE '1%' THEN ' (continued)' ELSE ': data' END END AS caption,
         ['sample', lower(o_orderstatus), lower(substr(o_orderpriority, 3, 20))] AS tokens, o_orderkey % 4 = 0 AS empty_body
  FROM orders)"""

# Names of failure modes, by what blocks acceptance.
HARD_MODES = ("row_shift_or_merge", "column_shift_or_merge", "partial_table_extracted", "duplicate_or_hallucinated_rows", "missing_required_columns", "table_not_present")
MODES = (*HARD_MODES, "multi_level_header_loss", "header_misalignment", "symbol_or_unit_loss", "code_legend_unresolved", "split_table_continuation", "ocr_noise", "caption_mismatch", "other")


def v_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with labels as model reviews of tables."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    k = F.col("doc_id")
    share = lambda m, a: (F.col("n_chars") * a % m) / F.lit(float(m))
    modes = F.array(*[F.lit(m) for m in MODES])
    return d.select(
        F.expr(f"doc_id div {PAGES_OF_A_DOC}").alias("doc"), k.alias("table_id"),
        F.when(F.col("toxic") == 1, "reject").when(F.col("quality") == 1, "accept").when(k % 17 == 0, "maybe").otherwise("review").alias("action"),
        F.when(k % 13 == 0, "no").when(k % 29 == 0, "uncertain").when(k % 31 != 0, "yes").alias("presence"),
        share(101, 1).alias("quality"), (1 - share(103, 3)).alias("risk"), share(107, 5).alias("structural"), share(109, 7).alias("completeness"), share(113, 11).alias("units"), share(127, 13).alias("context"),
        F.when(k % 6 == 0, "fragile").when(k % 7 == 0, "failed").when(k % 2 == 0, "robust").otherwise("mostly_robust").alias("robustness"),
        F.filter(F.array(F.when(k % 3 == 0, F.get(modes, (k % len(MODES)).cast("int"))), F.when(k % 5 == 0, F.get(modes, (k * 7 % len(MODES)).cast("int")))), lambda x: x.isNotNull()).alias("modes"),
        F.when(k % 19 == 0, F.array(F.lit("units"))).otherwise(F.array().cast("array<string>")).alias("missing"),
    )


V_REVIEW = f"""v_review AS (
  SELECT doc_id // {PAGES_OF_A_DOC} AS doc, doc_id AS table_id,
    CASE WHEN toxic = 1 THEN 'reject' WHEN quality = 1 THEN 'accept' WHEN doc_id % 17 = 0 THEN 'maybe' ELSE 'review' END AS action,
    CASE WHEN doc_id % 13 = 0 THEN 'no' WHEN doc_id % 29 = 0 THEN 'uncertain' WHEN doc_id % 31 <> 0 THEN 'yes' END AS presence,
    (n_chars % 101) / 101.0::double AS quality, 1 - (n_chars * 3 % 103) / 103.0::double AS risk, (n_chars * 5 % 107) / 107.0::double AS structural,
    (n_chars * 7 % 109) / 109.0::double AS completeness, (n_chars * 11 % 113) / 113.0::double AS units, (n_chars * 13 % 127) / 127.0::double AS context,
    CASE WHEN doc_id % 6 = 0 THEN 'fragile' WHEN doc_id % 7 = 0 THEN 'failed' WHEN doc_id % 2 = 0 THEN 'robust' ELSE 'mostly_robust' END AS robustness,
    list_filter([CASE WHEN doc_id % 3 = 0 THEN {list(MODES)}[doc_id % {len(MODES)} + 1] END, CASE WHEN doc_id % 5 = 0 THEN {list(MODES)}[doc_id * 7 % {len(MODES)} + 1] END], lambda x: x IS NOT NULL) AS modes,
    CASE WHEN doc_id % 19 = 0 THEN ['units'] ELSE []::varchar[] END AS missing
  FROM documents LEFT JOIN labels USING (doc_id))"""
