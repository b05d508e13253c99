"""Sinks: JSON lines, text, CSV, bundles by document, reports, indexes, run-scoped snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.doi import download_index, failed
from ..operators.pages import index_head

# The columns of a resolution's result, in order.
RESOLVED = ("row_index", "doi_raw", "url_raw", "title", "first_author", "year", "container_title", "doi_extracted", "doi_canonical", "doi_agency", "doi_status", "doi_match_method", "doi_confidence", "doi_match_notes")


def jsonl(df: DataFrame, path: str) -> None:
    """One object a line; characters outside ASCII escaped."""
    df.write.mode("overwrite").option("ignoreNullFields", False).option("writeNonAsciiCharacterAsCodePoint", True).json(path)


def text(df: DataFrame, column: str, path: str, by: list[str] | None = None) -> None:
    d = df.select(*(by or []), F.col(column).alias("value"))
    (d.write.partitionBy(*by) if by else d.write).mode("overwrite").text(path)


def group_index(entries: DataFrame, group: str, path: str) -> None:
    """Index text by group: head first, then entries by folder name; large groups are files in the order of their names, each sorted."""
    d = entries.select(F.col(group).alias("_group"), F.lit(1).alias("_at"), "folder_name", "entry")
    heads = entries.select(F.col(group).alias("_group")).distinct().select("_group", F.lit(0).alias("_at"), F.lit("").alias("folder_name"), index_head(F.col("_group").cast("string")).alias("entry"))
    d = d.unionByName(heads).repartitionByRange("_group", "_at", "folder_name").sortWithinPartitions("_group", "_at", "folder_name")
    d.select(F.col("_group").alias(group), F.col("entry").alias("value")).write.partitionBy(group).mode("overwrite").text(path)


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def resolved_csv(df: DataFrame, path: str) -> None:
    """Fixed columns, blanks where df has none."""
    csv(df.select(*[T.blank(F.col(c).cast("string")).alias(c) if c in df.columns else F.lit("").alias(c) for c in RESOLVED]), path)


def table_cells(grids: DataFrame, path: str) -> None:
    """All tables in long form, one partition folder a document: tables' column sets differ, so cells are rows."""
    d = grids.select("doc", "table_id", F.posexplode(F.concat(F.array("headers"), "rows")).alias("row", "cells")).select("doc", "table_id", "row", F.posexplode("cells").alias("col", "text"))
    d.withColumn("text", T.cell_text(F.col("text"))).repartition("doc").write.mode("overwrite").partitionBy("doc").parquet(path)


def snapshot(df: DataFrame, path: str, run_id: str, phase: str) -> None:
    """What a run read or wrote, kept apart by run and phase."""
    df.withColumn("run_id", F.lit(run_id)).withColumn("phase", F.lit(phase)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "phase").parquet(path)


def fetch_reports(report: DataFrame, path: str) -> None:
    """All rows, those to retry, and the index of files."""
    csv(report, f"{path}/report")
    csv(failed(report), f"{path}/failed")
    csv(download_index(report), f"{path}/index")


def documents(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Pages as Parquet by document, clustered so that a document is one file."""
    pages.repartition("doc").sortWithinPartitions("doc", "page").write.mode(mode).parquet(path)
