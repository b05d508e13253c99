"""Audit of a data folder's layout over a listing (path, is_dir)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The layout.
TOP = ("archive", "cache", "corpora", "jobs", "tmp")
TOP_FILES = ("README.md",)
CORPUS = ("source_pdfs", "metadata", "notes")
JOB_NEEDS = ("pdfs", "reports")
JOB = ("input", "pdfs", "reports", "ocr_out", "logs")
SLUG = "^[a-z0-9][a-z0-9_-]*$"


def audit(listing: DataFrame) -> DataFrame:
    """Issues (code, path, severity): each rule is a filter of the listing; what must be there is an anti join."""
    p = listing.select("path", "is_dir", F.split("path", "/").alias("s")).withColumn("n", F.size("s"))
    at = lambda i: F.get("s", F.lit(i))

    def issue(d: DataFrame, code: str, severity: str = "error", path: Column | str = "path") -> DataFrame:
        return d.select(F.lit(code).alias("code"), (F.col(path) if isinstance(path, str) else path).alias("path"), F.lit(severity).alias("severity"))

    dirs, files, seen = p.where("is_dir"), p.where("NOT is_dir"), ~at(0).startswith(".")
    top = dirs.where((F.col("n") == 1) & seen)
    corpora, jobs = dirs.where((F.col("n") == 2) & (at(0) == "corpora")), dirs.where((F.col("n") == 2) & (at(0) == "jobs"))
    in_corpus, in_job = dirs.where((F.col("n") == 3) & (at(0) == "corpora")), dirs.where((F.col("n") == 3) & (at(0) == "jobs"))
    spark = listing.sparkSession
    pdf = files.where(F.lower("path").endswith(".pdf"))

    def lacking(parents: DataFrame, need: tuple[str, ...]) -> DataFrame:
        want = parents.select("path", F.explode(F.array(*map(F.lit, need))).alias("need"))
        have = dirs.select(F.col("path").alias("_have"))
        return want.join(have, F.concat_ws("/", "path", "need") == F.col("_have"), "left_anti")

    misplaced = (
        F.when(F.col("n") < 2, True).when(at(0) == "corpora", (F.col("n") < 4) | (at(2) != "source_pdfs")).when(at(0) == "jobs", (F.col("n") < 4) | ~at(2).isin("pdfs", "ocr_out")).otherwise(~at(0).isin("archive", "cache", "tmp"))
    )
    need_top = spark.createDataFrame([(t,) for t in TOP], "path string").join(top.select("path"), "path", "left_anti")
    parts = [
        issue(top.where(~at(0).isin(*TOP)), "unexpected_top_level_dir"),
        issue(files.where((F.col("n") == 1) & seen & ~at(0).isin(*TOP_FILES)), "unexpected_top_level_file"),
        issue(need_top, "missing_top_level_dir", "warning"),
        issue(corpora.unionByName(jobs).where(~at(1).rlike(SLUG)), "invalid_slug"),
        issue(lacking(corpora, ("source_pdfs",)), "missing_source_pdfs_dir"),
        issue(in_corpus.where(~at(2).isin(*CORPUS)), "unexpected_corpus_subdir", "warning"),
        issue(lacking(jobs, JOB_NEEDS), "missing_job_subdir"),
        issue(in_job.where(~at(2).isin(*JOB)), "unexpected_job_subdir", "warning"),
        issue(files.where((F.col("n") == 3) & (at(0) == "jobs")), "unexpected_job_file", "warning"),
        issue(in_job.where(at(2).isin("input", "ocr_out")), "deprecated_job_subdir", "warning"),
        issue(pdf.where(misplaced), "misplaced_pdf"),
        issue(pdf.where((F.col("n") >= 4) & (at(0) == "jobs") & (at(2) == "ocr_out")), "deprecated_job_ocr_out_pdf", "warning"),
    ]
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d)
    return out


def report(issues: DataFrame, listing: DataFrame) -> DataFrame:
    """One row: errors, warnings, PDFs."""
    pdfs = listing.where("NOT is_dir").where(F.lower("path").endswith(".pdf")).agg(F.count("*").alias("pdfs")).withColumn("_k", F.lit(1))
    return issues.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") != "error").alias("warnings")).withColumn("_k", F.lit(1)).join(pdfs, "_k").drop("_k")
