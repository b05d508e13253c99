"""Subcommands over Parquet tables: python -m leafmill COMMAND --help."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _export(spark: SparkSession, a: argparse.Namespace) -> int:
    from .plans.export import export

    read = spark.read.parquet
    e = export(read(a.layout), read(a.pages), read(a.ocr), read(a.reference) if a.reference else None, escalate=a.table_escalation_max, strict=a.table_qa_mode == "strict")
    for name in ("tables", "flags", "status", "facts"):
        getattr(e, name).write.mode("overwrite").parquet(f"{a.out}/{name}")
    return int(not spark.read.parquet(f"{a.out}/status").where("status = 'error'").isEmpty())


def _facts(spark: SparkSession, a: argparse.Namespace) -> int:
    from .operators import facts

    facts.from_tables(spark.read.parquet(a.tables)).write.mode("overwrite").parquet(a.out)
    return 0


def _eval(spark: SparkSession, a: argparse.Namespace) -> int:
    from .operators import evaluate

    m = evaluate.metrics(spark.read.parquet(a.gold), spark.read.parquet(a.pred))
    m.write.mode("overwrite").json(f"{a.out}/metrics")
    if not a.baseline:
        return 0
    found = evaluate.regression(spark.read.json(f"{a.out}/metrics", schema=m.schema), spark.read.json(a.baseline, schema="precision double, recall double"))
    found.write.mode("overwrite").json(f"{a.out}/violations")
    return int(a.strict_regression and not spark.read.json(f"{a.out}/violations", schema=found.schema).isEmpty())


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, is_dir) under root: files, and the folders that hold any; empty folders are not seen."""
    top = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    files = top.select(F.regexp_extract("path", "^.*?" + r"\Q" + root.rstrip("/") + r"\E/(.*)$", 1).alias("path")).where("path <> ''")
    parts = files.select(F.split("path", "/").alias("s")).where("size(s) > 1")
    dirs = parts.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("s") - 1), lambda n: F.array_join(F.slice("s", 1, n), "/"))).alias("path")).distinct()
    return files.withColumn("is_dir", F.lit(False)).unionByName(dirs.withColumn("is_dir", F.lit(True)))


def _audit(spark: SparkSession, a: argparse.Namespace) -> int:
    from .operators import audit

    found = listing(spark, a.root)
    issues = audit.audit(found)
    issues.write.mode("overwrite").json(f"{a.out}/issues")
    audit.report(spark.read.json(f"{a.out}/issues", schema=issues.schema), found).write.mode("overwrite").json(f"{a.out}/report")
    return int(a.strict and not spark.read.json(f"{a.out}/issues", schema=issues.schema).where("severity = 'error'").isEmpty())


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="leafmill")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, about: str, *needed: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=about)
        for n in needed:
            c.add_argument(f"--{n}", required=True)
        c.set_defaults(run=run)
        return c

    c = command("export-structured-data", _export, "layout, pages and OCR tables to tables, flags, status and facts", "layout", "pages", "ocr", "out")
    c.add_argument("--reference")
    c.add_argument("--table-escalation-max", type=int, default=20)
    c.add_argument("--table-qa-mode", choices=["warn", "strict"], default="warn")
    command("export-facts", _facts, "facts of tables (doc_id, table_id, page, caption, headers, rows)", "tables", "out")
    c = command("eval-table-pipeline", _eval, "metrics of predicted tables beside gold ones", "gold", "pred", "out")
    c.add_argument("--baseline")
    c.add_argument("--strict-regression", action="store_true")
    c = command("data-audit", _audit, "layout of a data folder", "root", "out")
    c.add_argument("--strict", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [root, os.environ.get("PYTHONPATH", "")]))
    return a.run(SparkSession.builder.appName("leafmill").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
