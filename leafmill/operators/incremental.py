"""Incremental work: what is left to do, what became of it, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def pending(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows not yet done under the same keys (an id and a content hash, say)."""
    return wanted.join(done.select(*keys), keys, "left_anti")


def is_problem(status: Column) -> Column:
    return F.lower(F.trim(T.blank(status))) != "ok"


def upsert(manifest: DataFrame, update: DataFrame, key: str) -> DataFrame:
    """Manifest with update's columns where its key is there, and new keys added."""
    cols = [c for c in update.columns if c != key]
    u = update.select(key, *[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_u"))
    j = manifest.join(u, key, "full_outer")
    return j.select(key, *[F.when(F.col("_u"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in manifest.columns if c != key])


def artifact_counts(expected: DataFrame, existing: DataFrame, crops: DataFrame, failed: DataFrame, key: str = "table_id") -> DataFrame:
    """(status, n) of expected artifacts: skipped if there, missing_crop without input, failed or generated."""
    mark = lambda d, name: d.select(key, F.lit(True).alias(name)).distinct()
    j = expected.join(mark(existing, "_e"), key, "left").join(mark(crops, "_c"), key, "left").join(mark(failed, "_f"), key, "left")
    status = F.when(F.col("_e"), "skipped").when(F.col("_c").isNull(), "missing_crop").when(F.col("_f"), "failed").otherwise("generated")
    return j.groupBy(status.alias("status")).agg(F.count("*").alias("n"))
