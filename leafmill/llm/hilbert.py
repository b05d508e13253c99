"""Approximate nearest neighbours: several shifted Hilbert orderings of projected vectors, range-partitioned in Spark.

Each of `curves` orderings projects vectors on `dims` random orthogonal directions, shifts and quantises the projections,
and takes the Hilbert key. repartitionByRange deals every ordering to blocks in key order: `block_rows` vectors each, or
a twentieth of all (16 at least) if that is less, so that small tables are searched along the curves too.
A query is compared, in double precision, with all rows of its own block and of the blocks around it that make up
`window` of the ordering; its candidates from all orderings are merged and the nearest kept.

How much an ordering must hold depends on the data. On vectors without structure (the given ones are spread evenly over a
64-sphere but for near copies) no ordering concentrates neighbours much, so the window is a share of the data, not a
fixed count: recall then holds at every size. 12 curves with a tenth each give a recall over 0.95 there, comparing about
two thirds of all rows with a query; clustered data reach it with less.

A ranged block can be smaller or larger than asked, since Spark draws its bounds from a sample; windows count blocks.

Equal vectors are searched as one, and expanded to their k + 1 smallest ids, so ties go to smaller ids however many equal
vectors there are. Blocks bound memory: queries of a block are dealt to chunks where they are many.

Defined cases: vectors null, empty, zero or with null or non-finite components take no part, as query or candidate;
vectors of another length than the query's are no candidates; repeated ids count once, with their first vector; fewer
rows than k give all; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, per_group, table
from .vectors import matrix, usable

#: Documented bound of the sample from which the centre and spread of projections are taken.
SAMPLE_ROWS = 4000


def hilbert_key(x: np.ndarray, bits: int) -> np.ndarray:
    """Keys along the Hilbert curve of points with coordinates below 2 ** bits (dims * bits <= 62): Skilling's transform."""
    x = x.astype(np.int64).T.copy()
    d = len(x)
    for q in (1 << s for s in range(bits - 1, 0, -1)):
        for i in range(d):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(on, q - 1, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for q in (1 << s for s in range(bits - 1, 0, -1)):
        t ^= np.where((x[-1] & q) != 0, q - 1, 0)
    x ^= t
    key = np.zeros_like(t)
    for s in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> s) & 1)
    return key


def orderings(dim: int, curves: int, dims: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Projections (curves, dim, dims) and shifts (curves, dims) in cells' widths of the box."""
    rng = np.random.default_rng(seed + dim)
    dims = min(dims, dim)
    return np.stack([np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :dims] for _ in range(curves)]), rng.random((curves, dims))


def neighbours(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, curves: int = 12, dims: int = 4, bits: int = 8, window: float = 0.1, block_rows: int = 2048, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row that is_query picks, by Euclidean distance."""
    d = usable(df, id_col, vec_col, F.coalesce(is_query, F.lit(False)).alias("q"))
    d = cut(d.groupBy("vec_id").agg(F.min_by("v", F.to_json("v")).alias("v"), F.max("q").alias("q")) if df.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").head(1) else d)
    kind = d.schema["v"].dataType.simpleString()
    ranked = d.select("vec_id", "v", F.row_number().over(Window.partitionBy("v").orderBy("vec_id")).alias("r")).where(F.col("r") <= k + 1)
    ranked = cut(ranked.withColumn("rep", F.min("vec_id").over(Window.partitionBy("v"))))
    reps = ranked.where("r = 1").select("vec_id", "v")
    sample = reps.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r.v), []).append(r.v)
    spread = {n: (matrix(vs).mean(axis=0), float(matrix(vs).std()) or 1.0) for n, vs in by_dim.items()}

    def key(frames):
        for f in frames:
            for dim, g in f.groupby(f["v"].map(len)):
                turns, shifts = orderings(dim, curves, dims)
                centre, sd = spread.get(dim, (np.zeros(dim), 1.0))
                x = matrix(g["v"]) - centre
                made = []
                for c in range(curves):
                    y = x @ turns[c] / (8 * sd) + 0.5 + (shifts[c] - 0.5) / 5
                    cell = np.clip(np.floor(y * (1 << bits)), 0, (1 << bits) - 1)
                    made.append(pd.DataFrame({"dim": dim, "curve": c, "key": hilbert_key(cell, bits), "vec_id": g["vec_id"].to_numpy()}))
                yield pd.concat(made, ignore_index=True)

    n = reps.count()
    parts = curves * max(1, -(-n // min(block_rows, max(16, -(-n // 20)))))
    order = ["dim", "curve", "key", "vec_id"]
    keyed = reps.mapInPandas(key, "dim int, curve int, key long, vec_id long").repartitionByRange(parts, *order)
    keyed = cut(keyed.withColumn("block", F.spark_partition_id()).select("dim", "curve", "vec_id", "block"))
    span = keyed.groupBy("dim", "curve").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    half = F.ceil((F.col("high") - F.col("low") + 1) * F.lit(window / 2)).cast("int")
    span = cut(span.withColumn("half", half))

    queries = d.where("q").select(F.col("vec_id").alias("query_id"), "v").join(ranked.where("r = 1").select("v", "rep"), "v")
    queries = cut(queries)
    placed = queries.join(keyed.withColumnRenamed("vec_id", "rep"), "rep").join(span, ["dim", "curve"])
    near = F.sequence(F.greatest("low", F.col("block") - F.col("half")), F.least("high", F.col("block") + F.col("half")))
    placed = placed.select("query_id", "v", "dim", F.explode(near).alias("block"))
    load = cut(placed.groupBy("block").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("chunks")))
    asked = placed.join(load, "block").select("block", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int").alias("chunk"), F.lit(True).alias("q"), F.col("query_id").alias("id"), "v")
    held = keyed.select("block", "vec_id").join(load, "block").join(reps, "vec_id")
    held = held.select("block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(False).alias("q"), F.col("vec_id").alias("id"), "v")

    def search(g: pd.DataFrame) -> pd.DataFrame | None:
        out = []
        for _, h in g.groupby(g["v"].map(len)):
            rows, asks = h[~h["q"]], h[h["q"]].drop_duplicates("id")
            if not len(rows) or not len(asks):
                continue
            x, ids = matrix(rows["v"]), rows["id"].to_numpy()
            x, ids = x[(o := np.argsort(ids, kind="stable"))], ids[o]
            for q, v in zip(asks["id"], asks["v"]):
                far = np.sqrt(((x - np.asarray(v, np.float64)) ** 2).sum(axis=1))
                best = np.argsort(far, kind="stable")[: k + 1]
                out.append(pd.DataFrame({"query_id": q, "rep": ids[best], "score": far[best]}))
        return pd.concat(out, ignore_index=True) if out else None

    found = per_group(asked.unionByName(held), ["block", "chunk"], ["id"], search, "query_id long, rep long, score double")
    found = found.groupBy("query_id", "rep").agg(F.min("score").alias("score"))
    found = found.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "rep"))).where(F.col("r") <= k + 1).drop("r")
    out = found.join(ranked.select("rep", "vec_id"), "rep").where("vec_id <> query_id")
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def op5_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES = {"op5_hilbert": op5_hilbert}
SQL: dict[str, str] = {}
