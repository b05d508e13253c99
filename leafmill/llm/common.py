"""Shared helpers of the corpus operators: lineage cuts, size-checked broadcasts, grouped streaming, hashed prefix sums."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows up to which a narrow table may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
#: And the bytes of such a table.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, taken: Sequence[str]) -> str:
    """name, with underscores at its end while a column is called so (Spark's names don't differ by case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Rows go to Python in batches of few bytes, however long texts are: several copies of a batch live at once."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) != f"{most}b":
        spark.conf.set(name, f"{most}b")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that the cluster names in spark.checkpoint.dir.

    Where that is unset, a temp folder does for a local master; elsewhere executors could not read it, so it is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="leafmill-"))
    return df.checkpoint()


def few(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether df has at most so many rows and, by its columns' lengths, so many bytes."""
    long = [F.coalesce(F.octet_length(F.col(f"`{c}`") if t in ("string", "binary") else F.to_json(F.struct(f"`{c}`"))), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary") or t[:5] in ("array", "map<s", "struc")]
    width = sum(long, F.lit(16 * len(df.columns)))
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return r.n <= rows and r.b <= size


def with_small(df: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left", most: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a table that is broadcast only if its counted rows and bytes are few; else Spark shuffles (and splits skew)."""
    return df.join(F.broadcast(small) if few(small, most) else small, on, how)


def groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of equal keys in a stream of frames sorted by them; a run may span frames."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        change = np.zeros(len(frame), bool)
        for v in (frame[k].to_numpy() for k in keys):
            change[1:] |= v[1:] != v[:-1]
        change[0] = bool(held) and tuple(held[-1][keys].iloc[-1]) != tuple(frame[keys].iloc[0])
        at = [0, *change.nonzero()[0].tolist(), len(frame)]
        for a, b in zip(at, at[1:]):
            if change[a] and held:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            if b > a:
                held.append(frame.iloc[a:b])
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def per_group(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """fn for each bounded group of equal keys, streamed through sorted partitions (no Arrow batch for each group).

    Rows are dealt by a hash of the keys, not by the keys: a shuffle by columns that a join below has dealt by already is
    left out of the plan, and adaptive execution may then read that join's rows as they lie, which cuts groups apart.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, n = [], 0
        for g in groups(frames, keys):
            if (r := fn(g)) is not None and len(r):
                out.append(r)
                n += len(r)
            if n >= 20_000:
                yield pd.concat(out, ignore_index=True)
                out, n = [], 0
        if out:
            yield pd.concat(out, ignore_index=True)

    dealt = df.withColumn("_lm_g", F.xxhash64(*keys)).repartition("_lm_g").drop("_lm_g")
    return dealt.sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def hash_bucket(h: Column, n: Column) -> Column:
    """Which of n (1 or more) equal ranges of the unsigned hash h (a long) falls in; keeps the order of the hash."""
    u = F.shiftrightunsigned(h, 33).cast("double")  # 31 bits
    return F.least(F.floor(u / F.lit(2.0**31) * n), n - 1).cast("long")


def prefix_by_bucket(df: DataFrame, group: list[str], bucket: str, order: list[Column], size: Column, start: str) -> DataFrame:
    """start: sum of size over the rows of the group that come before, by bucket then order.

    Buckets are summed first and only those sums are windowed over a whole group, so that a group of any share of the
    rows is spread over many tasks.
    """
    d = df.withColumn("_lm_size", size)
    sums = d.groupBy(*group, bucket).agg(F.sum("_lm_size").alias("_lm_sum"))
    over = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = cut(sums.select(*group, bucket, F.coalesce(F.sum("_lm_sum").over(over), F.lit(0)).cast("long").alias("_lm_before")))
    within = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_lm_in", F.coalesce(F.sum("_lm_size").over(within), F.lit(0)).cast("long"))
    j = with_small(d, sums, [*group, bucket])
    return j.withColumn(start, F.col("_lm_before") + F.col("_lm_in")).drop("_lm_size", "_lm_before", "_lm_in")


def _union_find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = y
        return x

    for f in frames:
        for u, v in zip(f["u"].tolist(), f["v"].tolist()):
            a, b = top(u), top(v)
            if a != b:
                up[max(a, b)] = min(a, b)
    nodes = list(up)
    yield pd.DataFrame({"node": nodes, "component": [top(x) for x in nodes]}, dtype="int64")


#: Edges up to which one task joins them; a task holds a few tens of bytes for each.
ONE_TASK_EDGES = 200_000


def components(edges: DataFrame, one_task: int = ONE_TASK_EDGES) -> DataFrame:
    """(node, component = smallest id reachable) for the ends of edges (a, b: longs).

    Edges are made distinct and counted. Few of them are joined by union-find in one task; more by alternating large and
    small stars, each round a grouped minimum and a join, cut by a checkpoint. Both are exact.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e, before = cut(e), None
    if e.count() <= one_task:
        return cut(e.coalesce(1).mapInPandas(_union_find, "node long, component long"))
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = cut(small)
        # a fixed point: one star for each component, that is, each node is named once and no centre hangs from another
        row = e.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if before == (row.n, row.h):
            break
        before = (row.n, row.h)
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
