"""Sharding: Karmarkar-Karp differencing of indivisible groups (rows of one text) into shards of near equal bytes.

Groups are measured by a grouped sum. Up to `most_items` items are differenced directly: the two partial partitions with
the largest spread are combined, oppositely ordered, until one is left. More items are first bundled: hashed chunks of
`chunk` items are differenced into `bundles` near equal bundles each, level by level, while heavy groups (over
1 / (64 x shards) of all bytes, hence a bounded number) stay items of their own. The item that a bundle becomes has no
more than a small share of a shard, so that the last differencing can still level the heavy groups; a hashed sample of
`sand` light groups stays unbundled at each level, which lets it level the last bytes.

Defined cases: null texts are one group of 8 bytes a row; empty texts likewise; very long texts count by their bytes and
are hashed where they lie, so no text moves; repeated rows count each; of items of equal size the smaller digest comes
first, of equal spreads the older partial partition, and slots go by a hash of the row, then its id; an empty table gives
no row; fewer groups than shards leave shards empty; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, hash_bucket, per_group, prefix_by_bucket, table, with_small


def difference(sizes: list[int], k: int) -> list[int]:
    """Part (0 to k - 1) of each size by largest differencing."""
    tick = itertools.count()
    heap = [(-s, next(tick), [(s, i)] + [(0, None)] * (k - 1)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        c = [(x + y, m if n is None else n if m is None else (m, n)) for (x, m), (y, n) in zip(a, reversed(b))]
        c.sort(key=lambda p: -p[0])
        heapq.heappush(heap, (c[-1][0] - c[0][0], next(tick), c))
    part = [0] * len(sizes)
    for j, (_, node) in enumerate(heap[0][2] if heap else []):
        stack = [node]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            elif x is not None:
                part[x] = j
    return part


def balance(items: DataFrame, k: int, most_items: int = 8192, chunk: int = 4096, bundles: int = 64, sand: int = 2048) -> DataFrame:
    """items (item: binary, size: long) -> (item, part: int)."""
    items = cut(items)
    row = items.agg(F.count("*").alias("n"), F.sum("size").alias("s")).first()
    n, heavy = row.n, (row.s or 0) // (64 * k)
    level, maps = items, []
    while n > most_items:
        fine = level.where(F.col("size") <= heavy)
        if (m := fine.count()) <= most_items // 2:
            break  # the rest are heavy, and these are a bounded number
        chunks = -(-m // chunk)
        loose = F.pmod(F.xxhash64("item", F.lit(-1 - len(maps))), F.lit(1_000_000)) < int(1e6 * min(0.25, sand / m))
        fine, kept = fine.where(~loose), level.where((F.col("size") > heavy) | loose)
        fine = fine.withColumn("chunk", F.pmod(F.xxhash64("item", F.lit(len(maps))), F.lit(chunks)))

        def bundle(g: pd.DataFrame) -> pd.DataFrame:
            part = difference(g["size"].tolist(), bundles)
            return pd.DataFrame({"item": g["item"].to_numpy(), "size": g["size"].to_numpy(), "bundle": [f"{g['chunk'].iloc[0]}-{p}" for p in part]})

        made = cut(per_group(fine, ["chunk"], ["size", "item"], bundle, "item binary, size long, bundle string"))
        made = made.withColumn("bundle", F.concat(F.lit(f"{len(maps)}:"), "bundle").cast("binary"))
        maps.append(made.select("item", "bundle"))
        level = kept.unionByName(made.groupBy(F.col("bundle").alias("item")).agg(F.sum("size").alias("size")))
        level = cut(level)
        n = level.count()

    def last(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"item": g["item"].to_numpy(), "part": difference(g["size"].tolist(), k)})

    done = cut(per_group(level.withColumn("one", F.lit(0)), ["one"], ["size", "item"], last, "item binary, part int"))
    for m in reversed(maps):
        named = with_small(m, done.select(F.col("item").alias("bundle"), "part"), "bundle", "inner").select("item", "part")
        done = cut(done.join(m.select(F.col("bundle").alias("item")).distinct(), "item", "left_anti").unionByName(named))
    return done


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; rows of one text share a shard, slots are gapless in each."""
    text = F.col(text_col).cast("string")
    d = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit("null").cast("binary")).alias("item"),
    )
    parts = balance(d.groupBy("item").agg(F.sum("size").alias("size")), shards).withColumnRenamed("part", "shard")
    d = with_small(d, parts, "item", "inner").drop("item")
    d = d.withColumn("_lm_h", F.xxhash64("doc_id", "text_crc32"))
    per = cut(d.groupBy("shard").agg(F.count("*").alias("_lm_n")))
    d = with_small(d, per.select("shard", F.ceil(F.col("_lm_n") / 4096).alias("_lm_k")), "shard", "inner")
    d = d.withColumn("_lm_b", hash_bucket(F.col("_lm_h"), F.col("_lm_k"))).drop("_lm_k")
    out = prefix_by_bucket(d, ["shard"], "_lm_b", [F.col(c) for c in ("_lm_h", "doc_id", "text_crc32", "size")], F.lit(1), "slot")
    return out.select("doc_id", "size", "text_crc32", "shard", "slot")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = shard(table(spark, sf_dir, "documents"), 24)
    return d.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op3_sharding": op3_sharding}
SQL: dict[str, str] = {}
