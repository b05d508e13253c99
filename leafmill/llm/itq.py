"""Embedding near-dedup: iterative quantisation codes, multi-index Hamming tables, exact cosines on original vectors.

Rotations are learned by iterative quantisation (alternating sign codes and orthogonal Procrustes) on a bounded, hashed
sample of `sample_rows` unit vectors; every row is coded and indexed. Codes of several rotations are cut into substrings
of s bits, s = log2 of the number of vectors or 16 at least, one hash table each. The number of tables follows from the
threshold: two vectors at its angle agree on a bit with probability 1 - angle / pi, so on a substring with that to the
power s, and tables are added until such a pair misses them all with probability `miss` (1e-5) at most.

1. Equal vectors of a label become one class with a multiplicity.
2. Classes that share a table's key meet in blocks of `block` rows at most (pairs of blocks for larger keys), so memory
   is bounded whatever the largest group. A block's cosines come from one matrix product in double precision. A pair is
   counted only in the first table that it shares, so counts need no pair list.
3. A block emits, for each row, its number of links (weighted by multiplicity) and a spanning forest: never pairs.
4. Counts are summed; alternating stars join the forests into components.

Defined cases: vectors null, empty, zero or with null or non-finite components, and rows without label, link with
nothing; vectors of unlike length link with nothing; rows of one vec_id are one vector (of unlike ones the one whose
label and components are first as JSON text), so n_links counts other ids once each, and every row gets its id's result;
a null vec_id stands alone; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, per_group, table
from .minhash import forest, in_blocks, scramble
from .vectors import matrix, usable

#: Documented bound of the sample on which rotations are learned.
SAMPLE_ROWS = 4000


def learn(sample: np.ndarray, rotations: int, rounds: int = 30, seed: int = 3) -> np.ndarray:
    """(rotations, d, d): orthogonal, each from a random start, that bring unit vectors close to their sign codes."""
    d = sample.shape[1]
    rng, out = np.random.default_rng(seed), []
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    for _ in range(rotations):
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(rounds if len(x) >= 2 * d else 0):
            u, _, vt = np.linalg.svd(x.T @ np.where(x @ r >= 0, 1.0, -1.0))
            r = u @ vt
        out.append(r)
    return np.stack(out)


def tables_needed(bits: int, cosine: float, miss: float) -> int:
    same = (1 - math.acos(min(1.0, cosine)) / math.pi) ** bits
    return max(1, math.ceil(math.log(miss) / math.log(1 - same))) if same < 1 else 1


def keys(x: np.ndarray, rotations: np.ndarray, bits: int, count: int) -> np.ndarray:
    """(rows, count) table keys of unit vectors."""
    signs = np.concatenate([x @ r >= 0 for r in rotations], axis=1)[:, : bits * count]
    weights = (np.uint64(1) << np.arange(bits, dtype=np.uint64))
    k = (signs.reshape(len(x), count, bits) * weights).sum(axis=2, dtype=np.uint64)
    return scramble(k + (np.arange(count, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = 0.98, miss: float = 1e-5, sample_rows: int = SAMPLE_ROWS, block: int = 256) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    d = usable(df, id_col, vec_col, F.col(label_col).cast("string").alias("label")).where("label is not null")
    if df.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").head(1):
        d = d.groupBy("vec_id").agg(F.min_by(F.struct("v", "label"), F.to_json(F.struct("label", "v"))).alias("r")).select("vec_id", "r.v", "r.label")
    d = cut(d)
    kind = d.schema["v"].dataType.simpleString()
    # equal vectors: their first id stands for all
    classes = cut(d.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    n = classes.count()
    bits = min(62, max(16, math.ceil(math.log2(max(n, 2)))))
    count = tables_needed(bits, cosine, miss)
    dims = [r[0] for r in classes.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(16).collect()]
    plans = {}  # other lengths, rare ones, take random rotations
    for dim in dims:
        sample = classes.where(F.size("v") == dim).orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").collect()
        plans[dim] = learn(matrix([r[0] for r in sample]), -(-bits * count // dim))
    shared = df.sparkSession.sparkContext.broadcast(plans)

    def code(frames):
        for f in frames:
            for dim, g in f.groupby(f["v"].map(len)):
                x = matrix(g["v"])
                turns = shared.value[dim] if dim in shared.value else learn(x[:0], -(-bits * count // dim))
                k = keys(x / np.linalg.norm(x, axis=1, keepdims=True), turns, bits, count)
                # keys of one label and length only
                salt = scramble(np.array([hash_text(f"{dim}|{t}") for t in g["label"]], np.uint64))
                k = scramble(k.astype(np.uint64) ^ salt[:, None]).astype(np.int64)
                yield pd.DataFrame({"id": g["id"], "label": g["label"], "copies": g["copies"], "v": g["v"], "keys": list(k)})

    coded = cut(classes.mapInPandas(code, f"id long, label string, copies long, v {kind}, keys array<long>"))
    keyed = coded.select("id", F.explode("keys").alias("key"))
    many = cut(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    rows = in_blocks(keyed, "key", many, block).select("id", "key", "i", "j", "side")
    rows = rows.join(coded, "id")

    def link(g: pd.DataFrame) -> pd.DataFrame | None:
        g = g[g["label"] == g["label"].iloc[0]] if (g["label"] != g["label"].iloc[0]).any() else g
        ids, x = g["id"].to_numpy(), matrix(g["v"])
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= cosine
        np.fill_diagonal(near, False)
        if not near.any():
            return None
        k, key = np.stack(g["keys"].to_numpy()), g["key"].iloc[0]
        table_no = int(np.flatnonzero(k[0] == key)[0])
        first = near.copy()
        for t in range(table_no):  # counted in an earlier table
            first &= k[:, t][:, None] != k[:, t][None, :]
        i, j = int(g["i"].iloc[0]), int(g["j"].iloc[0])
        if i != j:  # pairs within one block are counted where i = j
            side = g["side"].to_numpy()
            first &= side[:, None] != side[None, :]
        copies = g["copies"].to_numpy()
        found = forest(len(g), lambda p, rest: near[p, rest])
        counted = pd.DataFrame({"id": ids, "b": pd.array([None] * len(g), "Int64"), "links": (first * copies).sum(axis=1)})
        tree = pd.DataFrame({"id": [ids[p] for p, _ in found], "b": pd.array([ids[q] for _, q in found], "Int64"), "links": 0})
        return pd.concat([counted[counted["links"] > 0], tree], ignore_index=True)

    found = cut(per_group(rows, ["key", "i", "j"], ["id"], link, "id long, b long, links long"))
    whole = components(found.where("b is not null").select(F.col("id").alias("a"), "b"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.join(links, "id", "left").join(whole.select(F.col("node").alias("id"), "component"), "id", "left")
    named = named.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    mine = d.join(named, ["label", "v"]).groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = df.select(F.col(id_col).cast("long").alias("vec_id")).join(mine, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def hash_text(t: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(t)


def op10_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op10_itq": op10_itq}
SQL = {
    "op10_itq": """WITH RECURSIVE e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.embedding::double[], b.embedding::double[]) >= 0.98),
c AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT e.y, c.r FROM c JOIN e ON e.x = c.vec_id),
m AS (SELECT vec_id, min(r) AS component_id FROM c GROUP BY vec_id), n AS (SELECT x AS vec_id, count(*) AS n_links FROM e GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::bigint AS n_links, component_id, vec_id = component_id AS kept FROM m LEFT JOIN n USING (vec_id)""",
}
