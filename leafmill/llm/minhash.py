"""MinHash near-dedup: HyperMinHash registers, banded; collision-corrected estimates; links confirmed on full sets.

A document's set is its distinct 5-word shingles (64-bit hashes). Its sketch has 128 buckets; a register keeps the
leading-zero count (6 bits) and 10 mantissa bits of the bucket's smallest hash, empty buckets borrow from a fixed order of
donors. 25 bands of 5 registers are keys: two sets of Jaccard 0.85 miss every band with probability 4e-7, of 0.80 with
5e-5.

1. Rows of equal sets (128-bit digest) become one class by a grouped minimum, so exact copies cost nothing further.
2. Classes that share a band meet in blocks of at most `block` rows (a larger bucket is dealt to all pairs of its
   blocks; one of over `lump` rows is joined without a look, which only widens step 4). Within a block, estimates of at
   least `loose` join classes into loose components: five standard errors below `percent` (0.69 for 85, 0.62 for 80).
3. Only members of loose components get their full sets, from their whole texts.
4. A loose component of at most 2 x `block` is compared in one task. In a larger one every member is first held against
   the few members most like a sample (hubs); who is not in the largest group that this links is compared with all, in
   blocks. Tasks emit a spanning forest of confirmed links, never pairs, and no link between components is lost.
5. Alternating stars join confirmed links into components.

Memory of a task is bounded by a block, whatever the largest group. Links are 100 * intersection >= percent * union.

Defined cases: null and empty texts and texts without words have n_shingles 0 and stand alone; fewer than five words are
one shingle; rows of one doc_id are one document, of which near_dedup keeps the row with the smallest hash of all its
columns; a null doc_id stands alone and is kept; of equal texts and of every group the smallest doc_id stays; very long
texts are read whole, their sets held one at a time; an empty table gives no row; other columns are ignored, whatever
they are called. Hash collisions apart (below 1e-9 for a document), sets are exact.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, per_group, small_batches, table, with_small

BUCKET_BITS, MANTISSA, BANDS, ROWS = 7, 10, 25, 5
K = 1 << BUCKET_BITS
_rng = np.random.default_rng(20)
DONORS = np.argsort(_rng.random((K, K)) - 2 * np.eye(K), axis=1)  # a bucket that is not empty is its own donor
MIX = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
SALT = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)
PLACE = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)


def scramble(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of a text; word hashes are remembered up to a bound."""

    def __init__(self, words: int = 5, most: int = 300_000) -> None:
        self.words, self.most, self.known = words, most, {}

    def __call__(self, text: str | None) -> np.ndarray:
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
        if not found:
            return np.zeros(0, np.uint64)
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for w in set(found).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        n = min(self.words, len(h))
        m = len(h) - n + 1
        s = np.full(m, n, np.uint64)
        for i in range(n):
            s = scramble(s + h[i : i + m] * PLACE[i])
        return np.unique(s)


def registers(s: np.ndarray) -> np.ndarray:
    """Sketch of a sorted set: the first hash of each bucket is its smallest."""
    bucket, first = np.unique((s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), return_index=True)
    rest = (s[first] << np.uint64(BUCKET_BITS)) >> np.uint64(11)
    m, e = np.frexp(rest.astype(np.float64))
    reg = ((np.minimum(53 - e, 63)).astype(np.int64) << MANTISSA) | np.maximum((m * 2 - 1) * (1 << MANTISSA), 0).astype(np.int64)
    out, full = np.zeros(K, np.uint16), np.zeros(K, bool)
    out[bucket], full[bucket] = reg, True
    if not full.all():
        out = out[DONORS[np.arange(K), full[DONORS].argmax(axis=1)]]
    return out


def band_keys(r: np.ndarray) -> np.ndarray:
    return scramble((scramble(r[: BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS) * MIX)).sum(axis=1, dtype=np.uint64) + SALT).astype(np.int64)


@functools.cache
def collision(a: int, b: int) -> float:
    """Chance that registers of unlike minima agree, for sets of 2 ** a and 2 ** b hashes."""
    edges = np.concatenate([np.array([0.0]), *(2.0 ** -(z + 1) * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA)) for z in range(52, -1, -1)), np.array([1.0])])
    p = [-np.diff((1 - edges) ** max(2.0**n / K, 1)) for n in (a, b)]
    return float((p[0] * p[1]).sum())


def estimate(equal: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    """Jaccard estimates from counts of equal registers."""
    a = int(n).bit_length()
    c = np.array([collision(a, b) for b in range(64)])[np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)]
    return np.maximum(0, (equal / K - c) / (1 - c))


def forest(m: int, linked) -> list[tuple[int, int]]:
    """Spanning forest over 0 .. m - 1; linked(p, rest) says which of rest are linked to p."""
    rest, out = np.arange(m), []
    while len(rest):
        stack, rest = [rest[0]], rest[1:]
        while stack and len(rest):
            p = stack.pop()
            hit = linked(p, rest)
            out += [(p, int(q)) for q in rest[hit]]
            stack += rest[hit].tolist()
            rest = rest[~hit]
    return out


def set_links(sets: list[np.ndarray], percent: int):
    """linked(p, rest) on full sets."""
    size = np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    mark = np.zeros(code.max() + 1, bool)

    def linked(p: int, rest: np.ndarray) -> np.ndarray:
        own = code[start[p] : start[p] + size[p]]
        mark[own] = True
        close = 100 * np.minimum(size[p], size[rest]) >= percent * np.maximum(size[p], size[rest])
        hit = np.zeros(len(rest), bool)
        if len(rest) > 8 and close.mean() > 0.5:
            both = np.add.reduceat(mark[code], start)[rest]
        else:
            both = np.zeros(len(rest), np.int64)
            for i in np.flatnonzero(close):
                q = rest[i]
                both[i] = np.count_nonzero(mark[code[start[q] : start[q] + size[q]]])
        hit = close & (100 * both >= percent * (size[p] + size[rest] - both))
        mark[own] = False
        return hit

    return linked


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, fp, regs, bands) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for b in batches:
            n, fp, regs, bands = [], [], [], []
            for t in b.column(1):
                s = shingler(t.as_py())
                n.append(len(s))
                r = registers(s) if len(s) else None
                fp.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                regs.append(r.tobytes() if len(s) else None)
                bands.append(band_keys(r) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(regs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["id", "n", "fp", "regs", "bands"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "id long, n long, fp binary, regs binary, bands array<long>")


def full_sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(comp, id, set) of the members (id, comp), from their whole texts."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    d = with_small(d, members, "id", "inner").select("comp", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for b in batches:
            sets = [shingler(t.as_py()).tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sets, pa.binary())], ["comp", "id", "set"])

    return d.mapInArrow(run, "comp long, id long, set binary").where("length(set) > 0")


def in_blocks(rows: DataFrame, key: str, sizes: DataFrame, block: int) -> DataFrame:
    """rows with (key, i, j, side): one block of a small group, or every pair of a large group's blocks that has the row's own, side."""
    k = F.ceil(F.col("_lm_n") / block).cast("int")
    d = with_small(rows, sizes.withColumnRenamed("n", "_lm_n"), key, "inner").withColumn("_lm_k", k).withColumn("_lm_s", F.pmod(F.xxhash64("id", F.lit(7)), F.col("_lm_k")).cast("int"))
    d = d.withColumn("_lm_o", F.explode(F.sequence(F.lit(0), F.col("_lm_k") - 1)))
    return d.withColumn("i", F.least("_lm_s", "_lm_o")).withColumn("j", F.greatest("_lm_s", "_lm_o")).withColumnRenamed("_lm_s", "side").drop("_lm_n", "_lm_k", "_lm_o")


def loose_links(reps: DataFrame, loose: float, block: int, lump: int) -> DataFrame:
    """Edges (a, b) whose components hold together every pair of classes with an estimate of `loose` or more in a shared band."""
    keyed = reps.select("id", F.explode("bands").alias("key"))
    sizes = cut(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("b")).where("n > 1"))
    huge = with_small(keyed, sizes.where(F.col("n") > lump).select("key", "b"), "key", "inner").select(F.col("id").alias("a"), "b")
    rows = in_blocks(keyed, "key", sizes.where(F.col("n") <= lump).select("key", "n"), block).select("id", "key", "i", "j")
    rows = rows.join(reps.select("id", "n", "regs"), "id")

    def link(g: pd.DataFrame) -> pd.DataFrame:
        r = np.frombuffer(b"".join(g["regs"]), np.uint16).reshape(len(g), K)
        n, ids = g["n"].to_numpy(), g["id"].to_numpy()
        found = forest(len(g), lambda p, rest: estimate((r[rest] == r[p]).sum(axis=1), n[p], n[rest]) >= loose)
        return pd.DataFrame({"a": [ids[p] for p, _ in found], "b": [ids[q] for _, q in found]}, dtype="int64")

    return per_group(rows, ["key", "i", "j"], ["id"], link, "a long, b long").unionByName(huge)


def confirmed_links(sets: DataFrame, percent: int, block: int, hubs: int = 8, probes: int = 64) -> DataFrame:
    """Edges (a, b) of a spanning forest of each component of links on full sets."""
    sizes = cut(sets.groupBy("comp").agg(F.count("*").alias("n")))

    def link(g: pd.DataFrame) -> pd.DataFrame:
        ids, s = g["id"].to_numpy(), [np.frombuffer(x, np.uint64) for x in g["set"]]
        found = forest(len(g), set_links(s, percent))
        return pd.DataFrame({"a": [ids[p] for p, _ in found], "b": [ids[q] for _, q in found]}, dtype="int64")

    out = "a long, b long"
    small = sets.join(sizes.where(f"n <= {2 * block}").select("comp"), "comp", "left_semi")
    edges = per_group(small, ["comp"], ["id"], link, out)
    large = sizes.where(f"n > {2 * block}")
    if not large.head(1):
        return edges
    big = cut(sets.join(large, "comp").withColumn("i", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / block)).cast("int")))
    blocks = big.select("comp", "i").distinct()
    widest = -(-large.agg(F.max("n")).first()[0] // block)

    def beside(some: DataFrame, rows: DataFrame) -> DataFrame:
        """The rows of each block and, in every block of the component, the few of `some`."""
        few = some.drop("i").join(blocks, "comp").withColumn("few", F.lit(True))
        return rows.withColumn("few", F.lit(False)).select("comp", "i", "id", "set", "few").unionByName(few.select("comp", "i", "id", "set", "few"))

    def first(order: list, most: int, rows: DataFrame) -> DataFrame:
        """The first rows of each component, by blocks, then by 32 blocks, and so on."""
        from pyspark.sql.window import Window

        rows, left = rows.withColumn("_lm_i", F.col("i")), widest
        while True:  # a task sees the first rows of 32 blocks or groups of blocks
            rows = rows.withColumn("_lm_r", F.row_number().over(Window.partitionBy("comp", "_lm_i").orderBy(*order))).where(F.col("_lm_r") <= most).drop("_lm_r")
            if left <= 1:
                return rows.drop("_lm_i")
            rows, left = rows.withColumn("_lm_i", F.floor(F.col("_lm_i") / 32).cast("int")), -(-left // 32)

    def likeness(g: pd.DataFrame) -> pd.DataFrame:
        few = g["few"].to_numpy()
        s = [np.frombuffer(x, np.uint64) for x in g["set"]]
        total = np.zeros(len(g))
        for p in np.flatnonzero(few):
            both = np.array([np.isin(s[q], s[p], assume_unique=True).sum() for q in np.flatnonzero(~few)])
            total[~few] += both / (len(s[p]) + np.array([len(s[q]) for q in np.flatnonzero(~few)]) - both)
        h = g[~few]
        return pd.DataFrame({"comp": h["comp"], "i": h["i"], "id": h["id"], "like": total[~few]})

    sample = first([F.xxhash64("id", F.lit(3)), F.col("id")], min(probes, 16), big.select("comp", "i", "id"))
    sample = cut(big.join(sample.select("comp", "id"), ["comp", "id"], "left_semi").select("comp", "i", "id", "set"))
    like = per_group(beside(sample, big), ["comp", "i"], ["id"], likeness, "comp long, i int, id long, like double")
    hub = first([F.col("like").desc(), F.col("id")], hubs, like)
    hub = cut(big.join(hub.select("comp", "id"), ["comp", "id"], "left_semi").select("comp", "i", "id", "set"))

    def to_hub(g: pd.DataFrame) -> pd.DataFrame:
        g = pd.concat([g[g["few"]], g[~g["few"]]])
        k, ids = int(g["few"].sum()), g["id"].to_numpy()
        linked, pairs = set_links([np.frombuffer(x, np.uint64) for x in g["set"]], percent), []
        for p in range(k):
            rest = np.arange(p + 1, len(g))
            pairs += [(ids[p], ids[q]) for q in rest[linked(p, rest)]]
        return pd.DataFrame({"a": [p for p, _ in pairs], "b": [q for _, q in pairs]}, dtype="int64")

    star = cut(per_group(beside(hub, big), ["comp", "i"], ["id"], to_hub, out).where("a <> b").distinct())
    joined = components(star).withColumnRenamed("node", "id").withColumnRenamed("component", "c")
    part = big.select("comp", "i", "id").join(joined, "id", "left").withColumn("c", F.coalesce("c", "id"))
    main = part.groupBy("comp", "c").count().groupBy("comp").agg(F.max_by("c", F.struct("count", F.lit(0) - F.col("c"))).alias("main"))
    outside = part.join(main, "comp").where("c <> main").select("comp", "id")
    many = cut(outside.groupBy("comp").agg(F.count("*").alias("u")))
    rest = outside.join(many, "comp").withColumn("o", F.pmod(F.xxhash64("id", F.lit(5)), F.ceil(F.col("u") / block)).cast("int")).select("comp", "id", "o")
    rest = cut(big.join(rest, ["comp", "id"]).select("comp", "id", "set", "o"))
    mine = rest.join(blocks, "comp").select("comp", "o", "i", "id", "set")
    all_ = big.select("comp", "i", "id", "set").join(rest.select("comp", "o").distinct(), "comp").select("comp", "o", "i", "id", "set")
    far = per_group(mine.unionByName(all_), ["comp", "o", "i"], ["id"], link, out)
    return edges.unionByName(star).unionByName(far).where("a <> b")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, loose: float | None = None, block: int = 256, lump: int = 4096) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    small_batches(docs.sparkSession)
    j = percent / 100
    loose = j - 5 * (j * (1 - j) / K) ** 0.5 if loose is None else loose
    sig = cut(sketches(docs, id_col, text_col))
    classes = sig.where("fp is not null and id is not null").groupBy("fp").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("regs").alias("regs"), F.first("bands").alias("bands"))
    classes = cut(classes)
    reps = classes.select(F.col("rep").alias("id"), "n", "regs", "bands")
    near = components(loose_links(reps, loose, block, lump)).select(F.col("node").alias("id"), F.col("component").alias("comp"))
    near = cut(near)
    sets = cut(full_sets(docs, near, id_col, text_col).dropDuplicates(["id", "set"]))
    whole = components(confirmed_links(sets, percent, block))
    named = classes.select("fp", "rep")
    named = with_small(named, whole.select(F.col("node").alias("rep"), "component"), "rep").select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = sig.select("id", "n", "fp").join(named, "fp", "left")
    out = out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs with one document, that of the smallest id, of each group; columns unchanged."""
    groups = near_groups(docs, id_col, text_col, **how)
    gone = cut(groups.where("not kept").select(F.col("doc_id").alias(id_col)).distinct())
    out = with_small(docs, gone, id_col, "left_anti")
    repeated = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col)).agg(F.count("*").alias("_lm_n")).where("_lm_n > 1").select(id_col)
    repeated = cut(repeated)
    if not repeated.head(1):
        return out
    again = with_small(out, repeated, id_col, "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in out.columns])
    first = again.groupBy(id_col).agg(F.min_by(row, F.struct(F.xxhash64(F.to_json(row)), F.md5(F.to_json(row)))).alias("_lm_row")).select("_lm_row.*")
    return with_small(out, repeated, id_col, "left_anti").unionByName(first)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


QUERIES = {"op9_minhash": op9_minhash}
SQL = {
    "op9_minhash": r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS i FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x, y FROM p WHERE 100 * i >= 85 * (nx + ny - i)),
c AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT e.y, c.r FROM c JOIN e ON e.x = c.doc_id),
m AS (SELECT doc_id, min(r) AS component_id FROM c GROUP BY doc_id)
SELECT s.doc_id, len(sh)::bigint AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN m USING (doc_id)""",
}
