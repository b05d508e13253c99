"""Mixing sources to target weights: temperature mixing realised as budgeted block permutations. DataFrame functions only.

A source's weight is its token share to the power a, normalised; a (0: uniform, 1: natural) is bisected until the
weights meet a repetition limit or an entropy. Every source then has a quota of tokens: weight x budget. Without a budget
the mixture is the smallest that uses every document at least once, so small sources repeat and none is cut. Documents
of a source are laid out in a keyed permutation, epoch after epoch, up to the quota; the mixture is cut into blocks of
about `block_tokens`, each with every source's share, and permuted within.

Token positions are prefix sums by hashed buckets of some thousand rows, so a source with any share of the rows is
spread over many tasks, and only per-source and per-bucket sums are windowed whole. The texts, if asked for, move once.

Defined cases: a document's tokens are its words and one end mark, so empty and null texts weigh 1 and very long ones are
one document of many tokens; null sources are a source of their own; repeated rows are mixed each; of equal permutation
keys the smaller id, then the shorter document is first; one source only, or sources of one size, gives natural weights;
an empty table gives no row; columns of docs pass through whatever they are called (mix's own columns get underscores at
their end where a name is taken).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, fresh, hash_bucket, prefix_by_bucket, table, with_small

REPEAT_LIMIT, BLOCK_TOKENS, SEED = 2.0, 65_536, 17
#: Halvings of the exponent's interval.
STEPS = 60


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^ \t\n\r\f\x0B]+")), F.lit(0)).cast("long")


def keyed(seed: int, *parts: Column) -> Column:
    """60 bits of a keyed digest, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, 15), 16, 10).cast("long")


def weights(stats: DataFrame, repeat_limit: float | None = None, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """stats (source, tokens) with weight, and quota in tokens.

    repeat_limit: no source's quota is over so many times its tokens; entropy: of the weights, in nats. One of them.
    """
    row = F.array_agg(F.col("_lm_tokens").cast("double"))
    one = stats.agg(row.alias("t"), F.sum("_lm_tokens").cast("double").alias("total")).select(F.expr("transform(t, x -> x / total)").alias("p"), "total")
    low_half, high_half = "named_struct('lo', s.lo, 'hi', m)", "named_struct('lo', m, 'hi', s.hi)"
    if entropy is not None:
        z = "aggregate(p, 0D, (s, x) -> s + power(x, m))"
        met = f"ln({z}) - m * aggregate(p, 0D, (s, x) -> s + power(x, m) * ln(x)) / {z} >= {entropy!r}D"
        step = f"if({met}, {high_half}, {low_half})"  # to the largest exponent that meets it
    else:
        top, low = (f"{f}(transform(p, x -> power(x, m - 1)))" for f in ("array_max", "array_min"))
        use = f"{top} / {low}" if budget is None else f"{top} / aggregate(p, 0D, (s, x) -> s + power(x, m)) * {budget}D / total"
        step = f"if({use} <= {float(repeat_limit)!r}D, {low_half}, {high_half})"  # to the smallest that meets it
    inner = f"transform(array((s.lo + s.hi) / 2), m -> {step})[0]"
    at = one.select("total", "p", F.expr(f"aggregate(sequence(1, {STEPS}), named_struct('lo', 0D, 'hi', 1D), (s, i) -> {inner})").alias("s"))
    end = "s.lo" if entropy is not None else "s.hi"
    got = at.select("total", F.expr(end).alias("a"), F.expr(f"transform(array({end}), m -> aggregate(p, 0D, (s, x) -> s + power(x, m)))[0]").alias("z"), F.expr(f"transform(array({end}), m -> array_min(transform(p, x -> power(x, m - 1))))[0]").alias("least")).first()
    if got is None or got.total is None:
        return stats.withColumn("_lm_weight", F.lit(0.0)).withColumn("_lm_quota", F.lit(0).cast("long"))
    share = F.col("_lm_tokens") / F.lit(got.total)
    w = F.pow(share, F.lit(got.a)) / F.lit(got.z)
    size = F.lit(float(budget)) if budget is not None else F.lit(got.total * got.z / got.least)
    quota = F.round(w * size).cast("long")
    return stats.withColumn("_lm_weight", w).withColumn("_lm_quota", F.greatest(quota, "_lm_tokens") if budget is None else quota)


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", tokens: Column | None = None, repeat_limit: float | None = REPEAT_LIMIT, entropy: float | None = None, budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED, bucket_rows: int = 4096) -> DataFrame:
    """A row for each use of a document: docs' columns, _lm_tok, _lm_epoch, _lm_block and _lm_slot (place in the block)."""
    taken = docs.columns
    place = {c: f"_lm_c{i}" for i, c in enumerate(taken)}
    own = [fresh(c, taken) for c in ("_lm_tok", "_lm_epoch", "_lm_block", "_lm_slot")]
    if tokens is None:
        tokens = words(F.col("text"))
    docs = docs.select(*[F.col(f"`{c}`").alias(place[c]) for c in taken], tokens.alias("_lm_given"))
    source_col, id_col = place[source_col], place[id_col]
    source = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    d = docs.withColumn("_lm_source", source).withColumn("_lm_tok", F.col("_lm_given") + 1)
    d = d.withColumn("_lm_h", keyed(seed, F.col(id_col)))
    stats = cut(d.groupBy("_lm_source").agg(F.sum("_lm_tok").alias("_lm_tokens"), F.ceil(F.count("*") / bucket_rows).alias("_lm_k")))
    plan = cut(weights(stats, repeat_limit, entropy, budget))
    whole = plan.agg(F.sum("_lm_quota").alias("q")).first().q or 0
    blocks = max(1, -(-whole // block_tokens))
    d = with_small(d, plan, "_lm_source", "inner").withColumn("_lm_b", hash_bucket(F.shiftleft("_lm_h", 4), F.col("_lm_k")))
    d = prefix_by_bucket(d, ["_lm_source"], "_lm_b", [F.col(c) for c in ("_lm_h", id_col, "_lm_tok")], F.col("_lm_tok"), "_lm_start")
    room = 2 * F.col("_lm_quota") - F.col("_lm_tok") - 2 * F.col("_lm_start")
    uses = F.when(room >= 0, F.floor(room / (2 * F.col("_lm_tokens")))).otherwise(-1).cast("int")
    d = d.withColumn("_lm_uses", uses).where("_lm_uses >= 0").withColumn("_lm_epoch", F.explode(F.sequence(F.lit(0), F.col("_lm_uses"))))
    at = (F.col("_lm_epoch") * F.col("_lm_tokens") + F.col("_lm_start")).cast("double") / F.col("_lm_quota").cast("double")
    d = d.withColumn("_lm_block", F.least(F.floor(at * F.lit(float(blocks))), F.lit(blocks - 1)).cast("long"))
    order = Window.partitionBy("_lm_block").orderBy(keyed(seed + 1, F.col(id_col), F.col("_lm_epoch")), id_col, "_lm_epoch", "_lm_tok")
    d = d.withColumn("_lm_slot", F.row_number().over(order) - 1)
    return d.select(*[F.col(place[c]).alias(c) for c in taken], *[F.col(c).alias(o) for c, o in zip(("_lm_tok", "_lm_epoch", "_lm_block", "_lm_slot"), own)])


def mixed(docs: DataFrame, **how) -> DataFrame:
    """docs' rows as often as the mixture uses them; columns unchanged."""
    return mix(docs, **how).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words(F.col("text")).alias("n_words"))
    d = mix(cut(docs), tokens=F.col("n_words"))
    return d.select("doc_id", "source", F.col("_lm_tok").alias("n_tokens"), F.col("_lm_epoch").alias("epoch"), F.col("_lm_block").alias("block"), F.col("_lm_slot").alias("slot"))


QUERIES = {"op1_mixing": op1_mixing}
SQL = {
    "op1_mixing": rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(source, chr(0)) AS src, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\x0B]+')) + 1 AS tok,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 15))::bigint AS h
  FROM documents),
s AS (SELECT src, sum(tok)::bigint AS t FROM d GROUP BY src),
g AS (SELECT sum(t)::double AS total, max(t)::double AS hi, min(t)::double AS lo FROM s),
a AS (SELECT total, CASE WHEN hi = lo THEN 0.0 ELSE greatest(0.0, 1 - ln({REPEAT_LIMIT}) / ln(hi / lo)) END AS a FROM g),
z AS (SELECT any_value(total) AS total, any_value(a) AS a, sum(pow(t / total, a)) AS z, min(pow(t / total, a - 1)) AS least FROM s, a),
p AS (SELECT src, t, greatest(round(pow(t / total, a) / z * (total * z / least))::bigint, t) AS quota FROM s, z),
n AS (SELECT greatest(1, ceil(sum(quota)::double / {BLOCK_TOKENS}))::bigint AS blocks FROM p),
o AS (SELECT *, coalesce(sum(tok) OVER (PARTITION BY src ORDER BY h, doc_id, tok ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS start FROM d JOIN p USING (src)),
u AS (SELECT *, unnest(range(0, (floor((2 * quota - tok - 2 * start) / (2 * t)) + 1)::bigint))::int AS epoch FROM o WHERE 2 * quota - tok - 2 * start >= 0),
b AS (SELECT *, least(floor((epoch * t + start)::double / quota::double * blocks::double)::bigint, blocks - 1) AS block FROM u, n)
SELECT doc_id, source, tok::bigint AS n_tokens, epoch, block,
       (row_number() OVER (PARTITION BY block ORDER BY ('0x' || substr(md5('{SEED + 1}:' || coalesce(doc_id::varchar, '') || ':' || epoch), 1, 15))::bigint, doc_id, epoch, tok) - 1)::int AS slot
FROM b""",
}
