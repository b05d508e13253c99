"""Toxicity: character n-gram linear classifier on features scaled by naive Bayes log-count ratios.

A text's features are its distinct lower-case character n-grams of each order, hashed into 2 ** bits places. Training
rows are labelled rows outside the held-out fold, at most `train_rows` for each label (smallest hash of their id first;
that bound is the only sample). Each place's log ratio of its document rate under label 1 and label 0 scales the place;
a logistic regression over all places with an L2 penalty is fitted by quasi-Newton steps, and its intercept is moved from
the sample's odds to the odds of all training rows. A model is one float for each place, so its size does not grow with
the data. A training row goes to the fitting task as a list of places or, if that is shorter, as one bit a place, so the
task holds 2 * train_rows * 2 ** bits / 8 bytes (197 MB) at most, however long texts are.

Defined cases: null text counts as empty; an empty text scores the prior alone; rows without label are scored all the
same; of several labels of one document the largest holds; of repeated training rows the one with the most places (ties:
the first places) trains; with no labelled row of one of the labels every score is (rows of label 1 + 1) / (rows + 2);
repeated rows are scored each; an empty table gives no row; long texts are read whole, slice by slice, with the features
that they have in one piece; other columns pass through whatever they are called (a score column that would clash gets
underscores at its end).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh, small_batches, table

BITS, ORDERS = 18, (3, 4, 5)
#: Characters of a text that are hashed at a time.
SLICE = 1 << 17
#: Documented bound: training rows for each of the two labels.
TRAIN_ROWS = 3000


def places(text: str, slice_chars: int = SLICE) -> Iterator[np.ndarray]:
    """Hashed n-grams of the whole text between two spaces, with repeats, slice by slice."""
    text = f" {text.lower()} "
    for at in range(0, len(text), slice_chars):
        c = np.frombuffer(text[at : at + slice_chars + max(ORDERS) - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where((c == 10) | (c == 9) | (c == 13), np.uint32(32), c)
        h, found = c, []
        for n in range(2, max(ORDERS) + 1):
            h = h[:-1] * np.uint32(0x01000193) + c[n - 1 :]
            if n in ORDERS:
                x = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(n)
                found.append((x * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
        yield np.concatenate(found)


def features(text: str) -> np.ndarray:
    """Distinct places of a text."""
    mark = np.zeros(1 << BITS, bool)
    for p in places(text):
        mark[p] = True
    return np.flatnonzero(mark).astype(np.int32)


def pack_places(p: np.ndarray) -> bytes:
    """Distinct places as a list of four bytes each or as one bit a place, whichever is shorter."""
    if 4 * len(p) < 1 << BITS - 3:
        return p.astype("<i4").tobytes()
    mark = np.zeros(1 << BITS, bool)
    mark[p] = True
    return np.packbits(mark).tobytes()


class Sample:
    """Rows of places; products with the 0-1 matrix of rows and places, in pieces of bounded memory."""

    def __init__(self, rows: list[bytes], piece: int = 1 << 17) -> None:
        lists = [i for i, r in enumerate(rows) if len(r) < 1 << BITS - 3]
        bits = [i for i, r in enumerate(rows) if len(r) == 1 << BITS - 3]
        self.order, self.n_lists, self.piece = np.array(lists + bits, int), len(lists), piece
        self.col = np.frombuffer(b"".join(rows[i] for i in lists), "<i4")
        self.end = np.concatenate([[0], np.cumsum([len(rows[i]) // 4 for i in lists], dtype=np.int64)])
        self.bits = [np.frombuffer(rows[i], np.uint8) for i in bits]

    def _lists(self) -> Iterator[tuple[int, int]]:
        a = 0
        while a < self.n_lists:
            b = max(a + 1, int(np.searchsorted(self.end, self.end[a] + self.piece, "right")) - 1)
            yield a, b
            a = b

    def _bits(self) -> Iterator[tuple[int, np.ndarray]]:
        for a in range(0, len(self.bits), 32):
            yield self.n_lists + a, np.unpackbits(np.stack(self.bits[a : a + 32]), axis=1).astype(np.float32)

    def times(self, v: np.ndarray) -> np.ndarray:
        """For each row the sum of v over its places."""
        out = np.zeros(len(self.order))
        for a, b in self._lists():
            s = np.concatenate([[0.0], np.cumsum(v[self.col[self.end[a] : self.end[b]]])])
            out[a:b] = s[self.end[a + 1 : b + 1] - self.end[a]] - s[self.end[a:b] - self.end[a]]
        for a, x in self._bits():
            out[a : a + len(x)] = x @ v.astype(np.float32)
        return out

    def back(self, g: np.ndarray) -> np.ndarray:
        """For each place the sum of g over its rows."""
        out = np.zeros(1 << BITS)
        for a, b in self._lists():
            out += np.bincount(self.col[self.end[a] : self.end[b]], np.repeat(g[a:b], np.diff(self.end[a : b + 1])), 1 << BITS)
        for a, x in self._bits():
            out += g[a : a + len(x)].astype(np.float32) @ x
        return out


def minimise(fn, x: np.ndarray, steps: int, memory: int = 8, least: float = 1e-2) -> np.ndarray:
    """Limited-memory quasi-Newton descent with step halving; fn gives value and gradient."""
    value, g = fn(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.abs(g).max() < least:
            break
        d, a = -g, []
        for s, y, r in reversed(past):
            a.append(r * (s @ d))
            d = d - a[-1] * y
        if past:
            s, y, r = past[-1]
            d = d / (r * (y @ y))
        else:
            d = d / max(1.0, float(np.abs(g).sum()))
        for (s, y, r), k in zip(past, reversed(a)):
            d = d + s * (k - r * (y @ d))
        slope, t = float(g @ d), 1.0
        while True:
            new, h = fn(x + t * d)
            if new <= value + 1e-4 * t * slope or t < 1e-6:
                break
            t /= 2
        s, y = t * d, h - g
        if s @ y > 1e-12:
            past = [*past[1 - memory :], (s, y, 1 / float(s @ y))]
        x, value, g = x + s, new, h
    return x


def fit(rows: list[bytes], labels: np.ndarray, odds: float, l2: float = 0.1, spread: float = 0.02, steps: int = 40) -> tuple[np.ndarray, float]:
    """Weight of each place and intercept; rows: packed distinct places; odds: of label 1 among all training rows.

    A ratio's sampling variance is about the sum of its two counts' inverses. The ratio is shrunk as the posterior mean
    under a prior of variance `spread` around 0, so that places seen in few rows count for little and none is left out.
    """
    sample = Sample(rows)
    y = labels[sample.order].astype(float)
    n1, n0 = y.sum(), (1 - y).sum()
    pos, neg = sample.back(y), sample.back(1 - y)
    share = n1 / (n1 + n0)
    ratio = np.log((pos + share) / n1) - np.log((neg + 1 - share) / n0)  # 0 for places never seen in training
    ratio *= spread / (spread + 1 / (pos + 1) + 1 / (neg + 1))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = x[:-1], x[-1]
        z = sample.times(w * ratio) + b
        g = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - y
        value = np.logaddexp(0, z).sum() - (y * z).sum() + l2 / 2 * (w @ w)
        return float(value), np.append(sample.back(g) * ratio + l2 * w, g.sum())

    x = minimise(loss, np.append(np.zeros(1 << BITS), math.log(n1 / n0)), steps)
    return (x[:-1] * ratio).astype(np.float32), float(x[-1] + math.log(odds) - math.log(n1 / n0))


class Evidence:
    """Sum of the weights of a text's distinct places."""

    def __init__(self, weight: np.ndarray) -> None:
        self.weight, self.last = weight.astype(np.float64), np.zeros(1 << BITS, np.int64)

    def __call__(self, text: str) -> float:
        if len(text) > SLICE // 4:  # lower case may be longer
            return float(self.weight[features(text)].sum())
        (p,) = places(text)
        i = np.arange(len(p))
        self.last[p] = i  # of equal places the last one's number stays
        return float(self.weight[np.sort(p[self.last[p] == i])].sum())


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Fit on the labelled rows whose crc32 of the id, mod 5, is not 0."""
    small_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    if not n1 or not n0:
        p = (n1 + 1) / (n1 + n0 + 2)
        return np.zeros(1 << BITS, np.float32), math.log(p / (1 - p))
    some = [known.where(f"y = {y}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows) for y in (0, 1)]
    sample = cut(some[0].unionByName(some[1]))
    text = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = text.join(F.broadcast(sample), "doc_id")  # 2 x train_rows ids at most

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([pack_places(features(t.as_py())) for t in b.column(2)], pa.binary())], ["doc_id", "y", "f"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = {}
        for b in batches:
            for i, y, f in zip(*(c.to_pylist() for c in b.columns)):
                if i not in got or (-len(f), f) < (-len(got[i][1]), got[i][1]):
                    got[i] = (y, f)
        kept = [got.pop(i) for i in sorted(got)]
        if len({y for y, _ in kept}) < 2:
            p = (n1 + 1) / (n1 + n0 + 2)
            w, b0 = np.zeros(1 << BITS, np.float32), math.log(p / (1 - p))
        else:
            y = np.array([y for y, _ in kept], float)
            w, b0 = fit([kept.pop()[1] for _ in range(len(kept))][::-1], y, n1 / n0)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([b0])], ["w", "b"])

    made = rows.select("doc_id", "y", "text").mapInArrow(one, "doc_id long, y int, f binary")
    if text.select("doc_id").join(F.broadcast(sample.select("doc_id")), "doc_id").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").head(1):
        # of repeated rows one goes on, whatever their number
        made = made.groupBy("doc_id", "y").agg(F.min_by("f", F.struct(-F.length("f"), "f")).alias("f"))
    made = made.repartition(1).mapInArrow(whole, "w binary, b double").first()
    return np.frombuffer(made.w, np.float32), made.b


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), score_col: str = "_lm_score") -> DataFrame:
    """The columns of `keep` and score_col: the chance of label 1."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cols = [*keep, *([] if text_col in keep else [text_col])]
    d = docs.select(*[F.col(f"`{c}`").alias(f"_lm_{i}") for i, c in enumerate(cols)])
    at, n = cols.index(text_col), len(keep)
    kinds = [f"{c} {t}" for c, t in d.dtypes[:n]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, b0 = shared.value
        evidence = Evidence(weight)
        for b in batches:
            z = np.array([evidence(t.as_py() or "") for t in b.column(at)], float) + b0
            p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(p, pa.float64())], [*b.schema.names[:n], "_lm_score"])

    out = d.mapInArrow(run, ", ".join([*kinds, "_lm_score double"]))
    return out.select(*[F.col(f"_lm_{i}").alias(c) for i, c in enumerate(keep)], F.col("_lm_score").alias(fresh(score_col, keep)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    out = out.withColumnRenamed("_lm_score", "score")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op2_toxicity": op2_toxicity}
SQL: dict[str, str] = {}
