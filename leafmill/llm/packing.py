"""Packing: bounded-space online best-fit of token pieces into windows.

Each partition keeps a fixed number of open windows. A document's ids (its text's and a closing id) are cut into whole
windows and a rest; the rest goes into the open window that it fills best. Where none fits, the fullest is topped up by a
cut of the rest if the gap is worth one (`min_fragment`) and emitted. At a partition's end its open windows are run
together, so that one part-filled window at most is left; these meet in groups of `merge_group` partitions, where they
are run together again. A group's last rest is split into powers of two, which need no padding. One pass tokenizes; only
the pieces (some forty bytes each) are checkpointed, with ids for the left-over windows alone.

Defined cases: null and empty texts give one piece, the closing id; very long texts are encoded whole and cut into whole
windows first; of open windows that a rest fills equally the older one takes it; repeated rows are packed again, each as
its own document; an empty table gives no row; other columns are ignored; a null doc_id stays null.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, small_batches, table

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())])
#: A run without white space of this length goes to the library whose merging stays near linear.
LONG_RUN = re.compile(r"\S{2000}")


@functools.cache
def encoder(name: str = "byte_bpe_50k"):
    """text -> ids of the public byte-level vocabulary; one for each Python worker, which keeps it from task to task.

    The same vocabulary stands in two public files; the rank file's library gives equal ids several times faster. Texts
    with the vocabulary's special string or a very long run go through the JSON file's own library.
    """
    import public_tokenizers as public
    import tiktoken
    from tokenizers import Tokenizer

    with open(public.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow: list = []

    def encode(text: str) -> list[int]:
        if "<|endoftext|>" in text or (len(text) >= 2000 and LONG_RUN.search(text)):
            if not slow:
                slow.append(Tokenizer.from_file(public.path(f"{name}.json")))
            return slow[0].encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


class Rows:
    """Pieces on their way out."""

    def __init__(self) -> None:
        self.cols: list[list] = [[] for _ in ARROW]

    def add(self, pieces: list, sequence: int, keep_ids: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            raw = ids.tobytes()
            for c, x in zip(self.cols, (doc, start, len(ids), zlib.crc32(raw), total, sequence, offset, raw if keep_ids else None)):
                c.append(x)
            offset += len(ids)

    def take(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.cols, ARROW)], schema=ARROW)
        self.cols = [[] for _ in ARROW]
        return out


def run_together(pieces: list, window: int) -> tuple[list[list], list]:
    """Pieces in order as whole windows, and the rest."""
    full, now, free = [], [], window
    for doc, start, ids, total in pieces:
        while len(ids):
            n = min(free, len(ids))
            now.append((doc, start, ids[:n], total))
            start, ids, free = start + n, ids[n:], free - n
            if not free:
                full.append(now)
                now, free = [], window
    return full, now


class Packer:
    """Open windows of one partition; a window is [free ids, pieces]."""

    def __init__(self, window: int, most: int, least_cut: int) -> None:
        self.window, self.most, self.least_cut, self.open, self.done = window, most, least_cut, [], []

    def place(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids):
            fits = [w for w in self.open if w[0] >= len(ids)]
            if fits:
                best = min(fits, key=lambda w: w[0])
            elif len(self.open) < self.most:
                self.open.append(best := [self.window, []])
            else:
                best = min(self.open, key=lambda w: w[0])
                if best[0] >= self.least_cut:
                    best[1].append((doc, start, ids[: best[0]], total))
                    start, ids = start + best[0], ids[best[0] :]
                self.open.remove(best)
                self.done.append(best[1])
                continue
            best[1].append((doc, start, ids, total))
            best[0] -= len(ids)
            if not best[0]:
                self.open.remove(best)
                self.done.append(best[1])
            return

    def document(self, doc, ids: np.ndarray) -> None:
        total, whole = len(ids), len(ids) // self.window * self.window
        for at in range(0, whole, self.window):
            self.done.append([(doc, at, ids[at : at + self.window], total)])
        self.place(doc, whole, ids[whole:], total)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, open_windows: int = 48, min_fragment: int = 8, close_id: int = 0, merge_group: int = 1024) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, packer, out = encoder(), Packer(window, open_windows, min_fragment), Rows()
        sequence = TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = encode(text.as_py() or "")
                packer.document(doc.as_py(), np.array([*ids, close_id], "<u4"))
                for pieces in packer.done:
                    out.add(pieces, sequence)
                    sequence += 1
                packer.done = []
                if len(out.cols[0]) >= 20_000:
                    yield out.take()
        full, rest = run_together([p for _, ps in sorted(packer.open, key=lambda w: w[0]) for p in ps], window)
        for pieces in full:
            out.add(pieces, sequence)
            sequence += 1
        out.add(rest, sequence, True)
        yield out.take()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                kept.setdefault(r["grp"], []).append((r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]))
        out = Rows()
        for grp, pieces in kept.items():
            sequence = (1 << 62) + (grp << 32)
            full, rest = run_together(pieces, window)
            while rest:  # the largest power of two in it, then in what is left
                n = 1 << (sum(len(p[2]) for p in rest).bit_length() - 1)
                some, rest = run_together(rest, n)[0][0], _after(rest, n)
                full.append(some)
            for pieces in full:
                out.add(pieces, sequence)
                sequence += 1
        yield out.take()

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = cut(narrow.mapInArrow(run, SCHEMA))
    left = made.where("ids is not null").withColumn("grp", F.expr(f"(sequence_id div 4294967296) div {merge_group}"))
    left = left.repartition("grp").sortWithinPartitions("grp", "sequence_id", "offset").mapInArrow(merge, SCHEMA)
    return made.where("ids is null").unionByName(left).drop("ids")


def _after(pieces: list, n: int) -> list:
    """The pieces without their first n ids."""
    out = []
    for doc, start, ids, total in pieces:
        k = min(n, len(ids))
        n -= k
        if k < len(ids):
            out.append((doc, start + k, ids[k:], total))
    return out


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op6_packing": op6_packing}
SQL: dict[str, str] = {}
