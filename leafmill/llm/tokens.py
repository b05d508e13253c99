"""Token counts: unigram best segmentation over a trie that shares forward scores between pre-tokens.

Pre-tokens are a word mark and a run without white space. A worker keeps a trie from batch to batch and task to task: a
node is a prefix with its forward score (best score of any segmentation, with its token count), so a prefix that many
pre-tokens share is scored once. Inserting a pre-token walks the nodes that are there and scores the others; its terminal
keeps its count. The new pre-tokens of a batch are inserted in sorted order, so that a walk begins where the last word's
path parts from it. At `most_nodes` nodes or `most_words` terminals the trie is emptied: that bounds memory (about 250
bytes a node) and changes no count. Characters of a pre-token behind the first `most_length` are scored on its path but
not kept as nodes, so that one run cannot fill the trie. A document's count is the sum over its pre-tokens. No shuffle is
needed, whatever the number of distinct pre-tokens in the corpus.

Scores are integers (millionths of a nat), so that sums are exact; a segmentation of equal score with fewer tokens wins.
The public vocabularies have no trained unigram probabilities, so a piece at rank r has one proportional to 1 / (r + 2);
a character outside it costs a token for each of its UTF-8 bytes, each dearer than any piece.

Defined cases: null and empty texts count 0; repeated rows count each; very long runs take linear time and no more
memory than themselves; ties count the fewest tokens; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

MARK = "▁"


#: A forward score and its token count as one integer: score << SHIFT minus the count. Larger is better.
SHIFT = 40


class Lexicon:
    """Pieces with integer scores."""

    def __init__(self, scores: dict[str, int], byte: int, most: int = 200_000) -> None:
        self.scores, self.byte, self.most = scores, byte, most
        self.steps = {p: (s << SHIFT) - 1 for p, s in scores.items()}
        self.lengths: dict[str, set[int]] = {}
        for p in scores:
            if len(p) > 3:
                self.lengths.setdefault(p[-3:], set()).add(len(p))
        self.known: dict[str, tuple] = {}

    def ends(self, last: str) -> tuple:
        """For up to three last characters: steps of the pieces of 1, 2 and 3 of them, and lengths of longer pieces."""
        if len(self.known) >= self.most:
            self.known.clear()
        one = self.steps.get(last[-1])
        if one is None:
            n = len(last[-1].encode("utf-8", "surrogatepass"))
            one = n * ((self.byte << SHIFT) - 1)
        out = (one, self.steps.get(last[-2:]) if len(last) > 1 else None, self.steps.get(last) if len(last) > 2 else None, tuple(sorted(self.lengths.get(last, ()))))
        self.known[last] = out
        return out

    @classmethod
    def public(cls, path: str | None = None) -> Lexicon:
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = [sp.id_to_piece(i) for i in sorted(ids, key=lambda i: (-sp.get_score(i), i))]
        total = math.log(math.fsum(1 / (r + 2) for r in range(len(pieces))))
        scores = {p: round(1e6 * (-math.log(r + 2) - total)) for r, p in enumerate(pieces)}
        return cls(scores, min(scores.values()) - 1_000_000)


class Trie:
    """Nodes with forward scores, shared by all words with their prefix, and the terminals' counts.

    Nodes are numbers, 0 is the root; `child` leads from (node, character) to a node, `score` has each node's.
    """

    def __init__(self, lexicon: Lexicon, most_words: int = 500_000, most_nodes: int = 1_000_000, most_length: int = 256) -> None:
        self.lexicon, self.most_words, self.most_nodes, self.most_length, self.counts = lexicon, most_words, most_nodes, most_length, {}
        self.clear()

    def clear(self) -> None:
        self.counts.clear()
        self.child: dict[int, int] = {}
        self.score = [0]
        self.word, self.path, self.nodes = "", [0], [0]

    def insert(self, word: str) -> int:
        """Tokens of a pre-token; path and nodes hold the scores and the node numbers down to the last word inserted."""
        path, nodes, last, shared = self.path, self.nodes, self.word, 0
        for a, b in zip(word, last):
            if a != b:
                break
            shared += 1
        del path[shared + 1 :], nodes[shared + 1 :]
        child, score, kept = self.child, self.score, self.most_length
        steps, known, ends = self.lexicon.steps.get, self.lexicon.known.get, self.lexicon.ends
        for i in range(shared + 1, len(word) + 1):
            key = -1
            if i <= kept:
                key = nodes[i - 1] << 21 | ord(word[i - 1])
                if (node := child.get(key)) is not None:
                    nodes.append(node)
                    path.append(score[node])
                    continue
            tail = word[i - 3 : i] if i > 2 else word[:i]
            one, two, three, longer = known(tail) or ends(tail)
            best = path[i - 1] + one
            if two is not None and (v := path[i - 2] + two) > best:
                best = v
            if three is not None and (v := path[i - 3] + three) > best:
                best = v
            for n in longer:
                if n > i:
                    break
                if (s := steps(word[i - n : i])) is not None and (v := path[i - n] + s) > best:
                    best = v
            path.append(best)
            if key >= 0:
                nodes.append(len(score))
                child[key] = len(score)
                score.append(best)
        self.word = word
        return -path[-1] & ((1 << SHIFT) - 1)

    def insert_all(self, words: set[str]) -> None:
        """Words, without their mark, into the table of terminals."""
        if len(self.counts) + len(words) > self.most_words or len(self.score) > self.most_nodes:
            self.clear()
        new = sorted(words.difference(self.counts))
        insert = self.insert
        self.counts.update(zip(new, [insert(MARK + w) for w in new]))

    def totals(self, texts: list[list[str]], slice_words: int = 200_000) -> list[int]:
        """Tokens of texts given as lists of words."""
        out, at = [0] * len(texts), 0
        while at < len(texts):
            end, n = at, 0
            while end < len(texts) and (n == 0 or n + len(texts[end]) <= slice_words):
                n += len(texts[end])
                end += 1
            for k in range(0, max(n, 1), slice_words):  # over once only for a text of more words than a slice
                some = [t[k : k + slice_words] for t in texts[at:end]] if n > slice_words else texts[at:end]
                self.insert_all(set().union(*some))
                for i, t in enumerate(some, at):
                    out[i] += sum(map(self.counts.__getitem__, t))
            at = end
        return out


#: A Python worker keeps its trie from task to task.
_TRIES: dict[str | None, Trie] = {}


def _trie(path: str | None) -> Trie:
    if path not in _TRIES:
        _TRIES[path] = Trie(Lexicon.public(path))
    return _TRIES[path]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(path)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                ids, texts = b.column(0).slice(at, 512), b.column(1).slice(at, 512)
                words = [(t or "").split() for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([ids, pa.array(map(len, words), pa.int64()), pa.array(trie.totals(words), pa.int64())], ["doc_id", "n_words", "n_tokens"])

    small_batches(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


QUERIES = {"op4_token_counts": op4_token_counts}
SQL: dict[str, str] = {}
