"""Token counts by dynamic programming over a trie (operator 6).

A unigram model scores a segmentation of a pre-token by the sum of its pieces'
log-probabilities.  The distinct pre-tokens of a partition are inserted in a
trie; the best score and token count of every prefix are computed once, when
its node is made, from the nodes above it, so pre-tokens that share a prefix
share its work.  The node where a pre-token ends stores its counts, and a
document's count is the sum over its pre-tokens.

Pieces come from a public vocabulary file and are never trained.  Their fixed
scores follow Zipf's law on the rank: log p = -log(rank + 2).  A character that
is no piece costs a byte token per UTF-8 byte, each ``BYTE_PENALTY`` below the
rarest piece.  Of equal scores the segmentation with fewer tokens counts.

A pre-token is a run without white space (Unicode), with the word mark in front.
Nothing is shuffled.  Memory is bounded by a block of text, ``NODES`` trie nodes
(the trie then starts anew) and the vocabulary.

Edge cases: null text is empty and has no tokens; a pre-token longer than
``LONG`` is scored in the same way without entering the trie; other columns of
the input are ignored; repeated rows are counted alike.
"""

from __future__ import annotations

import math

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import batch, on_executors, text_pieces

MARK = "▁"  # fixed value: the word mark of the vocabulary
BYTE_PENALTY = 10.0
NODES, LONG, BLOCK_BYTES = 1_000_000, 200, 1 << 21


def piece_scores(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece file with their Zipf scores; control and byte
    pieces are left out."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {sp.id_to_piece(i): -math.log(r + 2) for r, i in enumerate(plain)}


class Trie:
    """Prefix nodes with the best score and token count of their string."""

    def __init__(self, pieces: dict[str, float]):
        self.longest = max(map(len, pieces), default=1)
        self.byte = min(pieces.values(), default=0.0) - BYTE_PENALTY
        self.find = ahocorasick.Automaton()  # the pieces that end at each character of a string
        for p, s in pieces.items():
            self.find.add_word(p, (len(p), s))
        if pieces:
            self.find.make_automaton()
        self.reset()

    def reset(self):
        self.edges: dict[tuple[int, str], int] = {}
        self.score, self.count = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def _extend(self, word: str, path: list[int], score: list, count: list):
        """Best (score, tokens) of each longer prefix of ``word``, in turn, from those
        of its shorter prefixes; the caller appends each result's place to ``path``."""
        done = len(path) - 1
        ending: list[list] = [[] for _ in range(done, len(word))]
        if len(self.find):
            for e, piece in self.find.iter(word, max(0, done + 1 - self.longest)):
                if e >= done:
                    ending[e - done].append(piece)
        for i, pieces in enumerate(ending, done + 1):
            n = len(word[i - 1].encode())
            top, k = score[path[i - 1]] + n * self.byte, count[path[i - 1]] + n
            for m, p in pieces:
                j = path[i - m]
                s = score[j] + p
                if s > top or (s == top and count[j] + 1 < k):
                    top, k = s, count[j] + 1
            yield top, k

    def insert(self, word: str) -> int:
        """The node of ``word``; nodes that are missing are made and scored."""
        node, path = 0, [0]
        edges, score, count = self.edges, self.score, self.count
        for c in word:
            node = edges.get((node, c))
            if node is None:
                break
            path.append(node)
        if len(path) <= len(word):
            for s, k in self._extend(word, path, score, count):
                child = edges[path[-1], word[len(path) - 1]] = len(score)
                score.append(s)
                count.append(k)
                path.append(child)
        self.terminal[word] = path[-1]
        return path[-1]

    def look(self, word: str) -> tuple[float, int]:
        node = self.terminal.get(word)
        if node is None:
            if len(word) > LONG:
                score, count, path = [0.0], [0], [0]
                for s, k in self._extend(word, path, score, count):
                    path.append(len(score))
                    score.append(s)
                    count.append(k)
                return score[-1], count[-1]
            node = self.insert(word)
        return self.score[node], self.count[node]


COUNT = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64()), ("log_prob", pa.float64())])


def _count(shared):
    def run(batches):
        trie = Trie(shared.value)
        for b in batches:
            ids = b.column(0)
            for i, data, bounds in text_pieces(b.column(1), BLOCK_BYTES):
                raw = data.tobytes()
                lists = [raw[s:e].decode("utf-8", "replace").split() for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
                if len(trie.score) > NODES:
                    trie.reset()
                # sorted: neighbours share their path; counts of a pre-token are kept at its end
                code = {w: k for k, w in enumerate(sorted(set().union(*lists)))}
                found = [trie.look(MARK + w) for w in code]
                flat = np.fromiter((c for ws in lists for c in map(code.__getitem__, ws)), dtype=np.int64, count=sum(map(len, lists)))
                n = np.array([len(ws) for ws in lists], dtype=np.int64)
                doc = np.repeat(np.arange(len(lists)), n)
                s = np.array([x[0] for x in found])
                k = np.array([x[1] for x in found], dtype=np.int64)
                tokens = np.bincount(doc, k[flat], minlength=len(lists)) if len(flat) else np.zeros(len(lists))
                logp = np.bincount(doc, s[flat], minlength=len(lists)) if len(flat) else np.zeros(len(lists))
                yield batch(COUNT, ids.slice(i, len(lists)), n, tokens.astype(np.int64), np.round(logp, 6) + 0.0)
    return run


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_pretokens, n_tokens, log_prob)`` per row: tokens of the best
    segmentation of every pre-token of the whole text, and its log-probability."""
    on_executors(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(piece_scores(vocabulary_path))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_count(shared), "doc_id long, n_pretokens long, n_tokens long, log_prob double")
