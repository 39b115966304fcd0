"""Token counts by dynamic programming shared over a trie.

The pieces of a vocabulary carry unigram log scores.  Distinct pre-tokens (a word-start mark
and the word) are inserted in a trie; a node holds the best forward score of its prefix and
the number of pieces on that path.  Both depend on the prefix only, so they are computed once
per node, from the nodes above it, and serve every pre-token that shares the prefix.  The
count at a pre-token's last node is stored; a document's count is the sum over its words.

Nothing is shuffled: a task counts the documents it reads, with a trie per worker process
that is emptied when it reaches a fixed number of nodes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Nodes and pre-tokens kept by a worker process.
NODES, WORDS = 300_000, 300_000
#: Marks the start of a word in the vocabulary.
MARK = "▁"


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """Log probabilities of a vocabulary in order of rank, if frequencies follow Zipf's law."""
    total = math.log(sum(1.0 / (r + 1) for r in range(len(pieces))))
    return {p: -math.log(r + 1) - total for r, p in enumerate(pieces)}


def load_pieces(path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece file, in the order of its ids."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]


class SharedTrie:
    """Forward scores of all prefixes met so far.

    Nodes are numbers.  ``tails`` is a trie of the vocabulary's pieces read backwards: from a
    new node it is followed up the path for as long as some piece ends like this.
    """

    def __init__(self, scores: dict[str, float], nodes: int = NODES, words: int = WORDS):
        self.scores = scores
        self.byte_score = min(scores.values(), default=0.0) - 1.0
        self.max_nodes, self.max_words = nodes, words
        self.tails: dict = {}
        for piece, s in scores.items():
            at = self.tails
            for c in reversed(piece):
                at = at.setdefault(c, {})
            at[""] = s
        self.counts: dict[bytes, int] = {}
        self.sums: dict[bytes, float] = {}
        self._empty()

    def _empty(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.best, self.count = [0.0], [0]

    def insert(self, word: bytes) -> None:
        """Put a pre-token in the trie and store the count and the score of its last node.
        Equal scores: fewer pieces.  A character without a piece costs one piece per byte."""
        if len(self.best) > self.max_nodes:
            self._empty()
        token, node, path = MARK + word.decode("utf-8", "replace"), 0, [0]
        children, best, count, tails = self.children, self.best, self.count, self.tails
        for i, c in enumerate(token):
            below = children.get((node, c))
            if below is None:
                at = tails.get(c)
                if at is None or "" not in at:
                    k = len(c.encode())
                    top, n = best[node] + k * self.byte_score, count[node] + k
                else:
                    top, n = -math.inf, 0
                j = i
                while at is not None:
                    s = at.get("")
                    if s is not None:
                        p = path[j]
                        s += best[p]
                        if s > top or s == top and count[p] + 1 < n:
                            top, n = s, count[p] + 1
                    if not j:
                        break
                    j -= 1
                    at = at.get(token[j])
                below = children[node, c] = len(best)
                best.append(top)
                count.append(n)
            node = below
            path.append(node)
        self.counts[word], self.sums[word] = count[node], best[node]

    def count_text(self, text: bytes) -> tuple[int, int, float]:
        """Words between ASCII white space, pieces, and the sum of the best scores."""
        words = text.split()
        if len(self.counts) > self.max_words:
            self.counts.clear()
            self.sums.clear()
        for w in [w for w in set(words) if w not in self.counts]:
            self.insert(w)
        return len(words), sum(map(self.counts.__getitem__, words)), math.fsum(map(self.sums.__getitem__, words))


_TRIES: dict[str, SharedTrie] = {}


def trie(path: str) -> SharedTrie:
    if path not in _TRIES:
        _TRIES[path] = SharedTrie(zipf_scores(load_pieces(path)))
    return _TRIES[path]


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_tokens, log_score.

    A null or empty text has no words and no tokens and scores 0.  Null ids and repeated rows
    are kept row by row; an empty table gives an empty result; other columns are ignored.
    """

    def run(batches):
        t = trie(vocabulary_path)
        for b in batches:
            rows = [t.count_text(x or b"") for x in b.column(1).to_pylist()]
            words, tokens, score = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(words, np.int64)), pa.array(np.array(tokens, np.int64)),
                 pa.array(np.array(score, float))], names=["doc_id", "n_words", "n_tokens", "log_score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
                       ).mapInArrow(run, "doc_id long, n_words long, n_tokens long, log_score double")
