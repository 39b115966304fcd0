"""Quality classifier: a generalised additive model with pairwise interactions.

Every document becomes a short vector of counts and ratios of its whole text.  Each feature
is cut into quantile bins.  Boosting goes round the features: in its turn a feature gets a
shallow tree on its own bins (Newton steps on the log loss), whose leaves are added to the
feature's lookup table; after the single features the strongest pairs get tables of their
own the same way.  A score is the logistic function of an intercept plus one table entry per
feature and pair: bin additions, vectorised over a batch.

The model is fitted on the driver from at most ``max_rows`` labelled documents, chosen by a
hash of the id (``MAX_ROWS``, documented bound); features of all documents are computed and
scored by Spark tasks in one pass without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound on the labelled documents whose features are collected to fit the model.
MAX_ROWS = 20_000

FEATURES = (
    "log_bytes", "log_words", "word_len", "upper", "digit", "symbol", "high_byte", "space", "exclaim", "pipe",
    "markup", "sentence_end", "comma", "distinct_words", "top_word", "same_next", "log_lines", "distinct_lines",
    "line_len", "distinct_pairs", "long_words", "one_letter",
)

_UPPER, _DIGIT = slice(65, 91), slice(48, 58)
_LOWER = slice(97, 123)


def features(text: bytes) -> list[float]:
    """The vector ``FEATURES`` of a text; an empty text gives zeros."""
    n = len(text)
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    c = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, digit, high = int(c[_UPPER].sum()), int(c[_DIGIT].sum()), int(c[128:].sum())
    letters = upper + int(c[_LOWER].sum()) + high
    space = int(c[9:14].sum() + c[32])
    k = len(words)
    counts = Counter(words)
    lines = text.split(b"\n")
    lengths = list(map(len, words))
    return [
        np.log1p(n), np.log1p(k), (n - space) / k, upper / max(letters, 1), digit / n,
        (n - space - letters - digit) / n, high / n, space / n, int(c[33]) / k, int(c[124]) / k,
        (int(c[60]) + int(c[62]) + int(c[123]) + int(c[125]) + int(c[92])) / k,
        (int(c[46]) + int(c[63])) / k, int(c[44]) / k, len(counts) / k,
        max(counts.values()) / k, sum(map(eq, words, words[1:])) / k, np.log1p(len(lines)),
        len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        len(set(zip(words, words[1:]))) / max(k - 1, 1), sum(x > 14 for x in lengths) / k,
        lengths.count(1) / k,
    ]


def matrix(texts) -> np.ndarray:
    rows = [features(t or b"") for t in texts]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


@dataclass
class AdditiveModel:
    """Bin edges, one table per feature and one per chosen pair."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            z += t[b[:, i], b[:, j]]
        return 1.0 / (1.0 + np.exp(-z))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, l2: float, least: float) -> np.ndarray:
    """A shallow tree on ordered bins: split the segment with the best gain until there are
    ``leaves`` leaves.  Returns the Newton step of each bin."""
    cg, ch = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])

    def best(a: int, b: int):
        if b - a < 2:
            return 0.0, a, b, -1
        s = np.arange(a + 1, b)
        gl, hl, gr, hr = cg[s] - cg[a], ch[s] - ch[a], cg[b] - cg[s], ch[b] - ch[s]
        gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + l2)
        gain = np.where((hl >= least) & (hr >= least), gain, 0.0)
        i = int(np.argmax(gain))
        return float(gain[i]), a, b, int(s[i])

    open_ = [best(0, len(g))]
    while len(open_) < leaves:
        k = max(range(len(open_)), key=lambda i: open_[i][0])
        gain, a, b, s = open_[k]
        if gain <= 1e-12:
            break
        open_[k:k + 1] = [best(a, s), best(s, b)]
    out = np.zeros(len(g))
    for _, a, b, _ in open_:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + l2)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[float, np.ndarray]:
    """A depth-2 tree on a grid: one cut on either axis, then a cut on the other axis in each part."""
    best_gain, best_step = 0.0, np.zeros_like(g)
    total = g.sum() ** 2 / (h.sum() + l2)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        ca, cb = np.cumsum(a, axis=0), np.cumsum(b, axis=0)
        for cut in range(1, a.shape[0]):
            gain, step = 0.0, np.zeros_like(a)
            for part, pg, ph in ((slice(0, cut), ca[cut - 1], cb[cut - 1]),
                                 (slice(cut, None), ca[-1] - ca[cut - 1], cb[-1] - cb[cut - 1])):
                leaf = _tree(pg, ph, 2, l2, least)
                step[part] = leaf
                gain += float((2 * pg * leaf - (ph + l2 / len(ph)) * leaf**2).sum())
            if gain - total > best_gain:
                best_gain, best_step = gain - total, step.T if flip else step
    return best_gain, best_step


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, rate: float = 0.1, leaves: int = 4,
        n_pairs: int = 6, pair_rounds: int = 25, l2: float = 1.0, least: float = 2.0) -> AdditiveModel:
    """Cyclic boosting of lookup tables.  With no rows, or one class only, the score is constant
    (0.5 without rows, else the smoothed share of the class)."""
    width = x.shape[1] if x.ndim == 2 else len(FEATURES)
    if not len(y):
        return AdditiveModel(0.0, [np.zeros(0)] * width, [np.zeros(1)] * width)
    p = (y.sum() + 0.5) / (len(y) + 1.0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    model = AdditiveModel(float(np.log(p / (1 - p))), edges, [np.zeros(len(e) + 1) for e in edges])
    if y.min() == y.max():
        return model
    b = model.bins(x)
    sizes = [len(t) for t in model.tables]
    z = np.full(len(y), model.intercept)

    def gradient():
        q = 1.0 / (1.0 + np.exp(-z))
        return y - q, q * (1 - q)

    for _ in range(rounds):
        for j in range(width):
            g, h = gradient()
            step = rate * _tree(np.bincount(b[:, j], g, sizes[j]), np.bincount(b[:, j], h, sizes[j]), leaves, l2, least)
            model.tables[j] += step
            z += step[b[:, j]]

    def grid(i, j, v):
        return np.bincount(b[:, i] * sizes[j] + b[:, j], v, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = gradient()
    ranked = sorted(((_pair_tree(grid(i, j, g), grid(i, j, h), l2, least)[0], i, j)
                     for i in range(width) for j in range(i + 1, width)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in ranked[:n_pairs] if gain > 0]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), t in zip(model.pairs, model.pair_tables):
            g, h = gradient()
            step = rate * _pair_tree(grid(i, j, g), grid(i, j, h), l2, least)[1]
            t += step
            z += step[b[:, i], b[:, j]]
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **params) -> AdditiveModel:
    """Fit on at most ``max_rows`` labelled documents that are not held out, chosen by a hash
    of their id.  Null labels and null ids are left out; a document labelled twice counts once
    with its smaller label."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )

    def measure(batches):
        for b in batches:
            x = matrix(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    # at most max_rows ids of 12 bytes: the limit bounds the broadcast
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        .join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")
        .mapInArrow(measure, "doc_id long, quality int, x array<double>").toArrow()
    )
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    x = np.array(rows.column("x").to_pylist(), float).reshape(rows.num_rows, len(FEATURES))[order]
    return fit(x, (rows.column("quality").to_numpy() > 0).astype(float)[order], **params)


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; only the text enters the score."""

    def run(batches):
        for b in batches:
            s = model.score(matrix(b.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("binary").alias("text")
                       ).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, model: AdditiveModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.5, all columns as they are, in one pass."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            x = matrix(b.column(at).cast(pa.binary()).to_pylist())
            yield b.filter(pa.array(model.score(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)


def quality_classifier(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **params) -> DataFrame:
    """Fit on the labelled rows that are not held out and score every document.

    A null text counts as empty; empty texts get the score of all-zero features.  A null
    doc_id is scored too (not held out).  Repeated rows get one row each.  Without usable
    labels the score is 0.5 everywhere; an empty ``docs`` gives an empty result.  Other
    columns of either table are ignored.
    """
    return score(docs, train(docs, labels, max_rows, **params))
