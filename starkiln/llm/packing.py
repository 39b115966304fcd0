"""Order-preserving packing by dynamic programming over window cuts.

The documents of a task stand one after the other as a stream of tokens, taken in blocks of
whole documents.  Cuts are allowed at document ends, at sentence ends (at a penalty, as they
truncate a document) and, inside a long sentence, every ``GRID`` tokens (at a higher penalty).  With x the position and f the least cost up to a cut,

    f(j) = penalty(j) + min over i, 0 < x(j) - x(i) <= window, of f(i) + pad(x(j) - x(i)),

where pad(n) is 0 if n is a power of two and window - n otherwise, plus a constant for each
sequence.  The second kind is
window - x(j) + min(f(i) + x(i)) over a sliding window: a monotone queue gives it in constant
time; for the first kind there are at most log2(window) + 1 positions to look at.

Packing needs no shuffle: a task packs the documents it reads, and a block ends with a
document, where the cost of the last window is part of the same minimum.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
#: Cost, in tokens of padding, of cutting a document at a sentence end or inside a sentence.
SENTENCE_PENALTY, INNER_PENALTY = 2.0, 4.0
#: Cost, in tokens of padding, of one more sequence: keeps short ones (which need no padding
#: at a power of two) for where they save more than that.
SEQUENCE_COST = 256.0
#: Sentences of more than ``LONG`` tokens also offer cuts every ``GRID`` tokens.
LONG, GRID = 48, 16
#: Tokens gathered before a block is packed (more if a document is longer).
BLOCK_TOKENS = 1 << 18
END_ID = 0

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def candidates(doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int, grid: int = GRID):
    """Sorted cut positions and their penalties; no gap is wider than the window."""
    x = np.union1d(np.concatenate([[0], doc_ends]), sentence_ends)
    gaps = np.diff(x)
    wide = np.flatnonzero(gaps > min(LONG, window))
    extra = [np.arange(x[k] + min(grid, window), x[k + 1], min(grid, window)) for k in wide]
    inner = np.concatenate(extra) if extra else np.zeros(0, np.int64)
    x = np.union1d(x, inner)
    penalty = np.where(np.isin(x, inner), INNER_PENALTY, SENTENCE_PENALTY)
    penalty[np.isin(x, doc_ends)] = 0.0
    return x.astype(np.int64), penalty


def cuts(x: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the best cuts (first is 0, last is x[-1])."""
    n = len(x)
    place = np.full(int(x[-1]) + 1, -1, np.int64)
    place[x] = np.arange(n)
    exact: list[list[int] | None] = [None] * n
    size = window
    while size:
        # short windows that need no padding are of use at the end only
        at = np.arange(1, n) if size >= window // 8 else np.array([n - 1])
        back = x[at] - size
        i = np.where(back >= 0, place[np.maximum(back, 0)], -1)
        ok = np.flatnonzero(i >= 0)
        for j, k in zip(at[ok].tolist(), i[ok].tolist()):
            if exact[j] is None:
                exact[j] = [k]
            else:
                exact[j].append(k)
        size //= 2
    xs, key, prev = x.tolist(), [0] * n, [0] * n  # key: cost up to a cut plus its position
    queue, head = [0], 0
    for j, (at, extra, also) in enumerate(zip(xs, penalty.tolist(), exact)):
        if not j:
            continue
        low = at - window
        while xs[queue[head]] < low:
            head += 1
        best = queue[head]
        least = key[best] + window + SEQUENCE_COST
        if also:
            for i in also:
                if (cost := key[i] - xs[i] + at + SEQUENCE_COST) < least:
                    best, least = i, cost
        prev[j] = best
        key[j] = least = least + extra
        while len(queue) > head and key[queue[-1]] >= least:
            queue.pop()
        queue.append(j)
    out, j = [xs[n - 1]], n - 1
    while j:
        j = prev[j]
        out.append(xs[j])
    return np.array(out[::-1], np.int64)


def pack_block(doc_ids: list, ids: list[bytes], sentence_end: np.ndarray, first_sequence: int, window: int = WINDOW):
    """Pack one block; ``ids`` are little-endian 32-bit ids.  Returns the piece columns and
    the number of sequences."""
    raw = b"".join(ids)
    tokens = np.frombuffer(raw, "<u4")
    lengths = np.array([len(b) // 4 for b in ids], np.int64)
    ends = np.cumsum(lengths)
    x, penalty = candidates(ends, np.flatnonzero(sentence_end[tokens]) + 1, window)
    c = cuts(x, penalty, window)
    starts = ends - lengths
    begin = np.union1d(c[:-1], starts)
    stop = np.append(begin[1:], ends[-1])
    doc = np.searchsorted(ends, begin, side="right")
    seq = np.searchsorted(c, begin, side="right") - 1
    crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), stop.tolist())]
    columns = [pa.array([doc_ids[k] for k in doc.tolist()], pa.int64()), pa.array(begin - starts[doc]), pa.array(stop - begin),
               pa.array(crc, pa.int64()), pa.array(lengths[doc]), pa.array(seq + first_sequence), pa.array(begin - c[seq])]
    return columns, len(c) - 1


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids followed by id 0; a null or empty text is that one id.  Every id
    lies in exactly one piece, pieces of a sequence follow each other without a gap and hold
    at most ``window`` ids.  A sequence is padded to ``window`` unless its length is a power
    of two.  Repeated rows are packed one by one; a null doc_id is kept; an empty table gives
    an empty result.  Other columns are ignored.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("the window must be a power of two")

    def run(batches):
        from .byte_bpe import encoder

        enc = encoder(tokenizer_path)
        sentence_end = np.zeros(len(enc.spaced), bool)
        for s, i in enc.vocab.items():
            sentence_end[i] = s.endswith((b".", b"!", b"?", b"\n"))
        end = np.array([END_ID], "<u4").tobytes()
        made, names, held, size = TaskContext.get().partitionId() << 40, [], [], 0

        def flush():
            nonlocal made, names, held, size
            columns, count = pack_block(names, held, sentence_end, made, window)
            made, names, held, size = made + count, [], [], 0
            return pa.RecordBatch.from_arrays(columns, names=_NAMES)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                names.append(doc)
                held.append(enc.encode(text or b"") + end)
                size += len(held[-1]) // 4
                if size >= block_tokens:
                    yield flush()
        if names:
            yield flush()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(run, SCHEMA)
