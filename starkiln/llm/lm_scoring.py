"""Language-model scores of documents, with a word-unigram base score beside them.

1. A task turns each chunk of documents (an Arrow batch) into a dictionary of its distinct
   words, with their counts in training documents, and the documents as numbers of words.
2. The dictionaries are dealt by word and sorted: every word gets its corpus count and its
   subword ids once, however many chunks hold it.  A word that is in every document has one
   row per chunk, so no word is hot.
3. Counts and subword ids go back to the chunks, where every document becomes its ids.
4. A causal self-attention model over the subword ids starts on the driver from a bounded
   sample of segments, then learns every position of every training document, at any input
   size: many tasks at once, each on the documents it reads, whose parameters are averaged.
5. Documents are scored: overlapping windows, every position once.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import attention_lm as lm
from .common import stored

#: Tokens with a place of their own in the model (the last place stands for all others), and groups.
SIZE, GROUPS = 1024, 32
DIM, BACK, STEP = 32, 8, 16
#: Positions of a segment; segments that the driver starts from (documented bound); segments a
#: task holds at once while it learns all of its documents.
SEGMENT, FIRST_SEGMENTS, TASK_SEGMENTS = 32, 24_576, 32_768
FIRST_STEPS = 600
END = 50256
#: Positions scored at once.
AT_ONCE = 100_000
WORD, DOC = 0, 1
_SHAPE = "kind tinyint, chunk long, lid int, word binary, n long, pos int, doc_id long, held_out boolean, lids binary"
_ARROW = pa.schema([("kind", pa.int8()), ("chunk", pa.int64()), ("lid", pa.int32()), ("word", pa.binary()), ("n", pa.int64()),
                    ("pos", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lids", pa.binary())])


def is_held_out(doc_id: int | None) -> bool:
    """crc32 of the id as text, modulo 7, is 2; a null id is not held out."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _rows(kind: int, chunk: int, rows: int, **columns) -> pa.RecordBatch:
    values = {"kind": pa.array(np.full(rows, kind, np.int8)), "chunk": pa.array(np.full(rows, chunk, np.int64))}
    values |= {f.name: pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in _ARROW if f.name not in values}
    return pa.RecordBatch.from_arrays([values[f.name] for f in _ARROW], schema=_ARROW)


def _chunks(batches):
    """Words by chunk, and documents as word numbers."""
    part = TaskContext.get().partitionId() << 32
    for k, b in enumerate(batches):
        if not b.num_rows:
            continue
        docs, lid = b.column(0).to_pylist(), {}
        held = [is_held_out(d) for d in docs]
        lists, learn = [], []
        for h, text in zip(held, b.column(1).to_pylist()):
            ids = np.array([lid.setdefault(w, len(lid)) for w in (text or b"").lower().split()], np.int32)
            lists.append(ids.tobytes())
            if not h:
                learn.append(ids)
        n = np.bincount(np.concatenate(learn) if learn else np.zeros(0, np.int32), minlength=len(lid))
        chunk = part | k
        if lid:
            yield _rows(WORD, chunk, len(lid), lid=np.arange(len(lid), dtype=np.int32), word=list(lid), n=n)
        yield _rows(DOC, chunk, len(docs), pos=np.arange(len(docs), dtype=np.int32), doc_id=docs, held_out=held, lids=lists)


def _totals(path: str):
    """Rows sorted by word: the corpus count and the subword ids of each word, for every chunk that has it."""

    def run(batches):
        from .byte_bpe import encoder

        enc = encoder(path)

        def tell(chunk, lid, n, words):
            first = np.flatnonzero(np.array([True, *(a != b for a, b in zip(words, words[1:]))]))
            size = np.diff(np.append(first, len(words)))
            ids = enc.unit_ids([words[i] for i in first.tolist()])
            enc.units.clear()  # words come sorted: none comes again
            head = np.zeros(len(words), bool)
            head[first] = True
            return pa.RecordBatch.from_arrays(
                [pa.array(chunk), pa.array(lid), pa.array(np.repeat(np.add.reduceat(n, first), size)),
                 pa.array(ids, pa.binary()).take(pa.array(np.repeat(np.arange(len(ids)), size))), pa.array(head)],
                names=["chunk", "lid", "c", "ids", "head"])

        kept = None
        for b in batches:
            if not b.num_rows:
                continue
            now = [b.column("chunk").to_numpy(), b.column("lid").to_numpy(), b.column("n").to_numpy(), b.column("word").to_pylist()]
            if kept is not None:
                now = [np.concatenate([a, x]) for a, x in zip(kept[:3], now[:3])] + [kept[3] + now[3]]
            words, last = now[3], len(now[3])
            while last and words[last - 1] == words[-1]:  # the last word may go on in the next batch
                last -= 1
            kept = [x[last:] for x in now]
            if last:
                yield tell(*(x[:last] for x in now))
        if kept is not None:
            yield tell(*kept)
    return run


def _id_counts(batches):
    """Subword ids weighted by the counts of their words, summed within the task."""
    total = np.zeros(END + 1, np.int64)
    for b in batches:
        ids, sizes = _flat(b.column("ids"))
        total += np.bincount(ids, np.repeat(b.column("c").to_numpy(), sizes), END + 1).astype(np.int64)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a binary column one after the other, and how many each row has."""
    if not len(col):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(col.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return raw.view("<u4").astype(np.int64), np.diff(offsets) // 4


class Vocabulary:
    """Places of subword ids in the model, and the log probability within the last place."""

    def __init__(self, counts: np.ndarray):
        ranked = [i for i in np.argsort(-counts, kind="stable").tolist() if i != END][:SIZE - 2]
        own = np.array([END, *ranked])
        self.place = np.full(END + 1, SIZE - 1, np.int64)
        self.place[own] = np.arange(len(own))
        rest = np.ones(END + 1, bool)
        rest[own] = False
        self.extra = np.zeros(END + 1)
        self.extra[rest] = np.log((counts[rest] + 1) / (counts[rest].sum() + rest.sum()))

    def arrange(self, order: np.ndarray) -> None:
        place = np.empty(SIZE, np.int64)
        place[order] = np.arange(SIZE)
        self.place = place[self.place]


def _segments(ids: np.ndarray) -> list[np.ndarray]:
    """A document's ids cut into consecutive segments: each position after the first id is the
    target of one segment, whose first id is the last one of the segment before."""
    return [ids[i:i + SEGMENT + 1] for i in range(0, len(ids) - 1, SEGMENT)]


def _sample(batches):
    """The FIRST_SEGMENTS segments with the smallest hashes of what the task reads."""
    h, kept = np.zeros(0, np.uint64), []
    for b in batches:
        new = [x.tobytes() for d in b.column(0).to_pylist() for x in _segments(np.frombuffer(d, "<u2"))]
        if new:
            h, kept = np.append(h, np.array([xxhash.xxh64_intdigest(x) for x in new], np.uint64)), kept + new
            at = np.argsort(h, kind="stable")[:FIRST_SEGMENTS]
            h, kept = h[at], [kept[i] for i in at.tolist()]
    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64) ^ np.int64(-2**63)), pa.array(kept, pa.binary())], names=["h", "ids"])


def _sequences(vocab: Vocabulary, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ids of texts (of two ids at least) one after the other, and their positions."""
    return (vocab.place[np.concatenate(texts)] if texts else np.zeros(0, np.int64)), np.array([len(x) - 1 for x in texts], np.int64)


def _task_training(vocab: Vocabulary, params: dict):
    """One pass over every position of the task's documents, TASK_SEGMENTS segments at a time; the
    parameters in blocks, with the positions seen as weight."""

    def run(batches):
        p, seen = {k: v.copy() for k, v in params.items()}, 0
        held, size = [], 0
        most = TASK_SEGMENTS * SEGMENT

        def learn():
            ids, lengths = _sequences(vocab, held)
            lm.train(p, ids, lengths, BACK, STEP, steps=-(-len(lm.window_list(lengths, STEP)[0]) // 256), rate=0.004)
            return int(lengths.sum())

        for b in batches:
            for d in b.column(0).to_pylist():
                ids, at = np.frombuffer(d, "<u2"), 0
                while at < len(ids) - 1:  # a long document goes on in the next round
                    x = ids[at:at + most - size + 1]
                    held.append(x)
                    at, size = at + len(x) - 1, size + len(x) - 1
                    if size == most:
                        seen += learn()
                        held, size = [], 0
        if held:
            seen += learn()
        if seen:
            flat = np.concatenate([p[k].ravel() for k in sorted(p)]) * np.float32(seen)
            blocks = [flat[i:i + 8192] for i in range(0, len(flat), 8192)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(blocks), dtype=np.int32)), pa.array([x.tobytes() for x in blocks], pa.binary()),
                 pa.array(np.full(len(blocks), seen, np.int64))], names=["block", "sums", "weight"])
    return run


def _add_blocks(t):
    total = np.zeros(len(t.column("sums")[0].as_py()) // 4, np.float64)
    for x in t.column("sums").to_pylist():
        total += np.frombuffer(x, np.float32)
    weight = int(np.sum(t.column("weight").to_numpy()))
    return pa.table({"block": t.column("block")[:1], "mean": pa.array([(total / max(1, weight)).astype(np.float32).tobytes()], pa.binary()),
                     "weight": pa.array([weight], pa.int64())})


def train_model(texts: DataFrame, counts: np.ndarray) -> tuple[Vocabulary, dict[str, np.ndarray], int]:
    """texts: ids of the training documents.  The driver starts from FIRST_SEGMENTS segments at
    most, the tasks learn from every position; the last value is how many they were."""
    vocab = Vocabulary(counts)
    first = texts.mapInArrow(_sample, "h long, ids binary").orderBy("h", "ids").limit(FIRST_SEGMENTS).select("ids").toArrow()
    start = [np.frombuffer(x, "<u2") for x in first.column(0).to_pylist()]
    ids, lengths = _sequences(vocab, start)
    met = np.zeros((SIZE, SIZE))
    np.add.at(met, (ids[:-1], ids[1:]), 1)
    vocab.arrange(lm.group_tokens(met, GROUPS))
    params = lm.init(SIZE, GROUPS, DIM, BACK, STEP)
    ids, lengths = _sequences(vocab, start)
    lm.train(params, ids, lengths, BACK, STEP, FIRST_STEPS, rate=0.02)
    parts = texts.mapInArrow(_task_training(vocab, params), "block int, sums binary, weight long")
    mean = parts.groupBy("block").applyInArrow(_add_blocks, "block int, mean binary, weight long").toArrow().sort_by("block")
    if not mean.num_rows:
        return vocab, params, 0
    flat = np.frombuffer(b"".join(mean.column("mean").to_pylist()), np.float32)
    at = 0
    for k in sorted(params):
        n = params[k].size
        params[k] = flat[at:at + n].reshape(params[k].shape).copy()
        at += n
    return vocab, params, mean.column("weight")[0].as_py()


_TEXT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                   ("base_score", pa.float64()), ("ids", pa.binary())])


def _texts(n_train: int, kinds: int, ends: int):
    """The documents of a chunk as subword ids (two bytes each) between end tokens, and what is known by word."""
    floor = math.log10(n_train + kinds + 1)
    end_base = math.log10(ends + 1) - floor
    end = np.array([END], "<u2").tobytes()

    def run(docs, words):
        """One chunk."""
        order = np.argsort(words.column("lid").to_numpy())
        c = words.column("c").to_numpy()[order]
        col = words.column("ids").combine_chunks()
        col = (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).take(pa.array(order))
        raw, sizes = _flat(col)
        raw, starts = raw.astype("<u2"), np.cumsum(sizes) - sizes
        logs = np.log10(c + 1.0) - floor
        n, known, base, out = [], [], [], []
        for x in docs.column("lids").to_pylist():
            w = np.frombuffer(x, np.int32)
            k = sizes[w]
            inner = np.repeat(starts[w] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
            n.append(len(w) + 1)
            known.append(int((c[w] > 0).sum()) + (ends > 0))
            base.append(math.fsum(logs[w]) + end_base)
            out.append(end + raw[inner].tobytes() + end)
        return pa.table([docs.column("doc_id"), docs.column("held_out"), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                         pa.array(base, pa.float64()), pa.array(out, pa.binary())], schema=_TEXT)
    return run


def _score(vocab: Vocabulary, params: dict, n_train: int):
    def run(batches):
        scorer = lm.Scorer(params, BACK, STEP)
        for b in batches:
            lists, score = [np.frombuffer(x, "<u2") for x in b.column("ids").to_pylist()], np.zeros(b.num_rows)
            i = 0
            while i < len(lists):
                j, total = i, 0
                while j < len(lists) and (j == i or total + len(lists[j]) < AT_ONCE):
                    total += len(lists[j])
                    j += 1
                raw, per = np.concatenate(lists[i:j]), np.array([len(x) for x in lists[i:j]])
                score[i:j] = lm.score_texts(scorer, vocab.place[raw], per - 1) + np.bincount(np.repeat(np.arange(j - i), per), vocab.extra[raw], j - i)
                i = j
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in ("doc_id", "held_out", "n_tokens", "n_known")), pa.array(np.full(b.num_rows, n_train, np.int64)),
                 b.column("base_score"), pa.array(score / math.log(10))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def lm_scores(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words between ASCII white space, A-Z lower-cased, and one end token.
    ``base_score``: log10 of the add-one unigram probabilities, counts from documents that are
    not held out.  ``score``: the attention model's log10 probability of the words' subword ids
    and the end.  A null text counts as empty (the end token alone).  A null doc_id is not held
    out.  Repeated rows count each time.  An empty table gives an empty result.  Other columns
    are ignored.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    base = stored(src.mapInArrow(_chunks, _SHAPE), "lm-chunks")
    words = base.filter(F.col("kind") == WORD).select("chunk", "lid", "n", "word")
    totals = stored(words.repartition("word").sortWithinPartitions("word").mapInArrow(
        _totals(tokenizer_path), "chunk long, lid int, c long, ids binary, head boolean"), "lm-words")
    heads = totals.filter("head AND c > 0")
    whole = heads.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    ends = base.filter((F.col("kind") == DOC) & ~F.col("held_out")).count()
    counts = np.zeros(END + 1)
    for r in heads.select("c", "ids").mapInArrow(_id_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r.id] = r.n  # at most one row per id of the tokenizer
    counts[END] = ends
    n_train = int(whole.n or 0) + ends
    told = base.filter(F.col("kind") == DOC).select("chunk", "doc_id", "held_out", "lids")
    texts = stored(told.groupBy("chunk").cogroup(totals.select("chunk", "lid", "c", "ids").groupBy("chunk")).applyInArrow(
        _texts(n_train, whole.v + (ends > 0), ends),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, ids binary"), "lm-texts")
    vocab, params, _ = train_model(texts.filter("NOT held_out").select("ids"), counts)
    return texts.mapInArrow(
        _score(vocab, params, n_train),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
