"""Attention model and language-model scores."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
from pyspark.sql import functions as F

from starkiln.llm import attention_lm as lm
from starkiln.llm import lm_scoring

BACK, STEP, SIZE, GROUPS = 3, 4, 16, 4


def small(dtype=np.float64, seed=1):
    rng = np.random.default_rng(seed)
    p = {k: v.astype(dtype) for k, v in lm.init(SIZE, GROUPS, 4, BACK, STEP).items()}
    lengths = np.array([10, 1, 5, 22])
    return p, rng.integers(0, SIZE, int((lengths + 1).sum())), lengths


def test_gradients():
    p, ids, lengths = small()
    text, first = lm.window_list(lengths, STEP)
    at, absent, scored = lm.window_ids(text, first, lengths, BACK, STEP)
    run = lambda: lm.gradients(p, ids[at], absent, ids[at[:, BACK:] + 1], scored, BACK, STEP)
    grad = run()[1]
    rng = np.random.default_rng(3)
    for k in p:
        for _ in range(4):
            i = tuple(rng.integers(0, n) for n in p[k].shape)
            old = p[k][i]
            p[k][i] = old + 1e-5
            up = run()[0]
            p[k][i] = old - 1e-5
            down = run()[0]
            p[k][i] = old
            assert abs((up - down) / 2e-5 - grad[k][i]) < 1e-6, k


def test_gradients_are_summed_by_token():
    """A step looks up what depends on the token only: it takes no product over all positions for
    queries, keys or values, and sums of repeated tokens are those of one row after the other."""
    rng = np.random.default_rng(2)
    for kind in (np.float32, np.float64):
        at, rows = rng.integers(0, 40, 3000), rng.normal(size=(3000, 8)).astype(kind)
        want = np.zeros((50, 8))
        np.add.at(want, at, rows)
        got = lm._sums(50, at, rows)
        assert got.dtype == kind and np.allclose(got, want, atol=1e-4)
    p, ids, lengths = small(np.float32)
    text, first = lm.window_list(lengths, STEP)
    at, absent, scored = lm.window_ids(text, first, lengths, BACK, STEP)
    for grow in (1, 3000):  # weights of any size leave numbers, also where all others have next to none
        loss, grad = lm.gradients({k: w * np.float32(grow) for k, w in p.items()}, ids[at], absent, ids[at[:, BACK:] + 1], scored, BACK, STEP)
        assert math.isfinite(loss) and all(np.isfinite(g).all() and g.dtype == np.float32 for g in grad.values())


def test_each_position_is_scored_once_and_the_loss_agrees():
    p, ids, lengths = small(np.float32)
    text, first = lm.window_list(lengths, STEP)
    at, absent, scored = lm.window_ids(text, first, lengths, BACK, STEP)
    hit = np.sort(at[:, BACK:][scored])
    starts = np.cumsum(lengths + 1) - lengths - 1
    assert hit.tolist() == sorted(s + k for s, n in zip(starts, lengths) for k in range(n))
    loss, _ = lm.gradients(p, ids[at], absent, ids[at[:, BACK:] + 1], scored, BACK, STEP)
    scorer = lm.Scorer(p, BACK, STEP)
    for batch in (1, 3, 256):
        assert math.isclose(-lm.score_texts(scorer, ids, lengths, batch).sum() / lengths.sum(), loss, rel_tol=1e-4)


def test_probabilities_sum_to_one_and_see_no_future():
    p, _, _ = small(np.float32)
    scorer = lm.Scorer(p, BACK, STEP)
    rng = np.random.default_rng(0)
    start = rng.integers(0, SIZE, 9)

    def last(prefix):  # log probability of the last token given those before it
        n = np.array([len(prefix) - 1])
        return lm.score_texts(scorer, prefix, n)[0] - (lm.score_texts(scorer, prefix[:-1], n - 1)[0] if len(prefix) > 2 else 0)

    for k in (1, 4, 8):
        total = sum(math.exp(last(np.append(start[:k], t))) for t in range(SIZE))
        assert math.isclose(total, 1.0, rel_tol=1e-4)


def test_grouping_is_a_permutation():
    counts = np.random.default_rng(0).integers(0, 9, (16, 16)).astype(float)
    assert sorted(lm.group_tokens(counts, 4).tolist()) == list(range(16))
    assert sorted(lm.group_tokens(np.zeros((16, 16)), 4).tolist()) == list(range(16))


def test_scores(spark, monkeypatch):
    for k, v in (("FIRST_STEPS", 150), ("TASK_SEGMENTS", 400), ("FIRST_SEGMENTS", 1500), ("AT_ONCE", 500)):
        monkeypatch.setattr(lm_scoring, k, v)
    rng = np.random.default_rng(8)
    vocab = {"x": ["alpha", "beta", "gamma", "delta", "eps"], "y": ["un", "deux", "trois", "quatre", "cinq"]}
    docs = [(i, " ".join(rng.choice(vocab["xy"[i % 2]], rng.integers(1, 60)))) for i in range(160)]
    docs += [(200, None), (201, ""), (202, "  \n\t "), (203, "Alpha  BETA\ngamma"), (204, "<|endoftext|> seltsam 日本 \xa0 é"),
             (205, "lang" * 2000), (3, docs[3][1]), (None, "alpha beta"), (206, " ".join(["alpha"] * 3000))]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).repartition(3)
    got = lm_scoring.lm_scores(df, P.path("byte_bpe_50k.json")).collect()
    words = [(d, (t or "").encode().lower().split()) for d, t in docs]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = collections.Counter(w for d, ws in words if not held(d) for w in ws)
    ends = sum(not held(d) for d, _ in words)
    n, v = sum(c.values()) + ends, len(c) + 1
    base = lambda ws: sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) + math.log10((ends + 1) / (n + v + 1))
    want = sorted((str(d), held(d), len(ws) + 1, sum(c[w] > 0 for w in ws) + 1, n, round(base(ws), 6)) for d, ws in words)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    plain = [r for r in got if r.doc_id is not None and r.doc_id < 160 and r.held_out]
    assert sum(r.score for r in plain) > sum(r.base_score for r in plain)  # it knows which of the two languages it reads
    twice = [r.score for r in got if r.doc_id == 3]
    assert len(twice) == 2 and math.isclose(*twice, rel_tol=1e-4)
    assert lm_scoring.lm_scores(df.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_every_position_of_every_training_document_is_learned(spark, monkeypatch):
    for k, v in (("FIRST_STEPS", 5), ("FIRST_SEGMENTS", 4), ("TASK_SEGMENTS", 3)):  # fewer segments than documents
        monkeypatch.setattr(lm_scoring, k, v)
    texts = [np.arange(n, dtype="<u2") for n in (2, 31, 32, 33, 34, 65, 700, 2, 2, 2)]  # equal ones too
    df = spark.createDataFrame([(bytearray(x.tobytes()),) for x in texts], "ids binary").repartition(2)
    assert lm_scoring.train_model(df, np.ones(lm_scoring.END + 1))[2] == sum(len(x) - 1 for x in texts)

    met, train = [], lm.train
    monkeypatch.setattr(lm_scoring.lm, "train", lambda p, ids, lengths, *a, **b: met.append((ids, lengths)) or train(p, ids, lengths, *a, **b))
    vocab = lm_scoring.Vocabulary(np.ones(lm_scoring.END + 1))
    params = lm.init(lm_scoring.SIZE, lm_scoring.GROUPS, lm_scoring.DIM, lm_scoring.BACK, lm_scoring.STEP)
    batch = pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in texts], pa.binary())], names=["ids"])
    list(lm_scoring._task_training(vocab, params)([batch]))
    got = [pair for ids, lengths in met for x in np.split(ids, np.cumsum(lengths + 1)[:-1]) for pair in zip(x[:-1].tolist(), x[1:].tolist())]
    want = [pair for x in texts for pair in zip(vocab.place[x[:-1]].tolist(), vocab.place[x[1:]].tolist())]
    assert sorted(got) == sorted(want) and max(lengths.sum() for _, lengths in met) <= 3 * lm_scoring.SEGMENT
