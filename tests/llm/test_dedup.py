"""Exact, SimHash and embedding deduplication against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starkiln.llm import exact_dedup, simhash_dedup
from starkiln.llm.common import connected_components, star_edges
from starkiln.llm.embedding_dedup import embedding_dedup


def union(n, links):
    parent = list(range(n))

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(v) for v in range(n)]


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))]
    pairs += [(400 + i, 401 + i) for i in range(70)] + [(600, 600 + i) for i in range(200)] + [(5, 5)]
    want = union(900, pairs)
    got = connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert len({r.node for r in got}) == len(got)
    touched = {v for a, b in pairs if a != b for v in (a, b)}
    assert {r.node: r.component for r in got} == {v: want[v] for v in touched}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_star_edges():
    rng = np.random.default_rng(1)
    a, b = np.array([5, 1, 9, 12]), np.array([9, 7, 30, 31, 5])
    for _ in range(50):
        near = rng.random((4, 5)) < 0.2
        node, root = star_edges(a, b, near)
        ids = sorted({*a.tolist(), *b.tolist()})
        want = union(len(ids), [(ids.index(a[i]), ids.index(b[j])) for i, j in zip(*np.nonzero(near))])
        got = dict(zip(node.tolist(), root.tolist()))
        assert all(got.get(v, v) == ids[want[k]] for k, v in enumerate(ids))


TEXTS = ["", None, " ", "\t\n", "a b", "a  b", "a\nb", " a b", "a b ", "A b", "x" * 9000, "x" * 9001, "x" * 9000, "é ü", "é ü",
         "word " * 5000, "word\t" * 5000, "word " * 4999 + "wor", "ab" * 4096, "ba" * 4096, "ab" * 4097]


def test_exact_dedup(spark):
    rows = [(i * 7 % 64, t) for i, t in enumerate(TEXTS * 3)] + [(3, "same"), (3, "same"), (None, "same"), (None, None), (None, "only")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("name", F.lit(1)).withColumn("level", F.lit("x"))
    got = exact_dedup.exact_dedup(df.repartition(3), block=512).collect()
    norm = lambda t: re.sub("[ \t-\r]+", " ", t or "")
    groups = {}
    for d, t in rows:
        groups.setdefault(norm(t), []).append(d)
    want = sorted((str(d), str(min((x for x in groups[norm(t)] if x is not None), default=None)), len(groups[norm(t)]),
                   hashlib.sha256(norm(t).encode()).hexdigest()) for d, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def slow_fingerprint(text, words=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return 0
    sh = [b" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    rng = np.random.default_rng(5)
    many = " ".join(f"w{i}" for i in rng.integers(0, 50, 2000))
    for t in ["", None, "One", "One two", "one two three", "ONE  two\tthree four É é", many, many + " x", "  a b"]:
        assert simhash_dedup.fingerprint((t or "").encode(), 3) == slow_fingerprint(t)


def test_every_pair_within_three_bits_meets_at_a_home():
    rng = np.random.default_rng(9)
    x = rng.integers(0, 2**64, 400, dtype=np.uint64)
    y = x.copy()
    for k in range(len(y)):
        for b in rng.choice(64, k % 4, replace=False):
            y[k] ^= np.uint64(1) << np.uint64(b)
    hx, hy = simhash_dedup._words(x.view(np.int64)), simhash_dedup._words(y.view(np.int64))
    met = np.zeros(len(x), bool)
    for wx, wy in zip(hx, hy):
        home = simhash_dedup.home(wx)
        assert (np.bitwise_count(home ^ wx) <= 1).all() and (simhash_dedup.syndrome(home) == 0).all()
        rows, a = simhash_dedup.anchors(wy)
        assert (np.bitwise_count(a ^ wy[rows]) <= 2).all() and len(set(zip(rows.tolist(), a.tolist()))) == len(rows)
        met[rows[a == home[rows]]] = True
    assert met.all()


def test_simhash_dedup(spark):
    rng = np.random.default_rng(2)
    base = [[f"w{v}" for v in rng.integers(0, 400, rng.integers(60, 300))] for _ in range(12)]
    texts = [None, "", "  ", "solo", "Solo", "two words", "the the the"]
    for b in base:
        texts.append(" ".join(b))
        for _ in range(12):
            c = list(b)
            c[rng.integers(len(c))] = "changed"
            texts.append(" ".join(c))
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)] + [(7, texts[9]), (None, texts[10])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(0)).withColumn("rep", F.lit("x"))
    got = simhash_dedup.simhash_dedup(df)
    fps = [slow_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    root, least = union(len(rows), links), {}
    for (d, _), r in zip(rows, root):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    want = sorted((str(d), f"{f:016x}", str(least.get(r))) for (d, _), f, r in zip(rows, fps, root))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got.collect()) == want
    assert len(links) > 100 and len(set(root)) < len(rows) - 20
    assert simhash_dedup.simhash_dedup(df.limit(0)).count() == 0


def brute_vectors(rows, t):
    ok = [v is not None and l is not None and d is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
          for d, v, l in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.float32(rows[i][1]).astype(float), np.float32(rows[j][1]).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= t:
                    links.append((i, j))
    root, least, n = union(len(rows), links), {}, [0] * len(rows)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    for (d, _, _), r in zip(rows, root):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return sorted((str(d), k, str(least.get(r))) for (d, _, _), k, r in zip(rows, n, root))


@pytest.mark.parametrize("block", [4, 1024])
def test_embedding_dedup(spark, monkeypatch, block):
    from starkiln.llm import embedding_dedup as module

    monkeypatch.setattr(module, "cells_for", lambda n: 6)
    rng = np.random.default_rng(4)
    rows, d = [], 0
    for c in rng.normal(size=(14, 6)):
        for _ in range(9):
            v = c + rng.normal(size=6) * 0.12
            rows.append((d, v.tolist(), int(rng.integers(0, 2))))
            d += 1
    rows += [(d + i, v, l) for i, (v, l) in enumerate([
        (None, 0), ([], 0), ([0.0] * 6, 0), ([0.0] * 6, 0), ([1.0, None, 0.0, 0.0, 0.0, 0.0], 1), ([float("nan")] * 6, 1), ([float("inf")] * 6, 1),
        (rows[3][1], None), (rows[3][1], rows[3][2]), (rows[3][1], rows[3][2]), ([2 * x for x in rows[3][1]], rows[3][2]),
        ([-x for x in rows[3][1]], rows[3][2]), ([1.0, 2.0], 0), ([1.0, 2.001], 0)])]
    rows += [(rows[3][0], rows[3][1], rows[3][2]), (None, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1)).withColumn("m", F.lit("x"))
    got = embedding_dedup(df.repartition(3), block=block).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute_vectors(rows, 0.98)
    assert embedding_dedup(df.limit(0)).count() == 0
