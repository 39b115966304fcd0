"""Quality classifier, packing of a table, packed rows of a table, the pipeline and the registry."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from starkiln.llm import quality_classifier as qc
from starkiln.llm import registry
from starkiln.llm.bpe_codec import digests, encode_decode
from starkiln.llm.packing import pack
from starkiln.llm.token_counts import token_counts
from starkiln.llm.token_output import token_rows
from test_dedup import slow_fingerprint, union

BYTE = P.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "one"), (4, "a. b! c?\n" * 900), (5, "x" * 9000), (6, "<|endoftext|> and  more"), (7, "é ü 日本"),
       (3, "one"), (None, "no id"), (8, "Word. " * 4000)]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("score", F.lit("x"))


def ids_of(t):
    return Tokenizer.from_file(BYTE).encode(t or "", add_special_tokens=False).ids


def test_interaction_needs_the_pair_tables():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(qc.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    plain = qc.fit(x[:3000], y[:3000], n_pairs=0)
    full = qc.fit(x[:3000], y[:3000])
    right = lambda m: ((m.score(x[3000:]) >= 0.5) == y[3000:]).mean()
    assert (0, 1) in full.pairs and right(full) > 0.93 > 0.6 > right(plain)


def test_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.random((500, len(qc.FEATURES)))
    m = qc.fit(x, (x[:, 2] + rng.normal(size=500) * 0.1 > 0.5).astype(float), rounds=10, pair_rounds=3)
    b = m.bins(x[:5])
    for r in range(5):
        z = m.intercept + sum(t[b[r, j]] for j, t in enumerate(m.tables)) + sum(t[b[r, i], b[r, j]] for (i, j), t in zip(m.pairs, m.pair_tables))
        assert np.isclose(m.score(x[r:r + 1])[0], 1 / (1 + np.exp(-z)))
    assert qc.fit(np.zeros((0, len(qc.FEATURES))), np.zeros(0)).score(x[:2]).tolist() == [0.5, 0.5]
    assert len(set(qc.fit(x, np.ones(500)).score(x).tolist())) == 1


def test_quality_on_held_out_documents(spark):
    got = registry.op1_quality_classifier(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().set_index("doc_id").quality
    assert ((got.score >= 0.5) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    assert got.held_out.tolist() == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got.doc_id]
    held = got[got.held_out & got.doc_id.isin(labels.index)]
    right = (held.predicted.values == labels.loc[held.doc_id].values).mean()
    assert right > 0.95


def test_quality_edge_cases(spark):
    labels = spark.createDataFrame([(1, 0, 0), (3, 1, 0), (4, None, 0), (None, 1, 1), (3, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    got = qc.quality_classifier(odd(spark), labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in qc.quality_classifier(odd(spark), labels.limit(0)).collect()} == {0.5}
    assert qc.quality_classifier(odd(spark).limit(0), labels).count() == 0
    assert qc.keep(odd(spark), qc.train(odd(spark), labels.limit(0))).count() == len(ODD)


def test_pack(spark):
    got = pack(odd(spark).coalesce(1), BYTE, block_tokens=3000).collect()
    docs = collections.defaultdict(list)
    seqs = collections.defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for rows in seqs.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == np.cumsum([0, *(r.length for r in rows)])[:-1].tolist()
        assert sum(r.length for r in rows) <= 1024
    for d, t in ODD:
        ids = np.array([*ids_of(t), 0], "<u4")
        copies = sum(x == d for x, _ in ODD)
        assert sum(r.length for r in docs[d]) == len(ids) * copies
        for r in docs[d]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    assert pack(odd(spark).limit(0), BYTE).count() == 0


def test_token_rows(spark):
    got = token_rows(odd(spark).coalesce(1), BYTE, width=256, chunk_tokens=2000).collect()
    back = collections.defaultdict(dict)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            back[d].setdefault(s, []).append(ids[a:b].tolist())
    for d, t in ODD:
        copies = sum(x == d for x, _ in ODD)
        assert all(len(v) == copies for v in back[d].values())
        assert [i for s in sorted(back[d]) for i in back[d][s][0]] == ids_of(t)
    assert token_rows(odd(spark).limit(0), BYTE).count() == 0


def test_codec_and_counts_on_a_table(spark):
    path = P.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    want = []
    for d, t in ODD:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        raw, text = np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False).encode()
        want.append((str(d), len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text).hexdigest()))
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests(odd(spark), path).collect()]
    assert sorted(got) == sorted(want)
    assert {hashlib.sha256(r.ids).hexdigest() for r in encode_decode(odd(spark), path).collect()} == {w[2] for w in want}
    assert digests(odd(spark).limit(0), path).count() == 0
    counts = token_counts(odd(spark), P.path("piece_bpe_32k.model")).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in counts) == sorted((str(d), len((t or "").split())) for d, t in ODD)
    assert token_counts(odd(spark).limit(0), P.path("piece_bpe_32k.model")).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now, rows = docs, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        now = spark.createDataFrame(stage(spark, now, SF).toPandas(), docs.schema)
        kept = {r.doc_id for r in now.select("doc_id").collect()}
        if name == "quality":
            bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0").collect()}
            good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
            assert len(good - kept) <= 1 and len(bad & kept) <= 1
        else:
            ids = sorted(rows)
            if name == "exact":
                key = [re.sub("[ \t-\r]+", " ", rows[d]) for d in ids]
                links = [(i, j) for i in range(len(ids)) for j in range(i) if key[i] == key[j]]
            else:
                key = [slow_fingerprint(rows[d]) for d in ids]
                links = [(i, j) for i in range(len(ids)) for j in range(i) if (key[i] ^ key[j]).bit_count() <= 3]
            assert kept == {ids[r] for r in union(len(ids), links)}
        rows = {d: rows[d] for d in kept}
    pieces = corpus_pipeline.packing(spark, now, SF).collect()
    assert {r.doc_id for r in pieces} == set(rows)
    total = collections.Counter()
    for r in pieces:
        total[r.doc_id] += r.length
    assert all(total[r.doc_id] == r.doc_tokens for r in pieces)


def test_stages_take_empty_tables_nulls_and_repeats(spark):
    extra = spark.createDataFrame([(1, None, "en", "s", 0), (1, None, "en", "s", 0), (None, "same text here", None, None, None),
                                   (None, "same text here", None, None, None), (2, "same  text here", "en", "s", 5)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, extra.limit(0), SF).count() == 0
    got = corpus_pipeline.exact(spark, extra, SF)
    assert got.columns == extra.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "2"]
    assert corpus_pipeline.near(spark, got, SF).columns == extra.columns


def test_registered_names():
    assert {int(n[2:].split("_")[0]) for n in registry.QUERIES if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in registry.QUERIES and set(registry.ORACLES) <= set(registry.QUERIES)
