"""Filter interaction audit, quality rules and phrase mining against brute force and DuckDB."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from checks.compare import duck
from starkiln.llm import interaction_audit as IA
from starkiln.llm import phrase_mining as PM
from starkiln.llm import quality_rules as QR
from starkiln.llm.common import scratch, spread_join
from starkiln.llm.registry import ORACLES

WORD = r"[^\x20\x09-\x0D]+"


def compare_duck(name, got, tables):
    import duckdb

    con = duckdb.connect()
    for n, df in tables.items():
        con.register(n, df.toArrow())
    want = con.execute(ORACLES[name]).to_arrow_table().to_pylist()
    row = lambda r: tuple(str(r[c]) for c in sorted(r))
    assert sorted(map(row, (r.asDict() for r in got.collect()))) == sorted(map(row, want))


# -- audit -----------------------------------------------------------------------------------------
def audit_rows():
    rng = random.Random(5)
    texts = ["", None, "AB cd " * 30, "one two " * 40, " ".join(f"w{i}" for i in range(60)), "a|b " + " ".join(f"w{i}" for i in range(70)),
             "ABC DEF " * 20 + " ".join(f"w{i}" for i in range(90)), "x#", "y " * 30_000]
    rows = [(rng.randint(0, 40), rng.choice(texts), rng.choice(["s", "t", None])) for _ in range(150)]
    return rows + [(None, texts[3], "s"), (None, texts[3], "t"), (7, texts[4], "s"), (7, texts[4], "s"), (9_007_199_254_740_993, texts[3], "s")]


def brute_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    fails = defaultdict(list)
    for d, t, part in rows:
        t = t or ""
        w = re.findall(WORD, t)
        f = {x for x, hit in zip("ABCDE", [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                                           re.search("[#$%&*|]", t), d is not None and d > least[t]]) if hit}
        fails[part or ""].append((f, d in good, d in toxic))
    out = set()
    for part, docs in fails.items():
        shapley = Counter()
        steps = []
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for s, x in enumerate(order):
                gone = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                shapley[x] += len(gone)
                steps.append((part, order, s + 1, x, len(left), len(gone), sum(x in r[0] for r in docs) - len(gone),
                              sum(r[0] == {x} for r in docs), sum(r[1] for r in gone), sum(r[2] for r in gone)))
        out |= {(*r[:3], *r[4:], shapley[r[3]]) for r in steps}
    return out


def test_audit_with_retractions_over_batches(spark):
    rows, labels = audit_rows(), [(i, i % 2, int(i % 3 == 0)) for i in range(0, 40, 2)] + [(2, 1, None), (None, 1, 1)]
    path = scratch(spark, "audit-docs")
    for i in range(4):  # four files, at least one batch each: smaller ids come later too
        part = spark.createDataFrame(rows[i::4], "doc_id long, text string, source string").withColumn("mask", F.lit("x")).withColumn("n", F.lit(1))
        part.coalesce(1).write.mode("append").parquet(path)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = IA.interaction_audit(spark, path, lab, batch_bytes=1)
    cols = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r) for r in got.select(cols).collect()} == brute_audit(rows, labels)


def test_audit_of_an_empty_table(spark):
    path = scratch(spark, "audit-empty")
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(path)
    assert IA.interaction_audit(spark, path, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


# -- rules -----------------------------------------------------------------------------------------
def brute_repeats(t):
    w = re.findall(WORD, t or "")
    c = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    return len({i + k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in range(3)})


def test_repeated_words(spark):
    rng = random.Random(1)
    texts = ["", None, " ", "\t\n", "a", "a b", "a b c", "a b c a b c", "x " * 500, "a b c " * 20_000]
    texts += [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").withColumn("w", QR.words_of(F.coalesce("t", F.lit(""))))
    got = {r.id: r.n for r in QR.repeated_words(df, "w", "n").collect()}
    assert got == {i: brute_repeats(t) for i, t in enumerate(texts)}


def test_repeated_words_when_hashes_meet(spark, monkeypatch):
    """All windows get one hash: the exact way round has to count."""
    texts = ["a b c a b c", "a b c d e f", "a b c x a b c y a b c", "k l m k l"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").withColumn("w", QR.words_of(F.col("t")))
    monkeypatch.setattr(QR.F, "xxhash64", lambda *a: F.lit(5).cast("long"))
    got = {r.id: r.n for r in QR.repeated_words(df, "w", "n").collect()}
    assert got == {i: brute_repeats(t) for i, t in enumerate(texts)}


def test_rules_against_sql(spark):
    rng = random.Random(2)
    common = {"en": "the of and to in is that".split(), "de": "der die und in den ist zu".split()}
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "de", None])
        words = [rng.choice(common[lang or "en"]) if rng.random() < .5 else f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 160))]
        t = " ".join(words) + rng.choice(["", ".\n", "\n\nthe end\nthe end", " É ü 5%", " <b> & * | #"])
        rows.append((i, t.upper() if i % 17 == 0 else t, lang))
    rows += [(500, None, "en"), (None, "x " * 80, "en"), (501, "lonely " + "word " * 3, "xx"), (500, None, "en"), (502, "%$ " * 40_000, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("common", F.lit("x")).withColumn("_words", F.lit(3))
    got = QR.quality_rules(docs)
    compare_duck("op12_quality_rules", got, {"documents": docs.select("doc_id", "text", "lang")})
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert not any(kept[i] for i in range(0, 120, 17)) and sum(kept.values()) > 40
    assert QR.quality_rules(docs.limit(0)).count() == 0


def test_a_hot_text_does_not_move_the_reference(spark):
    rng = random.Random(3)
    prose = [(i, " ".join(rng.choice(["the", "of", "and"]) if rng.random() < .4 else "".join(rng.choice("aeinrst") for _ in range(6)) for _ in range(120)), "en") for i in range(60)]
    junk = [(1000 + i, "QQ##$$ ZZ||%% " * 60, "en") for i in range(60)]
    rows = spark.createDataFrame(prose + junk, "doc_id long, text string, lang string")
    got = {r.doc_id: r.kept for r in QR.quality_rules(rows).collect()}
    assert all(got[i] for i in range(60)) and not any(got[1000 + i] for i in range(60))


# -- phrases ---------------------------------------------------------------------------------------
def brute_phrases(rows, min_count=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        inside = {q for p, a in cand.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * c[q]}
        found = []
        for p, a in cand.items():
            if p not in inside:
                score, _, l, r = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("budget,min_count,top", [(400_000, 3, 2000), (20, 3, 2000), (4, 2, 15)])
def test_phrases(spark, monkeypatch, budget, min_count, top):
    rng = random.Random(budget)
    words = ["The", "of", "É", "new", "york", "a#b", "x y", "\x01"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", "\n", "!"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    rows = [(t, rng.choice(["en", "en", "de", None])) for t in texts] + [(None, "en"), ("", None), ("New York " * 300, "en"), ("New York " * 300, "en")]
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("doc_id", F.lit(None).cast("long")).withColumn("w1", F.lit("q")).withColumn("f", F.lit(0))
    got = PM.mine_phrases(df.repartition(3), min_count=min_count, top=top, budget=budget)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, min_count, top)


@pytest.mark.parametrize("chunk,room,step", [(1, 10**9, 1), (7, 10**9, 5), (10**9, 3, 40), (50, 60, 10**9), (10**9, 10**9, 10**9)])
def test_suffixes_do_not_depend_on_chunks(monkeypatch, chunk, room, step):
    """Chunks that end inside texts, pieces and even words' neighbourhoods count the same suffixes."""
    for k, v in (("CHUNK", chunk), ("ROOM", room), ("STEP", step)):
        monkeypatch.setattr(PM, k, v)
    rng = random.Random(5)
    texts = ["", " ", ".", "a", "a. b", " a b\tc ", "x" * 200] + [
        "".join(rng.choice(["a", "B", "\x01", "É", "dd"]) + rng.choice([" ", "  ", "\t", ". ", "\r\n", "!"]) for _ in range(rng.randint(0, 90))) for _ in range(12)]
    langs = [rng.choice(["en", "de"]) for _ in texts]
    import pyarrow as pa
    batches = pa.table({"lang": langs, "text": pa.array([t.encode() for t in texts], pa.binary())}).to_batches(max_chunksize=5)
    got, leaves = Counter(), 0
    for b in PM._suffixes(iter(batches)):
        for r in b.to_pylist():
            tails = dict(PM._unpacked(r["tails"], r["counts"]))
            assert len(tails) == r["leaves"] and sum(tails.values()) == r["f"] and r["part"] == ""
            for t, c in tails.items():
                got[r["lang"], r["w1"].encode(), t] += c
    want = Counter()
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for text, lang in zip(texts, langs):
        for piece in re.split("[.,;:!?\x0a-\x0d]", text.translate(low)):
            w = [x.encode() for x in re.findall("[^\x20\x09]+", piece)]
            for i in range(len(w)):
                want[lang, w[i], b" ".join(w[i + 1:i + 3])] += 1
    assert got == want


@pytest.mark.parametrize("budget", [1, 3, 50, 10**6])
def test_subtrees_of_prefixes_that_go_on(budget):
    """A prefix whose rows outlast the budget is kept as one row; counts may pass 32 bits."""
    import numpy as np
    import pyarrow as pa
    many = 2**31 - 1
    rows = [("a  en", [(b"b", 1), (b"b c", 1)])] * 6 + [("b  de", [(b"", many), (b"x y", 2)])] * 4 + [("b  en", [(b"z", 1)])]
    data = [(k, b"\n".join(t for t, _ in ls), np.array([c for _, c in ls], np.int32).tobytes() if any(c > 1 for _, c in ls) else b"") for k, ls in rows]
    table = pa.table({n: [d[i] for d in data] for i, n in enumerate(("key", "tails", "counts"))})
    out = [tuple(r.values()) for b in PM._trees(3, budget, 0)(iter(table.to_batches(max_chunksize=2))) for r in b.to_pylist()]
    assert sorted(out) == [("de", 1, "b", "", "", 4 * many + 8), ("de", 2, "b", "x", "", 8), ("de", 3, "b", "x", "y", 8),
                           ("en", 1, "a", "", "", 12), ("en", 2, "a", "b", "", 12), ("en", 3, "a", "b", "c", 6)]


def test_phrases_across_steps_of_a_long_piece(spark, monkeypatch):
    text = " ".join(f"w{i % 7}" for i in range(120_001))
    df = spark.createDataFrame([(text, "en")], "text string, lang string")
    assert sorted(map(tuple, PM.mine_phrases(df).collect())) == brute_phrases([(text, "en")])
    assert PM.mine_phrases(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op11_interaction_audit", "op13_phrase_mining"])
def test_queries_against_sql(spark, name):
    from conftest import SF_SMALL
    from starkiln.llm.registry import QUERIES

    want = duck(SF_SMALL).execute(ORACLES[name]).to_arrow_table().to_pylist()
    row = lambda r: tuple(str(r[c]) for c in sorted(r))
    assert sorted(map(row, (r.asDict() for r in QUERIES[name](spark, SF_SMALL).collect()))) == sorted(map(row, want))


def test_phrases_are_not_broadcast(spark):
    """A table exploded for a join is taken for no larger than its files, though it may fill the driver.
    Only the totals, one row a language, go through it."""
    df = spark.createDataFrame([("new york is new. " * 40, "en"), ("a b c d " * 30, "de")], "text string, lang string")
    got = PM.mine_phrases(df)
    joins = re.findall(r"(\w+Join) \[(.*?)\]", got._jdf.queryExecution().executedPlan().toString())
    assert len([j for j, _ in joins if j == "SortMergeJoin"]) == 7
    assert [re.sub(r"#\d+", "", keys) for j, keys in joins if j != "SortMergeJoin"] == ["lang"]
    left, right = spark.range(50).selectExpr("id % 5 AS k", "id"), spark.range(5).selectExpr("id AS k", "id * 2 AS v")
    met = spread_join(left, right, ["k"], F.col("id"))
    assert sorted((r.id, r.v) for r in met.collect()) == [(i, i % 5 * 2) for i in range(50)]
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
