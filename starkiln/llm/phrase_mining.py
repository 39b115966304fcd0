"""Phrase collocations from depth-truncated suffix subtrees, built per group of prefixes.

After ERA (Mansour et al., "ERA: efficient serial and parallel suffix tree construction for
very long strings", 2011), over words instead of characters and cut at three words:

1. *Suffixes.*  A task counts the suffixes of its pieces, each cut to three words, as sorted arrays
   of word ids, in chunks of bounded size.  A chunk leaves one row per first word: its suffixes packed behind it.
2. *Vertical partitioning.*  Prefix counts are sums over these rows.  A word whose suffixes fit
   the memory budget is a prefix of its own.  A larger one is extended by its next words, taken
   together in as many parts (by a hash of the next word) as the budget asks for; a part that
   is still larger, as it holds a very frequent pair, is extended by the third words alike.  So
   no shuffle key holds more than about the budget.
3. *Subtrees.*  Rows are dealt and sorted by prefix.  A task takes prefixes up to the budget as a
   group, builds their subtrees (leaves in sorted order, independent of every other group's)
   and reads each node's count from its leaf totals.  The counts of extended words
   are known from step 2; a pair cut by third words adds up its parts.

Then candidates, cuts and the ranking are joins and windows on the counted phrases.
"""

from __future__ import annotations

import zlib
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spread_join, stored

#: Suffixes (leaves) that subtrees are built from at a time.
BUDGET = 400_000
#: Words and bytes of text that a task holds before it writes their suffixes.  With the words of
#: a slice at most 2^21, so that three ids fit 63 bits.
CHUNK = 1_800_000
ROOM = 64 << 20
#: Bytes of a text taken at a time.
STEP = 400_000
#: ASCII letters to lower case; piece ends to a full stop; a tab to a blank.
_MAP = bytearray(range(256))
for _c in range(65, 91):
    _MAP[_c] = _c + 32
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _MAP[_c] = 46
_MAP[9] = 32
TABLE = bytes(_MAP)

WORDS = ["w1", "w2", "w3"]
#: One row per chunk and prefix: how many suffixes and occurrences, then the suffixes behind the
#: first word (joined by line feeds, which no word holds) and their counts (none if all are 1).
ROW = "lang string, w1 string, part string, leaves int, f long, tails binary, counts binary"
NODE = "lang string, depth int, w1 string, w2 string, w3 string, f long"
COLUMNS = [x.split()[0] for x in ROW.split(", ")]


def _rows(held: list) -> pa.RecordBatch:
    """held: ((lang, word, part), {suffix behind the word: count})."""
    out = []
    for prefix, tails in held:
        f = sum(tails.values())
        out.append((*prefix, len(tails), f, b"\n".join(tails), b"" if f == len(tails) else array("i", tails.values()).tobytes()))
    kinds = [pa.string()] * 3 + [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 7, kinds)], names=COLUMNS)


def _unpacked(tails: bytes, counts: bytes):
    return zip(tails.split(b"\n"), array("i", counts) if counts else repeat(1))


class _Ids(dict):
    """Words to ids in order of appearance; the end of a piece is id 0."""

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i


def _slices(text: bytes):
    """The text in slices of about ``STEP`` bytes, cut at blanks (a longer word stays whole)."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + STEP)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def _packed(lang: str, ids: np.ndarray, words: pa.Array, spaced: pa.Array):
    """Rows of one language's suffixes.  ``ids``: ranks of the words in text order, 0 behind a
    piece; a suffix starts at every place but the last two."""
    first, second, third = ids[:-2], ids[1:-1], ids[2:]
    here = first != 0
    first, second, third = first[here], second[here], np.where(second == 0, 0, third)[here]
    if not len(first):
        return
    n = len(words)
    codes, counts = np.unique((first * n + second) * n + third, return_counts=True)
    w1, w23 = np.divmod(codes, n * n)
    w2, w3 = np.divmod(w23, n)
    tails = pc.binary_join_element_wise(words.take(pa.array(w2)), spaced.take(pa.array(w3)), pa.scalar(b"", pa.binary()))
    starts = np.flatnonzero(np.diff(w1, prepend=-1))
    ends = np.append(starts, len(w1)).astype(np.int32)
    leaves, f = np.diff(ends), np.add.reduceat(counts, starts)
    several = f != leaves
    data = counts[np.repeat(several, leaves)].astype(np.int32).tobytes()
    at = np.append(0, np.cumsum(np.where(several, 4 * leaves, 0))).astype(np.int32)
    m = len(starts)
    rows = pa.RecordBatch.from_arrays([
        pa.repeat(lang, m), words.take(pa.array(w1[starts])).view(pa.string()), pa.repeat("", m), pa.array(leaves, pa.int32()), pa.array(f, pa.int64()),
        pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), tails), pa.scalar(b"\n", pa.binary())),
        pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data)])], names=COLUMNS)
    for at in range(0, m, 20_000):
        yield rows.slice(at, 20_000)


def _suffixes(batches):
    """Packed suffixes of chunks of documents; shorter where a piece ends.  A chunk may end inside
    a text: the next one takes over its last two words."""
    held, vocab, size, room = {}, _Ids({b".": 0}), 0, 0

    def flush(open_lang=None):
        names = list(vocab)
        order = sorted(range(1, len(names)), key=names.__getitem__)
        rank = np.zeros(len(names), np.int64)
        rank[order] = np.arange(1, len(names))
        words = [b"", *[names[i] for i in order]]
        spaced = pa.array([b"", *[b" " + w for w in words[1:]]], pa.binary())
        words = pa.array(words, pa.binary())
        last = []
        for lang, parts in held.items():
            ids = np.concatenate(parts if lang == open_lang else [*parts, np.zeros(2, np.int32)])
            if lang == open_lang:
                last = [names[i] for i in ids[-2:]]
            yield from _packed(lang, rank[ids], words, spaced)
        held.clear()
        vocab.clear()
        vocab[b"."] = 0
        if last:
            held[open_lang] = [np.array([vocab[w] for w in last], np.int32)]

    for b in batches:
        for i, lang in enumerate(b.column(0).to_pylist()):
            text = b.column(1)[i].as_buffer().to_pybytes().translate(TABLE).replace(b".", b" . ") + b" ."
            for piece in _slices(text):
                if size > CHUNK or room > ROOM:
                    yield from flush(lang if lang in held else None)
                    size = room = 0
                ws = piece.split()
                held.setdefault(lang, []).append(np.fromiter(map(vocab.__getitem__, ws), np.int32, len(ws)))
                size += len(ws)
                room += len(piece)
    yield from flush()


def _extended(third: bool):
    """Rows cut into ``parts`` by a hash of the second word, or of what follows the first one."""
    def run(batches):
        for b in batches:
            for lang, w1, part, parts, tails, counts in zip(*[b.column(n).to_pylist() for n in ("lang", "w1", "part", "parts", "tails", "counts")]):
                by: dict = {}
                for tail, c in _unpacked(tails, counts):
                    at = zlib.crc32(tail if third else tail.partition(b" ")[0]) % parts
                    by.setdefault(at, {})[tail] = c
                yield _rows([((lang, w1, f"{part}/{at}"), x) for at, x in by.items()])
    return run


def _runs(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sums of their counts."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    starts = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]


def subtrees(keys: list, prefix: np.ndarray, tails: pa.Array, counts: np.ndarray, min_count: int, extended: int = 0) -> list[pa.RecordBatch]:
    """Nodes of the subtrees of some prefixes with their totals (``NODE``).

    Leaf ``i`` is suffix ``tails[i]`` behind the first word of ``keys[prefix[i]]``, ``counts[i]``
    times; a leaf comes once.  Leaves below a node are neighbours once sorted by it; a node's
    count is their total.  ``extended``: how many words the prefix was extended by; the first
    word is left out if it was, and pairs are all given, however rare, if third words were cut
    apart.
    """
    split = pc.split_pattern(tails, pattern=b" ", max_splits=1)
    second = pc.list_element(split, 0).dictionary_encode() if len(tails) else pa.array([], pa.binary()).dictionary_encode()
    names, of = second.dictionary, second.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    there = np.asarray(pc.binary_length(tails)) > 0
    found = []  # depth, prefix, second word, third word, count
    if not extended:
        p, f = _runs(prefix, counts)
        found.append((1, p, None, None, f))
    n = max(len(names), 1)
    pair, f = _runs((prefix * n + of)[there], counts[there])
    enough = f >= (0 if extended == 2 else min_count)
    found.append((2, pair[enough] // n, names.take(pa.array(pair[enough] % n)), None, f[enough]))
    whole = (np.asarray(pc.list_value_length(split)) == 2) & (counts >= min_count)
    third = pc.list_element(split.filter(pa.array(whole)), 1) if whole.any() else pa.array([], pa.binary())
    found.append((3, prefix[whole], names.take(pa.array(of[whole])), third, counts[whole]))
    out = []
    for depth, p, w2, w3, f in found:
        if depth == 1:
            p, f = p[f >= min_count], f[f >= min_count]
        m = len(p)
        heads = [keys[i].split(" ", 2) for i in p.tolist()]
        out.append(pa.RecordBatch.from_arrays([
            pa.array([h[2] for h in heads], pa.string()), pa.repeat(pa.scalar(depth, pa.int32()), m), pa.array([h[0] for h in heads], pa.string()),
            pa.repeat("", m) if w2 is None else w2.view(pa.string()), pa.repeat("", m) if w3 is None else w3.view(pa.string()), pa.array(f, pa.int64())],
            names=["lang", "depth", *WORDS, "f"]))
    return pa.Table.from_batches(out).combine_chunks().to_batches(max_chunksize=1 << 30)


def _leaves(rows: list) -> tuple[list, np.ndarray, pa.Array, np.ndarray]:
    """Packed rows ``(key, tails, counts)`` as the distinct leaves of their prefixes."""
    keys = list(dict.fromkeys(k for k, _, _ in rows))
    at = {k: i for i, k in enumerate(keys)}
    lists = pc.split_pattern(pa.array([t for _, t, _ in rows], pa.binary()), pattern=b"\n")
    size = np.asarray(pc.list_value_length(lists))
    prefix = np.repeat(np.array([at[k] for k, _, _ in rows], np.int64), size)
    counts = np.ones(len(prefix), np.int64)
    given = [np.frombuffer(c, np.int64 if len(c) == 8 * n else np.int32) for (_, _, c), n in zip(rows, size.tolist()) if c]
    if given:
        counts[np.repeat(np.array([bool(c) for _, _, c in rows]), size)] = np.concatenate(given)
    tails = lists.flatten().dictionary_encode()
    n = len(tails.dictionary)
    codes, counts = _runs(prefix * n + tails.indices.to_numpy(zero_copy_only=False), counts)
    return keys, codes // n, tails.dictionary.take(pa.array(codes % n)), counts


def _trees(min_count: int, budget: int, extended: int):
    def run(batches):
        """Rows sorted by prefix.  Prefixes are gathered up to the budget, their subtrees built
        and let go; a prefix is in one task only, and one that goes on is kept as one row."""
        held, size = [], 0
        for b in batches:
            for key, tails, counts in zip(*[b.column(n).to_pylist() for n in ("key", "tails", "counts")]):
                if size >= budget:
                    last = held[-1][0]
                    open_ = [r for r in held if r[0] == last] if last == key else []
                    if len(open_) < len(held):
                        yield from subtrees(*_leaves(held[:len(held) - len(open_)]), min_count, extended)
                    held, size = [], 0
                    if open_:
                        _, _, t, c = _leaves(open_)
                        held, size = [(key, b"\n".join(t.to_pylist()), c.tobytes())], 0
                held.append((key, tails, counts))
                size += tails.count(b"\n") + 1
        if held:
            yield from subtrees(*_leaves(held), min_count, extended)
    return run


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10,
                  budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """``(nodes, totals)``: phrases of one to three words that come ``min_count`` times or more
    (lang, depth, w1, w2, w3, f), and all word occurrences per language (lang, n)."""
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                      F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    on = ["lang", "w1", "part"]

    def prefixes(rows: DataFrame) -> DataFrame:
        return stored(rows.groupBy(*on).agg(F.sum("f").alias("f"), F.sum("leaves").alias("leaves")), "prefixes")

    def too_large(counted: DataFrame) -> DataFrame:
        large = counted.filter((F.col("leaves") > budget) & (F.col("f") >= min_count))
        return stored(large.withColumn("parts", F.floor(F.col("leaves") / budget).cast("int") + 1), "extended")

    def dealt(rows: DataFrame, large: DataFrame, extended: int) -> DataFrame:
        """Subtrees of the prefixes that fit the budget (a word holds no blank)."""
        small = rows.join(large.select(*on), on, "left_anti").select(F.concat_ws(" ", "w1", "part", "lang").alias("key"), "tails", "counts")
        return small.repartition("key").sortWithinPartitions("key").mapInArrow(_trees(min_count, budget, extended), NODE)

    def extend(rows: DataFrame, large: DataFrame, third: bool) -> DataFrame:
        hot = rows.join(large.select(*on, "parts"), on).select(*COLUMNS, "parts")
        return stored(hot.mapInArrow(_extended(third), ROW), "suffixes")

    rows0 = stored(src.mapInArrow(_suffixes, ROW), "suffixes")
    one = prefixes(rows0)
    large0 = too_large(one)
    rows1 = extend(rows0, large0, False)
    large1 = too_large(prefixes(rows1))
    rows2 = extend(rows1, large1, True)
    cut = dealt(rows2, large1.limit(0), 2).groupBy("lang", "depth", *WORDS).agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count)
    words = large0.select("lang", F.lit(1).alias("depth"), "w1", F.lit("").alias("w2"), F.lit("").alias("w3"), "f")
    nodes = dealt(rows0, large0, 0).unionByName(words).unionByName(dealt(rows1, large1, 1)).unionByName(cut)
    return stored(nodes, "phrases"), stored(one.groupBy("lang").agg(F.sum("f").alias("n")), "totals")


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10, top: int = 2000,
                 contained: int = 50, budget: int = BUDGET) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts (null: empty) are lower-cased in A-Z, cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
    those at blanks and tabs into words; rows without a language belong to ``und``.  A phrase
    of two or three words counts if it comes ``min_count`` times within pieces, overlaps
    included.  Its lowest-scoring cut counts, floor(10^6 a a / (l r)), ties to the earliest
    cut; arithmetic is exact in decimal(38) for counts below 10^16.  A phrase inside a longer
    candidate that comes at least ``contained`` % as often is dropped.  Order: score and a
    descending, phrase ascending by bytes.  Repeated rows count again; ids and other columns
    are ignored; an empty table, or one without such phrases, gives an empty result.
    """
    nodes, totals = phrase_counts(docs, text_col, lang_col, min_count, budget)
    one = nodes.filter("depth = 1").select("lang", "w1", F.col("f").alias("g"))
    two = nodes.filter("depth = 2").select("lang", "w1", "w2", F.col("f").alias("a"))
    three = nodes.filter("depth = 3").select("lang", *WORDS, F.col("f").alias("a"))

    def with_count(df: DataFrame, part: DataFrame, on: dict, name: str) -> DataFrame:
        """The count of a part of each phrase; one word may be part of very many phrases."""
        right = part.select("lang", *[F.col(k).alias(v) for k, v in on.items()], F.col(part.columns[-1]).alias(name))
        return spread_join(df, right, ["lang", *on.values()], F.concat_ws(" ", *[c for c in df.columns if c in WORDS]), parts=8)

    def score(l: str, r: str):
        wide = lambda c: F.col(c).cast("decimal(19,0)")
        top_ = (wide("a") * wide("a")).cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)")
        return F.call_function("div", top_.cast("decimal(38,0)"), (wide(l) * wide(r)).cast("decimal(38,0)"))

    two_ = with_count(with_count(two, one, {"w1": "w1"}, "l"), one, {"w1": "w2"}, "r")
    pairs = two_.select("lang", "w1", "w2", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", score("l", "r").alias("score"))
    t = with_count(with_count(three, one, {"w1": "w1"}, "l1"), two, {"w1": "w2", "w2": "w3"}, "r1")
    t = with_count(with_count(t, two, {"w1": "w1", "w2": "w2"}, "l2"), one, {"w1": "w3"}, "r2")
    t = t.withColumn("s1", score("l1", "r1")).withColumn("s2", score("l2", "r2"))
    first = F.col("s1") <= F.col("s2")
    triples = t.select("lang", F.concat_ws(" ", *WORDS).alias("phrase"), "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                       F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    around = three.select("lang", "w1", "w2", "a").unionByName(three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    around = around.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    # grows with the phrases, of which Parquet files are a fraction of what a broadcast takes
    free = pairs.join(around.hint("merge"), ["lang", "w1", "w2"], "left").filter(100 * F.coalesce("longer", F.lit(0)) < contained * F.col("a"))
    found = free.select("lang", "phrase", "a", "l", "r", "score").unionByName(triples)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
