"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is seen as two words of 31 bits (bits 0-30 and 32-62; bits 31 and 63
are not used for the search).  Two fingerprints within 3 bits differ in at most one bit of
one of the words.  On a word the anchors are the code words of the (31, 26) Hamming code,
a perfect code with covering radius 1.  Every fingerprint is replicated to each anchor
within covering radius plus the word's threshold (1 + 1 = 2 bits; 1 or 16 anchors) and has
its home at the anchor within the radius.  If x and y differ in at most one bit of a word,
y is within 2 bits of the home of x: they meet there and all 64 bits are compared.

Only distinct fingerprints take part.  The members of an anchor are packed into salted
blocks and blocks are joined on the anchor, so a hot anchor becomes many block pairs that
Spark spreads and splits; a block pair yields star edges of its groups, never all pairs.
Components are built on the stars.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, star_edges, stored

SEED = 42
WORD_BITS = 31
#: Blocks a hot anchor's members are split into.
SALTS = 64
_BITS = np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes, words: int) -> int:
    """A-Z lower-cased, words between ASCII white space, shingles of ``words`` words with
    repeats; a bit is 1 if set in over half the shingles' XXH64.  No words: zero."""
    w = text.lower().split()
    if not w:
        return 0
    if len(w) < words:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(words))))
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64)
    return _majority(h)


def _majority(h: np.ndarray) -> int:
    """Counts of set bits: bytes spread to lanes of eight 8-bit counters, up to 255 rows a sum."""
    n = len(h)
    lanes = _LANES[h.view(np.uint8).reshape(n, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, n, 255), axis=0)
    counts = sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int((((counts * 2) > n).astype(np.uint64) << _BITS).sum())


#: For each byte, its 8 bits as 8 bytes of an integer.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprints(words: int):
    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t or b"", words) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])
    return run


def syndrome(x: np.ndarray) -> np.ndarray:
    """Xor of the positions (1..31) of the set bits; 0 on code words."""
    s = np.zeros(x.shape, np.int64)
    for i in range(WORD_BITS):
        s ^= ((x >> i) & 1) * (i + 1)
    return s


def home(x: np.ndarray) -> np.ndarray:
    """The only anchor within one bit."""
    s = syndrome(x)
    return np.where(s == 0, x, x ^ (np.int64(1) << np.maximum(s - 1, 0)))


def anchors(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All anchors within two bits: (row, anchor) arrays."""
    s = syndrome(x)
    rows, out = [np.arange(len(x))], [home(x)]
    for i in range(1, WORD_BITS + 1):
        j = i ^ s
        ok = (s != 0) & (j > i) & (j <= WORD_BITS)  # a pair of positions whose xor is the syndrome
        rows.append(np.flatnonzero(ok))
        out.append(x[ok] ^ (np.int64(1) << (i - 1)) ^ (np.int64(1) << (j[ok] - 1)))
    return np.concatenate(rows), np.concatenate(out)


def _words(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u = fp.view(np.uint64)
    low = np.uint64((1 << WORD_BITS) - 1)
    return (u & low).astype(np.int64), ((u >> np.uint64(32)) & low).astype(np.int64)


def _replicate(home_only: bool):
    def run(batches):
        for b in batches:
            rep, fp = b.column(0).to_numpy(), b.column(1).to_numpy()
            for half, x in enumerate(_words(fp)):
                rows, a = (np.arange(len(x)), home(x)) if home_only else anchors(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a | (half << 40)), pa.array(fp[rows]), pa.array(rep[rows])], names=["anchor", "fp", "rep"])
    return run


def _compare(bits: int, step: int = 1024):
    def run(batches):
        for b in batches:
            a, c = [], []
            cols = [b.column(n) for n in ("hf", "hr", "mf", "mr")]
            for k in range(b.num_rows):
                hf, hr, mf, mr = (x[k].values.to_numpy() for x in cols)
                for i in range(0, len(hf), step):
                    for j in range(0, len(mf), step):
                        near = np.bitwise_count(hf[i:i + step, None] ^ mf[None, j:j + step]) <= bits
                        node, root = star_edges(hr[i:i + step], mr[j:j + step], near)
                        a.append(node)
                        c.append(root)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (a, c)], names=["a", "b"])
    return run


def links(fps: DataFrame, bits: int) -> DataFrame:
    """``fps``: distinct ``fp`` with an id ``rep``.  Edges ``a, b`` between reps that connect
    whatever is within ``bits`` (at most 3) bits."""
    if not 0 <= bits <= 3:
        raise ValueError("the covering finds pairs within 3 bits")
    shape = "anchor long, fp long, rep long"
    homes = stored(fps.select("rep", "fp").mapInArrow(_replicate(True), shape), "homes")
    members = fps.select("rep", "fp").mapInArrow(_replicate(False), shape)
    members = members.join(homes.select("anchor"), "anchor", "left_semi")

    def packed(df, f, r):
        salt = F.pmod(F.xxhash64("fp"), F.lit(SALTS)).alias("salt")
        return df.groupBy("anchor", salt).agg(F.collect_list("fp").alias(f), F.collect_list("rep").alias(r)).drop("salt")

    pairs = packed(homes, "hf", "hr").join(packed(members, "mf", "mr"), "anchor")
    alone = (F.size("hf") == 1) & (F.size("mf") == 1) & (F.col("hr")[0] == F.col("mr")[0])
    return pairs.filter(~alone).select("hf", "hr", "mf", "mr").mapInArrow(_compare(bits), "a long, b long")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                  bits: int = 3) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, kept.

    Fingerprints link at ``bits`` or fewer differing bits; ``component_id`` is the smallest
    doc_id reachable over links, itself included.  A null text counts as empty and an empty
    text has fingerprint zero, linked like any other.  A null doc_id keeps its row: it takes
    the component of its fingerprint if any row with an id is there, else null.  Repeated
    rows are kept apart and share a component; ``kept`` is true where doc_id = component_id.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    fp = stored(src.mapInArrow(_fingerprints(words), "doc_id long, fp long"), "fingerprints")
    fps = stored(fp.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    comp = connected_components(links(fps, bits)).withColumnRenamed("node", "rep")
    named = stored(fps.join(comp, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id")), "named")
    return fp.join(named, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
