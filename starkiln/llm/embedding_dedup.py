"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Equal vectors of a label are one vector with a multiplicity from the start.  Centroids are
fitted on a bounded sample; every vector has its home in the cell of the most similar one.
Two vectors with cosine >= t are at most an angle acos(t) apart, so if x is at home in cell a
and y in cell b, y cannot lie further than that angle beyond the plane between the two
centroids: y . (c_b - c_a) <= sin(acos t) |c_b - c_a|.  Every vector visits each lower cell
for which this holds, and so each pair meets exactly once, in the lower of its two homes: the
search is exact whatever the centroids are.

A cell (of one label and one length) is cut into blocks by a hash, as many as its count
asks for.  A pair of blocks is one group of bounded size: one matrix product, from which come
the number of links of each vector and star edges of the groups, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, spread_join, star_edges, stored

#: Bound on the vectors collected to fit the centroids.
SAMPLE = 16_384
#: Vectors of a block.
BLOCK = 1024


def cells_for(n: int) -> int:
    """Number of cells for n vectors: grows with the square root."""
    return max(1, round(math.sqrt(n / BLOCK)))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit rows; fewer if there are fewer distinct rows."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), c)
    return c


def _vectors(col) -> list[bytes | None]:
    """Doubles of each usable vector, else None: null, empty, zero, or with null or
    non-finite components.  Scaled so that squares neither overflow nor vanish."""
    out = []
    for v in col:
        x = None if not v.is_valid else v.values
        if x is None or not len(x) or x.null_count:
            out.append(None)
            continue
        a = x.to_numpy().astype(float)
        top = np.abs(a).max()
        if not np.isfinite(a).all() or top == 0:
            out.append(None)
        else:
            out.append((a if 1e-100 < top < 1e100 else a / top).tobytes())
    return out


def _usable(batches):
    for b in batches:
        raw = _vectors(b.column(2))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(raw, pa.binary())], names=["vec_id", "label", "v"])


def _unit(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, float)
    return a / np.linalg.norm(a)


def _place(centroids: dict[int, np.ndarray], threshold: float):
    """Home cell and the lower cells to visit."""
    reach = math.sqrt(1 - threshold * threshold) + 1e-9

    def run(batches):
        for b in batches:
            rows, cells = [], []
            for i, raw in enumerate(b.column("v").to_pylist()):
                c = centroids.get(len(raw) // 8)
                if c is None or len(c) < 2:
                    rows.append(i)
                    cells.append(0)
                    continue
                s = c @ _unit(raw)
                home = int(np.argmax(s))
                gap = np.linalg.norm(c[home] - c[:home], axis=1)
                visits = [home, *np.flatnonzero(s[home] - s[:home] <= reach * gap).tolist()]
                rows += [i] * len(visits)
                cells += visits
            take = pa.array(rows, pa.int64())
            cell = np.array(cells, np.int32)
            first = np.ones(len(rows), bool)
            first[1:] = np.diff(np.array(rows)) != 0 if len(rows) else first[1:]
            dim = [len(x) // 8 for x in b.column("v").take(take).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("rep").take(take), b.column("label").take(take), b.column("m").take(take),
                 b.column("v").take(take), pa.array(dim, pa.int32()), pa.array(cell), pa.array(first)],
                names=["rep", "label", "m", "v", "dim", "cell", "home"])
    return run


def _compare(threshold: float):
    shape = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])

    def run(key, t):
        """One pair of blocks, or one block with itself."""
        side = t.column("side").to_numpy()
        rep, m = t.column("rep").to_numpy(), t.column("m").to_numpy()
        x = np.frombuffer(b"".join(t.column("v").to_pylist()), float).reshape(t.num_rows, -1)
        norm = np.sqrt((x * x).sum(axis=1))
        a = np.flatnonzero(side == 0)
        same = key[3] == key[4]
        b = a if same else np.flatnonzero(side == 1)
        if not len(a) or not len(b):
            return shape.empty_table()
        near = (x[a] @ x[b].T) / (norm[a][:, None] * norm[b][None, :]) >= threshold
        if same:
            np.fill_diagonal(near, False)
            ids, links = rep[a], near @ m[a]
        else:
            ids, links = np.concatenate([rep[a], rep[b]]), np.concatenate([near @ m[b], near.T @ m[a]])
        hit = links > 0
        node, root = star_edges(rep[a], rep[b], near)
        out = pa.table([pa.array(ids[hit]), pa.array(links[hit]), pa.nulls(int(hit.sum()), pa.int64())], schema=shape)
        return pa.concat_tables([out, pa.table([pa.array(node), pa.nulls(len(node), pa.int64()), pa.array(root)], schema=shape)])
    return run


def embedding_dedup(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors of equal, non-null label and equal length link when their cosine (in doubles) is
    at least ``threshold``.  ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest vec_id reachable, itself included, and ``kept`` marks it.
    Null, empty and zero vectors and those with null or non-finite components link with
    nothing, nor do rows without a label or without a vec_id (whose component is null).
    Repeated rows count as vectors of their own.  Other columns are ignored.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine above 0")
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                         F.col(vector_col).cast("array<double>").alias("v"))
    rows = stored(src.mapInArrow(_usable, "vec_id long, label long, v binary"), "vectors")
    fit = rows.filter("v IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL")
    reps = stored(fit.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m")), "reps")

    k = cells_for(reps.count())
    seen: dict[int, list[np.ndarray]] = {}
    for r in reps.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").toArrow().column(0).to_pylist():
        seen.setdefault(len(r) // 8, []).append(_unit(r))
    centroids = {d: spherical_kmeans(np.array(x), k) for d, x in seen.items()}

    key = ["label", "dim", "cell"]
    placed = stored(reps.mapInArrow(
        _place(centroids, threshold),
        "rep long, label long, m long, v binary, dim int, cell int, home boolean"), "placed")
    sizes = placed.groupBy(key).agg(F.ceil(F.sum(F.col("home").cast("int")) / block).cast("int").alias("hosts"),
                                    F.ceil(F.sum((~F.col("home")).cast("int")) / block).cast("int").alias("guests"))
    met = spread_join(placed, sizes.filter("hosts > 0"), key, F.col("rep"))
    # a host block i meets the host blocks j >= i and all guest blocks (numbered after the hosts)
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("home"), F.col("hosts")).otherwise(F.col("guests"))).cast("int")
    met = met.withColumn("own", F.when(F.col("home"), own).otherwise(own + F.col("hosts")))
    other = F.when(F.col("home"), F.sequence(F.lit(0), F.col("hosts") + F.col("guests") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("hosts") - 1))
    met = met.withColumn("other", F.explode(other))
    pairs = met.select(*key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       (F.col("own") > F.col("other")).cast("int").alias("side"), "rep", "m", "v")
    found = stored(pairs.groupBy(*key, "i", "j").applyInArrow(_compare(threshold), "rep long, links long, to long"), "links")

    counts = found.filter("links IS NOT NULL").groupBy("rep").agg(F.sum("links").alias("links"))
    comp = connected_components(found.filter("to IS NOT NULL").select(F.col("rep").alias("a"), F.col("to").alias("b")))
    named = reps.join(counts, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    linked = spread_join(fit, named, ["label", "v"], F.col("vec_id"))
    alone = rows.filter("v IS NULL OR label IS NULL OR vec_id IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n"), F.col("vec_id").alias("c"))
    return linked.select("vec_id", "n", "c").unionByName(alone).select(
        "vec_id", F.col("n").alias("n_links"), F.col("c").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("c"), F.lit(False)).alias("kept"))
