"""Helpers shared by the operators: tables, durable intermediates, spread joins, components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The shared folder in ``spark.checkpoint.dir``; a private one only for a local session
    that names none (tests)."""
    if (
        not spark.conf.get("spark.checkpoint.dir", None)
        and not spark.sparkContext.getCheckpointDir()
        and spark.sparkContext.master.startswith("local[")
    ):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starkiln-llm-"))
    return checkpoint_root(spark).rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: what was computed once survives the loss of any executor and is not
    computed again (matters for anything that numbers rows by task).
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def spread_join(left: DataFrame, right: DataFrame, on: list[str], spread_by: Column, how: str = "inner",
                parts: int = 4) -> DataFrame:
    """Join a side with hot keys to a side with one row per key.

    The key is extended by a salt, so a hot key goes to ``parts`` tasks at least; and since
    neither side is partitioned by the extended key already, both get their exchange right
    below the join, where adaptive execution can split what is still too large.  Neither side
    is broadcast: Spark takes the exploded side for no larger than the files it was read from.
    """
    l = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int"))
    r = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return l.join(r.hint("merge"), [*on, "_salt"], how).drop("_salt")


def star_edges(a: np.ndarray, b: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of a boolean matrix of links between ids ``a`` (rows) and ``b`` (columns, may
    overlap with ``a``): each linked id with the smallest id of its group, itself left out."""
    rows = np.flatnonzero(near.any(axis=1))
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    at_a, at_b = where[:len(a)], where[len(a):]
    group = np.arange(len(ids))
    for i in rows.tolist():
        met = np.append(group[at_b[near[i]]], group[at_a[i]])
        least = met.min()
        if (met != least).any():
            group[np.isin(group, met)] = least
    out = np.flatnonzero(group != np.arange(len(ids)))
    return ids[out], ids[group[out]]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every node of an undirected graph.

    ``edges``: long columns ``a``, ``b`` (loops and repeats allowed).  Returns ``node``,
    ``component`` for the nodes that have an edge to another node.  Alternates the
    large-star and small-star steps (Kiveris et al., "Connected components in MapReduce and
    beyond", 2014) until the edges no longer change; every round is written to the shared
    folder.  Star centres with very many neighbours are spread over tasks by the joins.
    """

    def star(pairs: DataFrame, keep_smaller: bool) -> DataFrame:
        """pairs: node, nb.  Every neighbour (larger ones only in the large star) is hung
        under the smallest id around the node."""
        least = pairs.groupBy("node").agg(F.min("nb").alias("m")).select("node", F.least("node", "m").alias("m"))
        met = spread_join(pairs, least, ["node"], F.col("nb"))
        if keep_smaller:
            out = met.select(F.col("nb").alias("a"), F.col("m").alias("b"))
            out = out.unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
        else:
            out = met.filter("nb > node").select(F.col("nb").alias("a"), F.col("m").alias("b"))
        return out.filter("a != b").distinct()

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    e = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    seen = mark(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = e.select(F.col("a").alias("node"), F.col("b").alias("nb")).unionByName(
            e.select(F.col("b").alias("node"), F.col("a").alias("nb")))
        large = star(both, keep_smaller=False)
        small = star(large.select(F.col("a").alias("node"), F.col("b").alias("nb")), keep_smaller=True)
        e = stored(small, "cc")
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("connected components did not settle")
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
