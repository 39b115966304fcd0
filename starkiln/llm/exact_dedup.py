"""Exact deduplication by deterministic block naming.

Every text is cut into blocks of a fixed size.  All distinct blocks are sorted and named by
integers; then adjacent pairs of names are named in turn, level by level, until each document
has a single name.  Names are given by comparing whole blocks and whole pairs, so two
documents carry the same (level, name) exactly when their texts are equal: there is no hash
that could collide.

One level is one job.  A task first names its own symbols locally (each distinct symbol of a
chunk of documents once), so that copies never travel: a block that a third of all documents
share crosses the shuffle once per chunk.  Only these local dictionaries are dealt by symbol
and sorted; what returns to the documents are integers, grouped by chunk, and a chunk is
bounded to 8 MB of text (or one longer document).
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_join, stored

#: Bytes of a block.
BLOCK = 4096
#: Bytes of text named together before anything is shuffled.
CHUNK = 8 << 20
#: A run of white space that is not already one space.
RUNS = re.compile(rb"[\t-\r][ \t-\r]*| [ \t-\r]+")

SYMBOL, PENDING, NAMED = 0, 1, 2
SCHEMA = ("kind tinyint, chunk long, level int, lid int, sym binary, pos int, doc_id long, sha string, "
          "lids binary, name long")
ARROW = pa.schema([("kind", pa.int8()), ("chunk", pa.int64()), ("level", pa.int32()), ("lid", pa.int32()),
                   ("sym", pa.binary()), ("pos", pa.int32()), ("doc_id", pa.int64()), ("sha", pa.string()),
                   ("lids", pa.binary()), ("name", pa.int64())])


def normalise(text: bytes) -> bytes:
    """Every run of ASCII white space becomes one space; nothing is trimmed."""
    return RUNS.sub(b" ", text)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=ARROW)


def _local(chunk: int, level: int, docs) -> pa.RecordBatch:
    """docs: (pos, doc_id, sha, symbols).  Rows for each distinct symbol and each document."""
    lid: dict[bytes, int] = {}
    out = []
    for pos, doc, sha, syms in docs:
        ids = np.fromiter((lid.setdefault(s, len(lid)) for s in syms), np.int32)
        out.append({"kind": PENDING, "chunk": chunk, "level": level, "pos": pos, "doc_id": doc, "sha": sha,
                    "lids": ids.tobytes()})
    out += [{"kind": SYMBOL, "chunk": chunk, "level": level, "lid": i, "sym": s} for s, i in lid.items()]
    return _batch(out)


def _cut(block: int):
    def cut(batches):
        part, pos, k = TaskContext.get().partitionId(), 0, 0
        docs, size = [], 0
        for b in batches:
            for i in range(b.num_rows):
                t = normalise(b.column(1)[i].as_py() or b"")
                docs.append((pos, b.column(0)[i].as_py(), hashlib.sha256(t).hexdigest(),
                             [t[j:j + block] for j in range(0, max(len(t), 1), block)]))
                pos, size = pos + 1, size + len(t) + 100
                if size >= CHUNK:
                    yield _local((part << 32) | k, 0, docs)
                    docs, size, k = [], 0, k + 1
        if docs:
            yield _local((part << 32) | k, 0, docs)
    return cut


def _name(batches):
    """Rows sorted by symbol: equal neighbours get one name.  A symbol is in one task only."""
    base, run, last = TaskContext.get().partitionId() << 40, -1, None
    for b in batches:
        names = []
        for s in b.column(2).to_pylist():
            if s != last:
                run, last = run + 1, s
            names.append(base | run)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.int64())],
                                         names=["chunk", "lid", "name"])


def _next_level(level: int):
    def step(key, docs: pa.Table, names: pa.Table) -> pa.Table:
        """One chunk: put names in place of local ids; a single name ends a document, else
        adjacent names are paired (a last one without a partner is paired with -1)."""
        lookup = np.full(names.num_rows, -1, np.int64)
        lookup[names.column("lid").to_numpy()] = names.column("name").to_numpy()
        done, pending = [], []
        for d in docs.select(["pos", "doc_id", "sha", "lids"]).to_pylist():
            row = lookup[np.frombuffer(d["lids"], np.int32)]
            if len(row) == 1:
                done.append({"kind": NAMED, "chunk": key[0].as_py(), "level": level, "pos": d["pos"],
                             "doc_id": d["doc_id"], "sha": d["sha"], "name": int(row[0])})
            else:
                if len(row) % 2:
                    row = np.append(row, -1)
                raw = row.astype(">i8").tobytes()
                pending.append((d["pos"], d["doc_id"], d["sha"], [raw[i:i + 16] for i in range(0, len(raw), 16)]))
        parts = [_batch(done)] + ([_local(key[0].as_py(), level + 1, pending)] if pending else [])
        return pa.Table.from_batches(parts)
    return step


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``chunk, pos`` (name a row of the input), ``doc_id``, ``sha`` and the identity ``level, name``."""
    state = stored(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(_cut(block), SCHEMA),
                   "names0")
    done, level = [state.filter(F.col("kind") == NAMED)], 0
    while True:
        symbols = state.filter(F.col("kind") == SYMBOL).select("chunk", "lid", "sym")
        named = symbols.repartition("sym").sortWithinPartitions("sym").mapInArrow(_name, "chunk long, lid int, name long")
        pending = state.filter(F.col("kind") == PENDING)
        state = stored(pending.groupBy("chunk").cogroup(named.groupBy("chunk")).applyInArrow(_next_level(level), SCHEMA),
                       f"names{level + 1}")
        done.append(state.filter(F.col("kind") == NAMED))
        if state.filter(F.col("kind") == PENDING).isEmpty():
            break
        level += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("chunk", "pos", "doc_id", "sha", "level", "name")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after replacing each run of ASCII white space by one
    space; a null text counts as empty.  Of equal texts the row with the smallest doc_id
    stays.  Rows that tie on doc_id (repeated rows): the first read stays; a null doc_id
    comes after all others.  Other columns are ignored; an empty table gives an empty result.
    """
    ids = identities(docs, id_col, text_col, block)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "chunk", "pos")
    groups = ids.groupBy("level", "name").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
    met = spread_join(ids, groups, ["level", "name"], F.struct("chunk", "pos"))
    return met.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        ((F.col("chunk") == F.col("first.chunk")) & (F.col("pos") == F.col("first.pos"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
