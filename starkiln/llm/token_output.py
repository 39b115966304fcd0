"""Token ids as packed binary rows: best-fit-decreasing with a segment tree.

A task tokenizes the documents it reads and packs them in chunks.  Documents longer than a
row are split without loss; pieces are placed from the longest to the shortest, each in the
row with the least room that still holds it.  The rows are counted by room left, and a
segment tree over the room finds the smallest sufficient one in logarithmic time.

Every row of the id matrix comes with its cumulative segment lengths and with positions that
start again at 0 in each segment, which is what attention kernels for packed sequences take.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 1024
#: Tokens gathered before a chunk is packed (more if a document is longer).
CHUNK_TOKENS = 1 << 19

SCHEMA = ("sequence_id long, n_tokens int, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, "
          "ids binary, positions binary, ids_crc32 long")


class RoomTree:
    """Open rows by room left (0..width): the smallest room of at least n that some row has."""

    def __init__(self, width: int):
        self.size = 1 << width.bit_length()
        self.tree = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = room + self.size
        while i:
            self.tree[i] += 1
            i //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, row) with the least room >= need."""
        i = need + self.size
        if not self.tree[i]:
            while i > 1 and (i % 2 or not self.tree[i + 1]):  # up to the first right sibling that is not empty
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        room = i - self.size
        while i:
            self.tree[i] -= 1
            i //= 2
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], width: int) -> list[list[int]]:
    """Rows of piece numbers; pieces in order of falling length (equal: as given)."""
    rows: list[list[int]] = []
    tree = RoomTree(width)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = tree.take(lengths[k])
        if found is None:
            room, row = width, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(k)
        if room > lengths[k]:
            tree.add(room - lengths[k], row)
    return rows


def pack_rows(docs: list[tuple], width: int, first: int) -> pa.RecordBatch:
    """docs: (doc_id, ids as little-endian 32-bit bytes).  Documents without ids leave no piece."""
    pieces = [(doc, at // 4, raw[at:at + 4 * width]) for doc, raw in docs for at in range(0, len(raw), 4 * width)]
    out = {n: [] for n in ("sequence_id", "n_tokens", "doc_ids", "starts", "cu_seqlens", "ids", "positions", "ids_crc32")}
    for row, members in enumerate(best_fit([len(p[2]) // 4 for p in pieces], width)):
        parts = [pieces[k] for k in members]
        lengths = [len(p[2]) // 4 for p in parts]
        raw = b"".join(p[2] for p in parts)
        n = len(raw) // 4
        out["sequence_id"].append(first + row)
        out["n_tokens"].append(n)
        out["doc_ids"].append([p[0] for p in parts])
        out["starts"].append([p[1] for p in parts])
        out["cu_seqlens"].append(np.concatenate([[0], np.cumsum(lengths)]).tolist())
        out["ids"].append(raw.ljust(4 * width, b"\0"))
        out["positions"].append(np.concatenate([*(np.arange(k) for k in lengths), np.zeros(width - n)]).astype("<u2").tobytes())
        out["ids_crc32"].append(zlib.crc32(raw))
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


def token_rows(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
               chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per packed sequence.

    ``ids``: ``width`` little-endian unsigned 32-bit ids, zeros after ``n_tokens``;
    ``positions``: as many little-endian unsigned 16-bit positions, from 0 in each segment;
    ``cu_seqlens``: cumulative segment lengths from 0; ``doc_ids`` and ``starts``: document of
    each segment and how many of its ids come before; ``ids_crc32`` of the ids without
    padding.  Every id of every document is in exactly one segment.  A null or empty text has
    no ids and so no segment; null ids and repeated rows are packed like others; an empty
    table gives an empty result.  Other columns are ignored.
    """
    if not 0 < width <= 1 << 16:
        raise ValueError("positions are 16-bit: the width is 1 to 65536")

    def run(batches):
        from .byte_bpe import encoder

        enc = encoder(tokenizer_path)
        made, held, size = TaskContext.get().partitionId() << 40, [], 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.append((doc, enc.encode(text or b"")))
                size += len(held[-1][1]) // 4
                if size >= chunk_tokens:
                    rows = pack_rows(held, width, made)
                    made, held, size = made + rows.num_rows, [], 0
                    yield rows
        if size:
            yield pack_rows(held, width, made)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(run, SCHEMA)


def write_rows(rows: DataFrame, path: str) -> None:
    """Write packed rows as Parquet, one id matrix of fixed-width binary rows per file."""
    rows.write.parquet(path)
