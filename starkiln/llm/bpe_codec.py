"""BPE encoding and decoding with merge ranks, for tokenizer files with word-end symbols.

A pre-token becomes a doubly linked list of byte symbols.  A priority queue holds the
mergeable neighbours by (rank, position); the best pair is merged in place, its new
neighbours are queued, and entries whose symbols have changed meanwhile are skipped when
they come up.  Decoding concatenates vocabulary strings (with a space between tokens, as the
tokenizers library does for a file without a decoder).

Pre-tokens never cross white space, so a text is a sequence of units between ASCII white
space.  A worker process remembers the units it has met in a bounded table.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_chars

#: Units and words a worker process remembers; a table is emptied when it is full.
REMEMBER, REMEMBER_WORDS = 300_000, 600_000
#: Bits of a token id and of a position in the integers that stand for pairs and queue entries.
ID_BITS, POS_BITS = 20, 40
#: White space as the tokenizer's patterns see it.
WS = r"\t-\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000\u2000-\u200a"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WS}\p{{L}}\p{{N}}]+")


#: Characters beyond the first plane are split like these (a letter, a number, a symbol).
STAND_INS = {"L": "\u00aa", "N": "\u00b2"}


def pieces(text: str) -> list[str]:
    """Pre-tokens of a normalised text."""
    if not text or max(text) <= "\uffff":
        return PIECES.findall(text)
    shape = "".join(c if c <= "\uffff" else STAND_INS.get(unicodedata.category(c)[0], "\u00ac") for c in text)
    return [text[m.start():m.end()] for m in PIECES.finditer(shape)]


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.specials.items()}
        self.split = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.end = model["end_of_word_suffix"] or ""
        chars = {b: c for c, b in byte_chars().items()}
        self.inner = [self.vocab.get(chars[b]) for b in range(256)]
        self.last = [self.vocab.get(chars[b] + self.end) for b in range(256)]
        self.ranks: dict[int, int] = {}  # two ids in one integer -> rank of their merge
        self.merged: list[int] = []  # rank -> id
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[self.vocab[a] << ID_BITS | self.vocab[b]] = rank
            self.merged.append(self.vocab[a + b])
        self.raw = {i: i.to_bytes(4, "little") for i in self.strings}
        self.words: dict[str, bytes] = {}
        self.units: dict[bytes, bytes] = {}
        self.texts: dict[bytes, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the merges by rank, leftmost first among equal ranks.  An entry of the queue
        is rank and position in one integer."""
        n, get = len(symbols), self.ranks.get
        if n < 2:
            return symbols
        queue = [r << POS_BITS | i for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
                 if (r := get(a << ID_BITS | b)) is not None]
        if not queue:
            return symbols
        heapify(queue)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        low, merged = (1 << POS_BITS) - 1, self.merged
        while queue:
            top = heappop(queue)
            i = top & low
            j = after[i]
            if j < 0 or symbols[i] < 0 or get(symbols[i] << ID_BITS | symbols[j]) != top >> POS_BITS:
                continue  # stale: a neighbour has changed since
            symbols[i] = new = merged[top >> POS_BITS]
            symbols[j] = -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (r := get(new << ID_BITS | symbols[k])) is not None:
                    heappush(queue, r << POS_BITS | i)
            h = before[i]
            if h >= 0 and (r := get(symbols[h] << ID_BITS | new)) is not None:
                heappush(queue, r << POS_BITS | h)
        return [s for s in symbols if s >= 0]

    def _word(self, piece: str) -> bytes:
        ids = self.words.get(piece)
        if ids is None:
            raw = piece.encode()
            symbols = [*map(self.inner.__getitem__, raw[:-1]), self.last[raw[-1]]]
            if None in symbols:
                symbols = [s for s in symbols if s is not None]
            ids = self.words[piece] = b"".join(map(self.raw.__getitem__, self.merge(symbols)))
        return ids

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            found = PIECES.findall(text.lower())
        else:
            text = unicodedata.normalize("NFC", text)
            # one letter at a time, so a capital sigma at a word's end is lowered like any other
            found = pieces("".join(map(str.lower, text)) if "Σ" in text else text.lower())
        return self._word(found[0]) if len(found) == 1 else b"".join(map(self._word, found))

    def _ids(self, text: str) -> bytes:
        if self.split is None or not (marks := list(self.split.finditer(text))):
            return self._plain(text)
        out, at = [], 0
        for m in marks:
            out += [self._plain(text[at:m.start()]), self.raw[self.specials[m.group()]]]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def encode(self, text: str) -> list[int]:
        """Ids of a text; special tokens in the text become their ids."""
        return memoryview(self._ids(text)).cast("I").tolist()

    def decode(self, ids) -> str:
        """Vocabulary strings, special tokens included, joined by spaces; unknown ids are skipped."""
        return " ".join([s for i in ids if (s := self.strings.get(i)) is not None])

    def both(self, text: bytes) -> tuple[bytes, bytes]:
        """Ids of a UTF-8 text as little-endian 32-bit integers, and the decoded text."""
        units, texts = text.split(), self.texts
        if len(self.units) > REMEMBER:
            self.units.clear()
            texts.clear()
        if len(self.words) > REMEMBER_WORDS:
            self.words.clear()
        for u in [u for u in set(units) if u not in texts]:
            ids = self.units[u] = self._ids(u.decode("utf-8", "replace"))
            texts[u] = (self.decode(memoryview(ids).cast("I")) + " ").encode() if ids else b""
        return b"".join(map(self.units.__getitem__, units)), b"".join(map(texts.__getitem__, units))[:-1]


_CODECS: dict[str, WordBpe] = {}


def codec(path: str) -> WordBpe:
    """One per worker process."""
    if path not in _CODECS:
        _CODECS[path] = WordBpe(path)
    return _CODECS[path]


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids (binary, little-endian unsigned 32-bit), decoded (binary, UTF-8).

    A null text counts as empty (no ids, empty decoded text).  Null ids and repeated rows are
    kept row by row; an empty table gives an empty result; other columns are ignored.
    """

    def run(batches):
        c = codec(tokenizer_path)
        for b in batches:
            pairs = [c.both(t or b"") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())],
                names=["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
                       ).mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_decode`` with each row reduced in its task: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        c = codec(tokenizer_path)
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                ids, text = c.both(t or b"")
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()))
            n, i, d = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(i, pa.string()), pa.array(d, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
                       ).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
