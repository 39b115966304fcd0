"""Ids of a byte-level BPE tokenizer file, exactly as the tokenizers library gives them.

The file's pre-tokenizer never joins across a single space between two non-space characters,
so a text is a sequence of units (what stands between spaces, each with its leading space)
whose ids can be looked up.  A task keeps a bounded table of the units it has met; new ones
are encoded together.  Anything unusual (white space next to a space, special tokens in the
text) goes through the tokenizers library as a whole text; units beyond Latin script go
through it one by one.
"""

from __future__ import annotations

import json
import re

import numpy as np

#: Units a worker process remembers; the table is emptied when it is full.
REMEMBER = 400_000
#: White space beside a space.
BESIDE = re.compile(r" \s|\s ")
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary of such a file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    return table | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}


class ByteEncoder:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        chars = byte_chars()
        self.vocab = {bytes(chars[c] for c in s): i for s, i in spec["model"]["vocab"].items()}
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.fast = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=self.vocab, special_tokens={})
        size = 1 + max(max(self.vocab.values()), *(t["id"] for t in spec["added_tokens"]), 0)
        self.spaced = np.zeros(size, bool)
        for s, i in self.vocab.items():
            self.spaced[i] = s[:1] == b" "
        self.units: dict[bytes, bytes | None] = {}
        self.heads: dict[bytes, bytes | None] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _odd(self, unit: str) -> bool:
        return not unit or unit[0].isspace() or unit[-1].isspace() or any(s in unit for s in self.specials)

    def _learn(self, new: list[bytes]) -> None:
        joined = b" ".join(new).decode("utf-8", "replace")
        if BESIDE.search(f" {joined} ") or max(joined) >= "ɐ" or any(x in joined for x in self.specials):
            easy = []
            for u in new:
                s = u.decode("utf-8", "replace")
                if self._odd(s):
                    self.units[u] = None
                elif max(s) < "ɐ":
                    easy.append(u)
                else:
                    self.units[u] = self._whole(" " + s)
            if not easy:
                return
            new, joined = easy, b" ".join(easy).decode()
        ids = np.array(self.fast.encode_ordinary(" " + joined), "<u4")
        at = (np.flatnonzero(self.spaced[ids]) * 4).tolist()
        raw = ids.tobytes()
        if len(at) == len(new):
            self.units.update(zip(new, map(raw.__getitem__, map(slice, at, [*at[1:], len(raw)]))))
        else:  # a space inside a unit's tokens: not seen in such files
            self.units.update((u, self._whole(" " + u.decode())) for u in new)

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        units = text.split(b" ")
        head = units[0]
        first = self.heads.get(head)
        if first is None:
            s = head.decode("utf-8", "replace")
            if self._odd(s):
                return self._whole(text.decode("utf-8", "replace"))
            if len(self.heads) > REMEMBER:
                self.heads.clear()
            first = self.heads[head] = self._whole(s)
        del units[0]
        if len(self.units) > REMEMBER:
            self.units.clear()
        if new := [u for u in set(units) if u not in self.units]:
            self._learn(new)
        try:
            return first + b"".join(map(self.units.__getitem__, units))
        except TypeError:
            return self._whole(text.decode("utf-8", "replace"))


    def unit_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word after a space, by itself."""
        if len(self.units) > REMEMBER:
            self.units.clear()
        if new := [w for w in dict.fromkeys(words) if w not in self.units]:
            self._learn(new)
        return [x if (x := self.units[w]) is not None else self._whole(" " + w.decode("utf-8", "replace")) for w in words]


_ENCODERS: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    """One per worker process, so the units met in earlier tasks are still known."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]
