"""Token operators against the tokenizers library and brute force."""

import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starkiln.llm import packing, token_output
from starkiln.llm.bpe_codec import WordBpe
from starkiln.llm.byte_bpe import ByteEncoder
from starkiln.llm.token_counts import MARK, SharedTrie, load_pieces, zipf_scores

BYTE, WORD, PIECE = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
ODD = ["", " ", "a", "  a  b ", "a\n b", "x.\nY z", "it's we'll I'm 'S", "<|endoftext|>", "a<|endoftext|>b c", "<|startoftext|> q",
       "naïve é Éa ΑΣ ΣΑΣ İi", "12 345 a1b2", "日本語 テスト 🙂🙂 x", "a b c 　d", "\x1c a\x1fb", "!!! ... --- a--b", "ſ K Ω",
       "the " * 300, "x" * 3000, "\t\ttab\tand\r\nline \x0b\x0c end ", "​ zero", "é ́ a ́b", "क्षि ไทย עברית", ":\U0003d000", "𝐚𝐛 ²½ 𝟏𝟐"]
text = st.text(st.sampled_from("ab tTh'eé Σ\n.1!́日<|>") | st.characters(codec="utf-8", max_codepoint=0xFFFF, exclude_categories=["Cn", "Cs"]), max_size=60)


@pytest.fixture(scope="module")
def byte():
    return ByteEncoder(BYTE)


@pytest.fixture(scope="module")
def word():
    return WordBpe(WORD), Tokenizer.from_file(WORD)


def same_byte(enc, s):
    assert np.frombuffer(enc.encode(s.encode()), "<u4").tolist() == enc.exact.encode(s, add_special_tokens=False).ids


def same_word(pair, s):
    own, lib = pair
    want = lib.encode(s, add_special_tokens=False).ids
    ids, decoded = own.both(s.encode())
    assert np.frombuffer(ids, "<u4").tolist() == want == own.encode(s)
    assert decoded.decode() == lib.decode(want, skip_special_tokens=False) == own.decode(want)


@pytest.mark.parametrize("s", ODD)
def test_odd_texts(byte, word, s):
    same_byte(byte, s)
    same_word(word, s)


@settings(max_examples=300, deadline=None)
@given(text)
def test_any_text(byte, word, s):
    same_byte(byte, s)
    same_word(word, s)


def test_remembered_units_are_dropped_without_harm(byte, word, monkeypatch):
    from starkiln.llm import bpe_codec, byte_bpe

    monkeypatch.setattr(byte_bpe, "REMEMBER", 3)
    monkeypatch.setattr(bpe_codec, "REMEMBER", 3)
    for s in ("one two three four five", "six one seven", "one two"):
        same_byte(byte, s)
        same_word(word, s)


def viterbi(word, scores, byte_score):
    t, best = MARK + word, [(0.0, 0)]
    for i in range(1, len(t) + 1):
        k = len(t[i - 1].encode())
        options = [] if t[i - 1] in scores else [(best[i - 1][0] + k * byte_score, -best[i - 1][1] - k)]
        options += [(best[j][0] + scores[t[j:i]], -best[j][1] - 1) for j in range(i) if t[j:i] in scores]
        s, n = max(options)
        best.append((s, -n))
    return best[-1][1], best[-1][0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcé"), min_size=1, max_size=8), max_size=20))
def test_trie_against_plain_dynamic_programming(words):
    scores = zipf_scores([MARK, "a", "b", "ab", "ba", MARK + "a", "c", "abc", "cc", MARK + "ab"])
    t = SharedTrie(scores, nodes=12, words=5)
    for w in words:
        t.insert(w.encode())
        n, s = t.counts[w.encode()], t.sums[w.encode()]
        m, z = viterbi(w, scores, t.byte_score)
        assert math.isclose(s, z) and n == m


def test_real_vocabulary_shares_prefixes():
    t = SharedTrie(zipf_scores(load_pieces(PIECE)))
    assert t.count_text("".encode()) == (0, 0, 0.0)
    t.insert(b"nation")
    nodes = len(t.best)
    t.insert(b"national")
    assert len(t.best) == nodes + 2
    assert t.count_text("nation national 日".encode())[0] == 3


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=40))
def test_best_fit_places_each_piece_in_the_tightest_row(lengths):
    rows = token_output.best_fit(lengths, 16)
    assert sorted(k for r in rows for k in r) == list(range(len(lengths)))
    assert all(sum(lengths[k] for k in r) <= 16 for r in rows)
    room = []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):  # plain best fit decreasing
        fits = [r for r in room if r >= lengths[k]]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - lengths[k])
        else:
            room.append(16 - lengths[k])
    assert sorted(16 - sum(lengths[k] for k in r) for r in rows) == sorted(room)


def test_rows_round_trip():
    rng = random.Random(1)
    docs = [(d, np.array([rng.randrange(1, 60000) for _ in range(rng.choice([0, 1, 5, 64, 65, 300]))], "<u4").tobytes()) for d in range(40)]
    rows = token_output.pack_rows(docs, 64, 7).to_pylist()
    back = {d: {} for d, _ in docs}
    for r in rows:
        ids, pos, cu = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["positions"], "<u2"), r["cu_seqlens"]
        assert len(ids) == len(pos) == 64 and cu[-1] == r["n_tokens"] and zlib.crc32(ids[:cu[-1]].tobytes()) == r["ids_crc32"]
        for d, s, a, b in zip(r["doc_ids"], r["starts"], cu, cu[1:]):
            back[d][s] = ids[a:b].tobytes()
            assert pos[a:b].tolist() == list(range(b - a))
    assert all(b"".join(v for _, v in sorted(back[d].items())) == raw for d, raw in docs)


def brute_cuts(x, penalty, window):
    cost = [0.0]
    for j in range(1, len(x)):
        best = math.inf
        for i in range(j):
            n = int(x[j] - x[i])
            if n <= window:
                free = n & (n - 1) == 0 and (n >= window // 8 or j == len(x) - 1)
                best = min(best, cost[i] + packing.SEQUENCE_COST + (0 if free else window - n))
        cost.append(best + penalty[j])
    return cost[-1]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.booleans()), min_size=1, max_size=30))
def test_cuts_are_the_best(steps):
    x = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    penalty = np.array([0.0, *(0.0 if e else 2.0 for _, e in steps)])
    c = packing.cuts(x, penalty, 32)
    at = {int(v): k for k, v in enumerate(x)}
    lengths = np.diff(c)
    assert c[0] == 0 and c[-1] == x[-1] and lengths.max() <= 32
    cost = sum(penalty[at[int(v)]] for v in c[1:])
    for k, n in enumerate(lengths.tolist()):
        free = n & (n - 1) == 0 and (n >= 4 or k == len(lengths) - 1)
        cost += packing.SEQUENCE_COST + (0 if free else 32 - n)
    assert math.isclose(cost, brute_cuts(x, penalty, 32))
