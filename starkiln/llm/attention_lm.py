"""A small causal self-attention language model in numpy.

One layer: masked attention over a window of token ids with a learned bias per
distance, a direct path from the current token, and a two-level softmax (group of the next
token, then token within the group).  The vocabulary is cut into equally large groups of
tokens with similar contexts.  Keys, queries and values depend on the token only, so scoring
looks them up.

Windows overlap: a window holds ``back`` positions of context and ``step`` scored positions,
so each position is scored exactly once, whatever the length of the text.
"""

from __future__ import annotations

import numpy as np

HEADS = 1
_BIG, _TOP, _FAR = np.float32(-1e9), np.float32(60), np.float32(25)


def group_tokens(counts: np.ndarray, groups: int) -> np.ndarray:
    """Order of the tokens (a permutation) such that equal slices hold tokens with similar
    contexts.  ``counts``: next token by current token.  The tokens are halved again and again
    at the median of their main direction of variation."""
    size = len(counts)
    x = np.sqrt(counts.T / np.maximum(counts.sum(axis=0)[:, None], 1.0))
    parts = [np.arange(size)]
    while len(parts) < groups:
        halves = []
        for p in parts:
            c = x[p] - x[p].mean(axis=0)
            v = np.ones(len(p))
            for _ in range(8):  # power iteration for the first principal component
                v = c @ (c.T @ v)
                v /= max(np.linalg.norm(v), 1e-12)
            order = p[np.argsort(v, kind="stable")]
            halves += [order[: len(p) // 2], order[len(p) // 2:]]
        parts = halves
    return np.concatenate(parts)


def init(size: int, groups: int, dim: int, back: int, step: int, seed: int = 11) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    n = lambda *s, scale: (r.normal(size=s) * scale).astype(np.float32)
    return {
        "E": n(size, dim, scale=0.3), "U": n(size, dim, scale=0.1),
        "Q": n(dim, dim, scale=dim**-0.5), "K": n(dim, dim, scale=dim**-0.5), "V": n(dim, dim, scale=dim**-0.5),
        "R": np.repeat(-0.15 * np.arange(back + step, dtype=np.float32)[None, :], HEADS, axis=0) * np.array([[2.0], [0.2]], np.float32)[:HEADS],
        "O": n(dim, dim, scale=dim**-0.5),
        "P": n(size, dim, scale=0.1), "A": n(size, dim, scale=0.3), "B": n(size, dim, scale=0.3),
        "G": n(dim, groups, scale=0.1), "g": np.zeros(groups, np.float32),
        "T": n(groups, dim, size // groups, scale=0.1), "t": np.zeros((groups, size // groups), np.float32),
    }


def _bias(R: np.ndarray, back: int, step: int):
    """Bias of query i (at position back + i) for key j, and the distances; the future is masked.
    Bounded below, so that no weight gets so small that the processor is slow on it."""
    far = back + np.arange(step)[:, None] - np.arange(back + step)[None, :]
    return np.where(far >= 0, np.maximum(R, -_FAR)[:, np.maximum(far, 0)], _BIG), far


def score_texts(scorer: "Scorer", ids: np.ndarray, lengths: np.ndarray, batch: int = 256) -> np.ndarray:
    """Natural log probability of each text, its windows in batches."""
    text, first = window_list(lengths, scorer.step)
    out = np.zeros(len(lengths))
    for i in range(0, len(text), batch):
        own = text[i:i + batch]
        at, absent, scored = window_ids(own, first[i:i + batch], lengths, scorer.back, scorer.step)
        h = scorer.hidden(ids[at], absent)
        if not scored.all():
            h = h[scored]
        else:
            h = h.reshape(-1, h.shape[2])
        lp = scorer.log_probs(h, ids[at[:, scorer.back:] + 1][scored])
        out += np.bincount(np.repeat(own, scored.sum(axis=1)), lp, len(lengths))
    return out


class Scorer:
    """Log probabilities (natural) with all per-token tables computed once."""

    def __init__(self, p: dict[str, np.ndarray], back: int, step: int):
        self.p, self.back, self.step = p, back, step
        dim = p["E"].shape[1]
        split = lambda w: [np.ascontiguousarray(x) for x in np.split(w, HEADS, axis=1)]
        self.q = split((p["E"] @ p["Q"]) / np.float32((dim // HEADS) ** 0.5))
        self.k = split(p["E"] @ p["K"])
        one = np.ones((len(p["E"]), 1), np.float32)  # a column of ones gives the sum of the weights
        self.v = [np.hstack([x, one]) for x in split(p["E"] @ p["V"])]
        self.bias, _ = _bias(p["R"], back, step)
        self.width = p["T"].shape[2]

    def hidden(self, ids: np.ndarray, absent: np.ndarray) -> np.ndarray:
        """ids: windows of back + step tokens; absent: positions that aren't there."""
        now, last, dim = ids[:, self.back:], ids[:, self.back - 1:-1], self.p["O"].shape[0] // HEADS
        h = np.take(self.p["A"], now, axis=0)
        h *= np.take(self.p["B"], last, axis=0)
        h += np.take(self.p["U"], now, axis=0)
        h += np.take(self.p["P"], last, axis=0)
        some = absent.any()
        here = (~absent).astype(np.float32)[:, None, :] if some else None
        for x in range(HEADS):  # every batch is one block of small products; weights are divided by their sum at the end
            s = np.matmul(np.take(self.q[x], now, axis=0), np.take(self.k[x], ids, axis=0).transpose(0, 2, 1))
            s += self.bias[x]
            np.exp(s, out=s)
            if some:
                s *= here
            c = np.matmul(s, np.take(self.v[x], ids, axis=0))
            c[:, :, :dim] /= c[:, :, dim:]
            h += c[:, :, :dim] @ self.p["O"][x * dim:(x + 1) * dim]
        return h

    def log_probs(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of flat targets after flat hidden rows."""
        p, n = self.p, len(target)
        group, member = target // self.width, target % self.width
        z = h @ p["G"]
        z += p["g"]
        out = _log_prob(z, group)
        order = np.argsort(group.astype(np.int16), kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(p["g"])))
        hs, z = np.take(h, order, axis=0), np.empty((n, self.width), np.float32)
        for g, (a, b) in enumerate(zip(np.append(0, ends[:-1]).tolist(), ends.tolist())):
            if a < b:
                np.matmul(hs[a:b], p["T"][g], out=z[a:b])
        z += np.take(p["t"], group[order], axis=0)
        out[order] += _log_prob(z, member[order])
        return out


def _log_prob(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log of the softmax of each row at one place; ``z`` is used up."""
    if z.size and z.max() > _TOP:
        z -= z.max(axis=1, keepdims=True)
    out = z.ravel()[np.arange(len(z)) * z.shape[1] + at]
    np.exp(z, out=z)
    out -= np.log(z @ np.ones(z.shape[1], z.dtype))
    return out


def window_list(lengths: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and first scored position of every window over texts of ``lengths`` positions."""
    count = -(-lengths // step)
    text = np.repeat(np.arange(len(lengths)), count)
    return text, (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * step


def window_ids(text: np.ndarray, first: np.ndarray, lengths: np.ndarray, back: int, step: int,
               starts: np.ndarray | None = None):
    """(index, absent, scored) of some windows.  The texts stand one after the other with one
    id more than positions each: index + 1 is the target.  Each position is scored in one window."""
    if starts is None:
        starts = np.cumsum(lengths + 1) - lengths - 1
    at = first[:, None] - back + np.arange(back + step)[None, :]
    absent = (at < 0) | (at >= lengths[text][:, None])
    return np.where(absent, 0, at) + starts[text][:, None], absent, ~absent[:, back:]


def gradients(p: dict[str, np.ndarray], ids: np.ndarray, absent: np.ndarray, target: np.ndarray, scored: np.ndarray,
              back: int, step: int) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log probability of the scored targets and its gradient.  Queries, keys and
    values are looked up, and their gradients summed by token before they meet a matrix."""
    size, dim = p["E"].shape
    width, kind, part = p["T"].shape[2], p["E"].dtype, dim // HEADS
    scale = kind.type(part ** -0.5)
    now, last, flat = ids[:, back:].ravel(), ids[:, back - 1:-1].ravel(), ids.ravel()
    rows = len(now)
    q = np.take(p["E"] @ p["Q"] * scale, now, axis=0).reshape(-1, step, dim)
    k, v = (np.take(p["E"] @ p[x], flat, axis=0).reshape(-1, back + step, dim) for x in "KV")
    bias, far = _bias(p["R"], back, step)
    seen = np.where(absent, kind.type(0), kind.type(1))[:, None, :] * (far >= 0).astype(kind)
    one = np.ones(back + step, kind)
    att, c = [], np.empty((len(ids), step, dim), kind)
    for x in range(HEADS):
        cut = slice(x * part, (x + 1) * part)
        s = np.matmul(q[:, :, cut], k[:, :, cut].transpose(0, 2, 1))
        s += bias[x].astype(kind)
        _exp(s, seen)
        s /= (s @ one)[:, :, None]
        att.append(s)
        np.matmul(s, v[:, :, cut], out=c[:, :, cut])
    c = c.reshape(-1, dim)
    pa, pb = np.take(p["A"], now, axis=0), np.take(p["B"], last, axis=0)
    h = c @ p["O"]
    h += np.take(p["U"], now, axis=0)
    h += np.take(p["P"], last, axis=0)
    h += pa * pb

    used = np.flatnonzero(scored.ravel())
    y = np.take(target.ravel(), used)
    n = len(y)
    group, member = y // width, y % width
    order = np.argsort(group.astype(np.int16), kind="stable")  # positions stand by group from here on
    used, group, member = used[order], group[order], member[order]
    h = np.take(h, used, axis=0)
    count = np.bincount(group, minlength=len(p["g"]))
    ends = np.cumsum(count)
    spans = [(g, i, j) for g, (i, j) in enumerate(zip((ends - count).tolist(), ends.tolist())) if i < j]
    grad, w, at = {}, kind.type(1.0 / n), np.arange(n)

    z = h @ p["G"]
    z += p["g"]
    loss = _softmax_loss(z, group, at)
    z *= w
    grad["G"], grad["g"], dh = h.T @ z, np.ones(n, kind) @ z, z @ p["G"].T
    z, inner = np.empty((n, width), kind), np.empty((n, dim), kind)
    for g, i, j in spans:
        np.matmul(h[i:j], p["T"][g], out=z[i:j])
    z += np.take(p["t"], group, axis=0)
    loss += _softmax_loss(z, member, at)
    z *= w
    grad["T"], grad["t"] = np.zeros_like(p["T"]), np.zeros_like(p["t"])
    for g, i, j in spans:
        np.matmul(h[i:j].T, z[i:j], out=grad["T"][g])
        np.matmul(z[i:j], p["T"][g].T, out=inner[i:j])
    grad["t"][[g for g, _, _ in spans]] = np.add.reduceat(z, [i for _, i, _ in spans], axis=0)
    dh += inner

    by_now, by_last, by_key = np.empty((rows, 3 * dim), kind), np.empty((rows, 2 * dim), kind), np.empty((*k.shape[:2], 2 * dim), kind)
    full = np.zeros((rows, dim), kind)
    full[used] = dh
    by_now[:, :dim], by_last[:, :dim] = full, full
    np.multiply(full, pb, out=by_now[:, dim:2 * dim])
    np.multiply(full, pa, out=by_last[:, dim:])
    grad["O"], grad["R"] = c.T @ full, np.zeros_like(p["R"])
    dc = (full @ p["O"].T).reshape(-1, step, dim)
    dq = by_now[:, 2 * dim:].reshape(-1, step, dim)
    c = c.reshape(-1, step, dim)
    for x in range(HEADS):
        cut = slice(x * part, (x + 1) * part)
        kept = slice(dim + x * part, dim + (x + 1) * part)
        np.matmul(att[x].transpose(0, 2, 1), dc[:, :, cut], out=by_key[:, :, kept])
        ds = np.matmul(dc[:, :, cut], v[:, :, cut].transpose(0, 2, 1))
        ds -= ((c[:, :, cut] * dc[:, :, cut]) @ np.ones(part, kind))[:, :, None]  # the weights' own mean of it
        ds *= att[x]
        by_far = (np.ones(len(ds), kind) @ ds.reshape(len(ds), -1)).reshape(far.shape)
        grad["R"][x] = np.bincount(np.maximum(far, 0).ravel(), (by_far * (far >= 0)).ravel(), back + step)
        np.matmul(ds, k[:, :, cut], out=dq[:, :, cut])
        np.matmul(ds.transpose(0, 2, 1), q[:, :, cut], out=by_key[:, :, cut])
    by_now[:, 2 * dim:] = dq.reshape(-1, dim)
    grad["U"], grad["A"], dq = np.split(_sums(size, now, by_now), 3, axis=1)
    grad["P"], grad["B"] = np.split(_sums(size, last, by_last), 2, axis=1)
    dk, dv = np.split(_sums(size, flat, by_key.reshape(-1, 2 * dim)), 2, axis=1)
    grad["E"] = np.zeros_like(p["E"])
    for x, d in (("Q", dq * scale), ("K", dk), ("V", dv)):
        grad[x] = p["E"].T @ d
        grad["E"] += d @ p[x].T
    return float(loss / n), grad


def _exp(s: np.ndarray, seen: np.ndarray) -> None:
    """In place; what isn't seen counts as 0.  Any number may be taken off a row, so none is when all are small."""
    if s.max() > _TOP or np.where(seen > 0, s, 0).min() < -_TOP:
        s -= np.where(seen > 0, s, s.dtype.type(_BIG)).max(axis=-1, keepdims=True)
        np.clip(s, -_TOP, _TOP, out=s)
    np.exp(s, out=s)
    s *= seen


def _softmax_loss(z: np.ndarray, at: np.ndarray, rows: np.ndarray) -> float:
    """Turns ``z`` into the gradient of the summed loss, minus the log of the softmax at one place of each row."""
    if z.max() > _TOP or z.min() < -_TOP:
        z -= z.max(axis=1, keepdims=True)
        np.maximum(z, -_TOP, out=z)
    np.exp(z, out=z)
    z /= (z @ np.ones(z.shape[1], z.dtype))[:, None]
    loss = -np.log(z[rows, at] + 1e-30).sum()
    z[rows, at] -= 1
    return loss


def _sums(size: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the rows of each place.  Two columns are added at a time, as one complex number."""
    order = np.argsort(at.astype(np.min_scalar_type(size)), kind="stable")
    s = at[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    pairs = np.take(rows, order, axis=0).view(np.result_type(rows.dtype, np.complex64))
    out[s[first]] = np.add.reduceat(pairs, first, axis=0).view(rows.dtype)
    return out


def train(p: dict[str, np.ndarray], ids: np.ndarray, lengths: np.ndarray, back: int, step: int, steps: int, batch: int = 256,
          rate: float = 0.01, decay: float = 0.3, seed: int = 5) -> list[float]:
    """Adam in place over windows of texts (``ids`` holds, for each text, one id more than its
    length: what stands before each position, and the last target)."""
    text, first = window_list(lengths, step)
    if not len(text):
        return []
    rng, losses = np.random.default_rng(seed), []
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    order = np.zeros(0, np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    for t in range(1, steps + 1):
        while len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(text))])
        rows, order = order[:batch], order[batch:]
        at, absent, scored = window_ids(text[rows], first[rows], lengths, back, step, starts)
        loss, g = gradients(p, ids[at], absent, ids[at[:, back:] + 1], scored, back, step)
        losses.append(loss)
        lr = rate * min(1.0, t / 20) * (1.0 - 0.95 * t / steps)
        for k, w in p.items():
            d = g[k] - m[k]
            d *= 0.1
            m[k] += d
            np.multiply(g[k], g[k], out=d)
            d -= v[k]
            d *= 0.01
            v[k] += d
            np.multiply(v[k], 1 / (1 - 0.99**t), out=d)
            np.sqrt(d, out=d)
            d += 1e-8
            np.divide(m[k], d, out=d)
            d *= lr / (1 - 0.9**t)
            w *= 1 - lr * decay
            w -= d
    return losses
