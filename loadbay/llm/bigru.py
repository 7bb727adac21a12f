"""A bidirectional gated recurrent network with attention pooling, in numpy, with its training.

A step's input is a word: an embedding of the word (hashed) beside the mean of the embeddings of
its character trigrams (hashed, with word boundaries). Both directions run over a window of
words, attention weighs the steps, and a linear layer gives the window's logit. Weights of the
input are applied once per distinct word, so a step costs only the recurrent product.
"""

from __future__ import annotations

import numpy as np

WORDS, GRAMS = 1 << 15, 1 << 13     # hash buckets
DW, DC, H, A = 6, 6, 10, 8          # word, character, hidden, attention sizes


def init(seed: int, word_odds: np.ndarray, gram_odds: np.ndarray) -> dict[str, np.ndarray]:
    """Small random weights; the first input of each embedding starts at the bucket's log odds."""
    r = np.random.default_rng(seed)
    p = {"Ew": r.normal(0, .1, (WORDS, DW)), "Ec": r.normal(0, .1, (GRAMS, DC)),
         "wo": r.normal(0, .5, 2 * H), "bo": np.zeros(1), "Wa": r.normal(0, .4, (2 * H, A)),
         "va": r.normal(0, .5, A)}
    p["Ew"][:, 0], p["Ec"][:, 0] = word_odds, gram_odds
    for d in "fb":
        p["W" + d] = r.normal(0, .4, (DW + DC, 3 * H))
        p["U" + d] = r.normal(0, .3, (H, 3 * H))
        p["b" + d] = np.zeros(3 * H)
    return {k: v.astype(np.float32) for k, v in p.items()}


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def embed(p, word: np.ndarray, gram: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Inputs of distinct words: word buckets, and trigram buckets gram[bounds[i]:bounds[i + 1]]."""
    sums = np.add.reduceat(p["Ec"][gram], bounds[:-1], axis=0) if len(gram) else np.zeros((len(word), DC), np.float32)
    return np.concatenate([p["Ew"][word], sums / np.diff(bounds)[:, None]], axis=1).astype(np.float32)


def _gru(gates, U, mask, reverse, keep):
    """Hidden states (steps, windows, H); gates(t) gives the input part of step t."""
    steps, n = mask.shape
    h = np.zeros((n, H), np.float32)
    out, saved = np.zeros((steps, n, H), np.float32), []
    for t in (range(steps - 1, -1, -1) if reverse else range(steps)):
        g, hu = gates(t), h @ U
        zr = sigmoid(g[:, :2 * H] + hu[:, :2 * H])
        z, r = zr[:, :H], zr[:, H:]
        c = np.tanh(g[:, 2 * H:] + r * hu[:, 2 * H:])
        step = mask[t][:, None] * (1 - z)
        new = h + step * (c - h)
        if keep:
            saved.append((t, h, z, r, c, hu[:, 2 * H:]))
        h = out[t] = new
    return out, saved


def states(p, x: np.ndarray, steps: np.ndarray, direction: str) -> np.ndarray:
    """Hidden states (steps, count, H) of one direction ("f" or "b") over steps (steps x count)."""
    at = np.maximum(steps, 0)
    table = x @ p["W" + direction] + p["b" + direction]
    return _gru(lambda t: table[at[t]], p["U" + direction], (steps >= 0).astype(np.float32), direction == "b", False)[0]


def attended(p, forth: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What attention pooling needs of each step: its score, and its share of the logit."""
    score = np.tanh(forth @ p["Wa"][:H] + back @ p["Wa"][H:]) @ p["va"]
    return score, forth @ p["wo"][:H] + back @ p["wo"][H:]


def forward(p, x: np.ndarray, windows: np.ndarray, core: slice, keep: bool = False):
    """Logits of windows (steps x count, indices into x; -1 is padding). Both directions read all steps,
    attention weighs those of ``core``."""
    mask = (windows >= 0).astype(np.float32)
    pool = np.zeros_like(mask)
    pool[core] = mask[core]
    at = np.maximum(windows, 0)
    parts, saved = [], []
    for d in "fb":
        table = x @ p["W" + d] + p["b" + d]
        h, s = _gru(lambda t, table=table: table[at[t]], p["U" + d], mask, d == "b", keep)
        parts.append(h)
        saved.append(s)
    h = np.concatenate(parts, axis=2)
    a = np.tanh(h @ p["Wa"])
    score = np.where(pool > 0, a @ p["va"], -1e9)
    w = np.exp(score - score.max(axis=0)) * pool
    w /= np.maximum(w.sum(axis=0), 1e-9)
    pooled = (w[:, :, None] * h).sum(axis=0)
    logit = pooled @ p["wo"] + p["bo"][0]
    return (logit, (mask, at, h, a, w, pooled, saved)) if keep else logit


def backward(p, x, cache, dlogit, word, gram, bounds) -> dict[str, np.ndarray]:
    mask, at, h, a, w, pooled, saved = cache
    g = {"wo": pooled.T @ dlogit, "bo": np.array([dlogit.sum()], np.float32)}
    dpooled = dlogit[:, None] * p["wo"]
    dw = (h * dpooled).sum(axis=2)
    dscore = w * (dw - (w * dw).sum(axis=0))
    da = dscore[:, :, None] * p["va"] * (1 - a * a)
    g["va"] = np.tensordot(dscore, a, ((0, 1), (0, 1)))
    g["Wa"] = np.tensordot(h, da, ((0, 1), (0, 1)))
    dh_all = w[:, :, None] * dpooled + da @ p["Wa"].T
    dx = np.zeros_like(x)
    for i, d in enumerate("fb"):
        U, dU = p["U" + d], np.zeros_like(p["U" + d])
        dtable = np.zeros((len(x), 3 * H), np.float32)
        carry = np.zeros((mask.shape[1], H), np.float32)
        for t, before, z, r, c, hc in reversed(saved[i]):
            dnew = dh_all[t, :, i * H:(i + 1) * H] + carry
            m = mask[t][:, None]
            dz = dnew * m * (before - c) * z * (1 - z)
            dc = dnew * m * (1 - z) * (1 - c * c)
            dr = dc * hc * r * (1 - r)
            dg = np.concatenate([dz, dr, dc], axis=1)
            dhu = np.concatenate([dz, dr, dc * r], axis=1)
            carry = dnew * (1 - m * (1 - z)) + dhu @ U.T
            dU += before.T @ dhu
            np.add.at(dtable, at[t], dg * m)
        g["U" + d], g["b" + d] = dU, dtable.sum(axis=0)
        g["W" + d] = x.T @ dtable
        dx += dtable @ p["W" + d].T
    g["Ew"], g["Ec"] = np.zeros_like(p["Ew"]), np.zeros_like(p["Ec"])
    np.add.at(g["Ew"], word, dx[:, :DW])
    size = np.diff(bounds)
    np.add.at(g["Ec"], gram, np.repeat(dx[:, DW:] / size[:, None], size, axis=0))
    return g


class Adam:
    def __init__(self, p, rate: float):
        self.rate, self.n = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, p, g):
        self.n += 1
        for k in p:
            self.m[k] += 0.1 * (g[k] - self.m[k])
            self.v[k] += 0.01 * (g[k] * g[k] - self.v[k])
            p[k] -= self.rate * (self.m[k] / (1 - .9 ** self.n)) / (np.sqrt(self.v[k] / (1 - .99 ** self.n)) + 1e-7)
