"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as a trained vector of its hash next to the mean of trained vectors of its
character trigrams. Gated recurrent units read a window of words in both directions, an
attention over the positions pools their states, and a logistic unit scores the window.
Every text is covered by overlapping windows and its score is that of its worst window,
calibrated on documents.

Training takes at most ``sample`` labelled documents per class, picked by a hash of their
id. Windows first carry the label of their document, then only the worst windows of each
document do, as found by the model so far. It runs on the driver on that bounded sample;
scoring runs in the tasks, with the model's few hundred kilobytes in their closure.

Contract. NULL and empty texts are one window of padding and get a score too. Documents
without a label teach nothing; one with several labels counts with the largest. Without
both classes among the labels all scores are the share of positives, 0.5 without any.
Repeated rows get equal scores. Empty tables give empty results.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.llm.common import map_batches, texts

SPAN, STRIDE = 24, 12
"""Words per window, and words between the starts of windows."""

BUCKETS, CHAR, SIZE, HIDDEN = 1 << 13, 1 << 12, 8, 8
DECAY = 1e-4
"""Weight decay of word and character vectors."""
EDGES = b".,;:!?\"'()[]*#-_"
PIECE = 250_000
"""Words that are scored at a time, which bounds memory and changes no score."""


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def numbered(docs: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words in order, and the number of every word of all texts."""
    known = sorted(set().union(*docs))
    number = dict(zip(known, range(len(known)), strict=True))
    return known, np.fromiter(map(number.__getitem__, chain.from_iterable(docs)), np.int64, sum(map(len, docs)))


def word_inputs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash buckets of words, and trigram buckets with the word each belongs to."""
    bare = [w.strip(EDGES) or w for w in words]
    ids = np.fromiter((xxhash.xxh3_64_intdigest(w) % BUCKETS for w in bare), np.int64, len(bare))
    joined = np.frombuffer(b"".join(b"^^" + w + b"$" for w in bare), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, bare), np.int64, len(bare)) + 3
    owner = np.repeat(np.arange(len(bare)), sizes)
    code = (joined[:-2] * 263 + joined[1:-1]) * 263 + joined[2:] if len(joined) else joined
    inside = owner[:-2] == owner[2:] if len(joined) else np.zeros(0, bool)
    return ids, (code[inside] * 2654435761 >> 7) % CHAR, owner[:-2][inside] if len(joined) else owner


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of all windows (-1: padding) and the text each window is of."""
    places, of, at = [], [], 0
    step = np.arange(SPAN)
    for i, n in enumerate(lengths.tolist()):
        if n <= SPAN:
            places.append(np.where(step < n, at + step, -1)[None])
            of.append(np.array([i]))
        else:
            starts = np.append(np.arange(0, n - SPAN, STRIDE), n - SPAN)
            places.append(at + starts[:, None] + step)
            of.append(np.full(len(starts), i))
        at += n
    return np.concatenate(places), np.concatenate(of)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"word": np.zeros((BUCKETS, SIZE), np.float32), "char": normal(CHAR, SIZE, scale=0.1)}
        for side in "fb":
            self.p |= {
                f"in_{side}": normal(2 * SIZE, 3 * HIDDEN, scale=0.4), f"bias_{side}": np.zeros(3 * HIDDEN, np.float32),
                f"state_{side}": normal(HIDDEN, 3 * HIDDEN, scale=0.3),
            }
        self.p |= {"attend": normal(2 * HIDDEN, scale=0.3), "out": normal(2 * HIDDEN, scale=0.3), "shift": np.zeros(1, np.float32)}
        self.slope, self.offset, self.share = 1.0, 0.0, None
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps = 0
        self.common = np.ones(BUCKETS, bool)

    def inputs(self, ids, tri, owner) -> np.ndarray:
        """Vectors of words; the last row is padding."""
        n = len(ids)
        x = np.zeros((n + 1, 2 * SIZE), np.float32)
        x[:n, :SIZE] = self.p["word"][ids]
        if len(tri):
            count = np.bincount(owner, minlength=n)
            starts = np.searchsorted(owner, np.arange(n))
            x[:n, SIZE:] = np.add.reduceat(self.p["char"][tri], starts) / count[:, None]
        return x

    def read(self, side: str, proj: np.ndarray, at: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
        """States [T, B, h] of one direction over positions ``at`` [B, T] of projected words."""
        state = self.p[f"state_{side}"]
        h = np.zeros((len(at), HIDDEN), np.float32)
        out = np.empty((SPAN, len(at), HIDDEN), np.float32)
        for t in range(SPAN) if side == "f" else range(SPAN - 1, -1, -1):
            x, u = proj[at[:, t]], h @ state
            gates = sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            if mask is not None:
                new = np.where(mask[:, t, None], new, h)
            if keep is not None:
                keep.append((t, h, z, r, n, u[:, 2 * HIDDEN :]))
            out[t] = h = new
        return out

    def logits(self, x: np.ndarray, at: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Scores of windows ``at`` [B, T] over word vectors ``x`` (-1: padding, the last row)."""
        mask = at >= 0 if (at[:, -1] < 0).any() else None
        both = []
        for side in "fb":
            keep = None if kept is None else kept.setdefault(side, [])
            both.append(self.read(side, x @ self.p[f"in_{side}"] + self.p[f"bias_{side}"], at, mask, keep))
        h = np.concatenate(both, 2)
        a = h @ self.p["attend"]
        if mask is not None:
            a = np.where(mask.T, a, -1e9)
        e = np.exp(a - a.max(0))
        if mask is not None:
            e = e * mask.T
        alpha = e / np.maximum(e.sum(0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", alpha, h)
        if kept is not None:
            kept |= {"h": h, "alpha": alpha, "pooled": pooled, "mask": mask}
        return pooled @ self.p["out"] + self.p["shift"][0]

    def learn(self, words: tuple, at: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One step of Adam on the windows ``at`` over the words (ids, trigrams, owners)."""
        used = np.unique(at[at >= 0])
        ids, tri, owner = words
        rank = np.full(len(ids) + 1, -1)
        rank[used] = np.arange(len(used))
        lo, hi = np.searchsorted(owner, used), np.searchsorted(owner, used, side="right")
        pick = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi, strict=True)]) if len(used) else np.zeros(0, np.int64)
        ids, tri, owner = ids[used], tri[pick], rank[owner[pick]]
        at = np.where(at >= 0, rank[at], -1)
        x = self.inputs(ids, tri, owner)
        kept: dict = {}
        d = ((sigmoid(self.logits(x, at, kept)) - y) * weight / len(y)).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["shift"][0], g["out"] = d.sum(), kept["pooled"].T @ d
        dc = d[:, None] * self.p["out"]
        h, alpha = kept["h"], kept["alpha"]
        dalpha = np.einsum("tbh,bh->tb", h, dc)
        da = alpha * (dalpha - (alpha * dalpha).sum(0))
        g["attend"] = np.einsum("tb,tbh->h", da, h)
        dh_all = alpha[:, :, None] * dc + da[:, :, None] * self.p["attend"]
        place = np.where(at < 0, len(used), at).T.ravel()
        order = np.argsort(place, kind="stable")
        firsts, heads = np.unique(place[order], return_index=True)
        dx = np.zeros_like(x)
        for s, side in enumerate("fb"):
            state, dstate, carry = self.p[f"state_{side}"], g[f"state_{side}"], 0.0
            deltas = np.empty((SPAN, len(at), 3 * HIDDEN), np.float32)
            for t, before, z, r, n, u in reversed(kept[side]):
                dh = dh_all[t][:, s * HIDDEN : (s + 1) * HIDDEN] + carry
                live = dh if kept["mask"] is None else np.where(kept["mask"][:, t, None], dh, 0)
                dn = live * (1 - z) * (1 - n * n)
                dz = live * (before - n) * z * (1 - z)
                dr = dn * u * r * (1 - r)
                deltas[t] = np.concatenate([dz, dr, dn], 1)
                du = np.concatenate([dz, dr, dn * r], 1)
                dstate += before.T @ du
                carry = live * z + du @ state.T + (dh - live)
            dproj = np.zeros((len(x), 3 * HIDDEN), np.float32)
            dproj[firsts] = np.add.reduceat(deltas.reshape(-1, 3 * HIDDEN)[order], heads)
            g[f"in_{side}"], g[f"bias_{side}"] = x.T @ dproj, dproj.sum(0)
            dx += dproj @ self.p[f"in_{side}"].T
        np.add.at(g["word"], ids, dx[:-1, :SIZE])
        if len(tri):
            np.add.at(g["char"], tri, (dx[:-1, SIZE:] / np.bincount(owner, minlength=len(ids))[:, None])[owner])
        g["word"] = np.where(self.common[:, None], g["word"] + DECAY * self.p["word"], 0)
        g["char"] += DECAY * self.p["char"]
        self.steps += 1
        for k, v in g.items():
            m, s = self.moments[k]
            m += 0.1 * (v - m)
            s += 0.001 * (v * v - s)
            self.p[k] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(s / (1 - 0.999**self.steps)) + 1e-8)

    def worst(self, docs: list[list[bytes]]) -> np.ndarray:
        """The largest window logit of each text."""
        known, flat = numbered(docs)
        at, of = windows(np.fromiter(map(len, docs), np.int64, len(docs)))
        words = np.append(flat, -1)[at]
        x = self.inputs(*word_inputs(known))
        scores = np.full(len(docs), -np.inf)
        full = words[:, -1] >= 0
        for group in (np.flatnonzero(full), np.flatnonzero(~full)):
            for i in range(0, len(group), 4096):
                part = group[i : i + 4096]
                np.maximum.at(scores, of[part], self.logits(x, words[part]))
        return scores

    def score(self, docs: list[list[bytes]]) -> np.ndarray:
        """Between 0 and 1, higher for worse."""
        if self.share is not None or not docs:
            return np.full(len(docs), self.share if self.share is not None else 0.5)
        out, i = [], 0
        while i < len(docs):
            j, size = i, 0
            while j < len(docs) and (j == i or size + len(docs[j]) <= PIECE):
                size += len(docs[j])
                j += 1
            out.append(self.worst(docs[i:j]))
            i = j
        return sigmoid(np.clip(self.slope * np.concatenate(out) + self.offset, -30, 30))


def leaning(ids: np.ndarray, docs: list[list[bytes]], flat: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where word vectors start in their first place: how unevenly a bucket's documents are spread over the classes.

    The difference of the two shares in standard errors, a quarter of it, within one.
    Buckets of fewer than three documents start and stay at zero: their words are read by
    their characters alone, in training as in scoring.
    """
    doc = np.repeat(np.arange(len(docs)), np.fromiter(map(len, docs), np.int64, len(docs)))
    pairs = np.unique(doc * BUCKETS + ids[flat])
    of, bucket = pairs // BUCKETS, pairs % BUCKETS
    many = np.bincount(bucket, minlength=BUCKETS)
    bad = np.bincount(bucket, y[of], BUCKETS)
    share = y.mean()
    z = (bad - many * share) / np.sqrt(np.maximum(many, 1) * share * (1 - share) + 1)
    common = many >= 3
    return np.where(common, np.clip(z / 4, -1, 1), 0).astype(np.float32), common


def train(docs: list[list[bytes]], y: np.ndarray, seed: int = 5) -> Network:
    net, draw = Network(seed), np.random.default_rng(seed)
    y = np.asarray(y, np.float32)
    if not len(y) or y.min() == y.max():
        net.share = 0.5 if not len(y) else float(y[0])
        return net
    known, flat = numbered(docs)
    words = word_inputs(known)
    at, of = windows(np.fromiter(map(len, docs), np.int64, len(docs)))
    at = np.append(flat, -1)[at]
    net.p["word"][:, 0], net.common = leaning(words[0], docs, flat, y)

    def rounds(chosen: np.ndarray, times: int, rate: float) -> None:
        for _ in range(times):
            order = draw.permutation(chosen)
            size = int(np.clip(len(order) // 40, 64, 512))
            for i in range(0, len(order), size):
                part = order[i : i + size]
                net.learn(words, at[part], y[of[part]], np.ones(len(part), np.float32), rate)

    def all_logits() -> np.ndarray:
        x = net.inputs(*words)
        return np.concatenate([net.logits(x, at[i : i + 4096]) for i in range(0, len(at), 4096)])

    def some(each: int, score: np.ndarray) -> np.ndarray:
        """The ``each`` windows of a document with the largest score."""
        order = np.lexsort((-score, of))
        first = np.searchsorted(of[order], np.arange(len(docs)))
        rank = np.arange(len(order)) - first[of[order]]
        return order[rank < each]

    rounds(some(10, draw.random(len(at))), 3, 0.01)
    for rate in (0.006, 0.006, 0.004, 0.003, 0.002):
        logit = all_logits()
        worst = some(1, logit)
        calm = some(2, np.where(y[of] > 0, -np.inf, logit))
        chance = some(3, draw.random(len(at)))
        chosen = np.concatenate([worst, calm[y[of[calm]] == 0], chance[y[of[chance]] == 0]])
        rounds(chosen, 3, rate)
    top = np.full(len(docs), -np.inf)
    np.maximum.at(top, of, all_logits())
    a, b = 1.0, 0.0
    for _ in range(500):  # logistic calibration of the documents' worst windows
        e = sigmoid(a * top + b) - y
        a, b = a - 0.05 * float((e * top).mean()), b - 0.05 * float(e.mean())
    net.slope, net.offset, net.moments, net.common = max(a, 0.05), b, {}, None
    return net


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = 1000) -> Network:
    """Train on at most ``sample`` documents per class; ``labels`` are those it may learn from."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg((F.max(label) > 0).cast("int").alias("_y"))
    pick = lambda c: known.where(F.col("_y") == c).orderBy(F.xxhash64(key), key).limit(sample)
    chosen = F.broadcast(pick(0).union(pick(1)))  # 2 * sample ids at most
    rows = docs.join(chosen, key).select(key, F.col(text).cast("binary").alias("t"), "_y").collect()
    rows = sorted(rows, key=lambda r: (r[0], r["t"] or b""))
    return train([tokens(bytes(r["t"] or b"")) for r in rows], np.array([r["_y"] for r in rows]))


def scored(docs: DataFrame, model: Network, key: str = "doc_id", text: str = "text", out: str = "score") -> DataFrame:
    """(key, score) of every whole text."""

    def run(batch: pa.RecordBatch) -> dict:
        made, held, size = [], [], 0
        for t in texts(batch, text):
            held.append(tokens(t))
            size += len(held[-1])
            if size > PIECE:
                made.append(model.score(held))
                held, size = [], 0
        made.append(model.score(held))
        return {out: pa.array(np.concatenate(made).astype(np.float64))}

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField(out, T.DoubleType())])
    return map_batches(docs.select(key, text), run, schema)


def toxic(score: Column, threshold: float = 0.3) -> Column:
    return score >= threshold
