"""Toxicity scores by a bidirectional gated recurrent network in numpy.

A text is cut into windows of WINDOW words, each starting STRIDE words after
the one before, so all words lie in windows and neighbours overlap. A word's
input joins a learned vector of the word (its letters and digits, without
punctuation at the ends) and the mean vector of its character trigrams. Two
GRUs read the window in both directions, attention pools their states, and a
logistic unit scores the window. A text's score is that of its worst window.

Training takes labelled rows only, in the order of their ids' hashes: at most
TRAIN_ROWS, whose texts have at most TRAIN_BYTES together; of these, every window
of the whole texts. The driver works on SLICE_BYTES of text at a time. Labels are
of texts, not windows: training learns from each text's worst window so far, and
from others of the clean ones. A word's first component
starts at its log odds in the training rows.

Null and empty texts have one window without words, whose score is the bias.
Without labelled rows of both kinds every text scores the prior, 0 or so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.words import LEAN_BATCH, LEAN_SLICE, lean, mix, ragged, small_batches, span_hashes, texts, without

WINDOW, STRIDE = 32, 16
TRAIN_ROWS, TRAIN_BYTES = 3000, 48_000_000
MIN_DOCS = 3  # training texts that hold a word before it gets a vector of its own
WORD, CHARS, HIDDEN, ATTENTION = 10, 6, 8, 8
TRIGRAMS = 1 << 12
STEPS = 12  # updates in an epoch, at least: small training tables have smaller batches
EPOCHS, RERANK, BATCH, RATE = 6, 3, 384, 0.015

_PUNCT = np.ones(256, bool)
_PUNCT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Words:
    """The distinct words of some bytes: key hashes of their cores (without
    punctuation at the ends; of the whole word if nothing is left) and the
    trigram buckets of ^core$, one after another."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.hashes, where, self.of = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        a, b = starts[where].copy(), ends[where].copy()
        for at, step in ((a, 1), (b, -1)):
            live = np.arange(len(at))
            while len(live):
                live = live[(a[live] < b[live]) & _PUNCT[data[at[live] - (step < 0)]]]
                at[live] += step
        hollow = a >= b
        a[hollow], b[hollow] = starts[where][hollow], ends[where][hollow]
        self.keys = span_hashes(data, a, b)
        size = b - a
        self.first = np.cumsum(size) - size
        inner = np.repeat(a - self.first, size) + np.arange(int(size.sum()))
        mid = data[inner].astype(np.uint64) if len(inner) else np.zeros(0, np.uint64)
        last = np.zeros(len(mid), bool)
        last[self.first + size - 1] = True
        before = np.concatenate([[0], mid[:-1]]).astype(np.uint64)
        before[self.first] = 1
        after = np.concatenate([mid[1:], [0]]).astype(np.uint64)[: len(mid)]
        after[last] = 2
        self.trigrams = (mix((before << np.uint64(16)) | (mid << np.uint64(8)) | after) & np.uint64(TRIGRAMS - 1)).astype(np.int64)
        self.size = size


def gathered(column) -> tuple[Words, np.ndarray]:
    """The words of all rows, read in slices, and the place of each row's first word."""
    parts, row_word, seen = [], [np.zeros(1, np.int64)], 0
    for t in texts(column, lower=True):
        parts.append(Words(t.data, t.starts, t.ends))
        row_word.append(t.row_word[1:] + seen)
        seen += len(t.starts)
    out = object.__new__(Words)
    join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
    out.hashes, one, number = np.unique(join([w.hashes for w in parts], np.uint64), return_index=True, return_inverse=True)
    before = np.cumsum([0] + [len(w.hashes) for w in parts])
    out.of = join([number[a + w.of] for a, w in zip(before, parts)], np.int64)
    sizes = join([w.size for w in parts], np.int64)
    out.keys, out.size = join([w.keys for w in parts], np.uint64)[one], sizes[one]
    out.trigrams = ragged(join([w.trigrams for w in parts], np.int64), (np.cumsum(sizes) - sizes)[one], out.size)
    out.first = np.cumsum(out.size) - out.size
    return out, np.concatenate(row_word)


def windows(row_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and length of all windows; a row without words has one of length 0."""
    n = np.diff(row_word)
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = row_word[row] + k * STRIDE
    return row, start, np.minimum(WINDOW, row_word[row + 1] - start)


class Network:
    def __init__(self, vocabulary: np.ndarray, odds: np.ndarray, rng: np.random.Generator):
        """``vocabulary``: sorted key hashes; ``odds``: log odds of each. Vector 0 is for all other words."""
        self.vocabulary = vocabulary
        d = WORD + CHARS
        f = lambda *s, scale=1.0: (rng.standard_normal(s) * scale / np.sqrt(s[0])).astype(np.float32)
        word = (rng.standard_normal((len(vocabulary) + 1, WORD)) * 0.05).astype(np.float32)
        word[0] = 0
        word[1:, 0] = odds
        self.p = {"word": word, "chars": (rng.standard_normal((TRIGRAMS, CHARS)) * 0.05).astype(np.float32),
                  "attend": f(2 * HIDDEN, ATTENTION), "pick": f(ATTENTION), "out": f(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        for side in "fb":
            self.p |= {f"in_{side}": f(d, 3 * HIDDEN), f"rec_{side}": f(HIDDEN, 3 * HIDDEN), f"add_{side}": np.zeros(3 * HIDDEN, np.float32)}

    def inputs(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """The vector of each distinct word, with one of zeros behind, and vocabulary places."""
        place = np.zeros(len(w.keys), np.int64)
        if len(self.vocabulary) and len(w.keys):
            at = np.minimum(np.searchsorted(self.vocabulary, w.keys), len(self.vocabulary) - 1)
            place = np.where(self.vocabulary[at] == w.keys, at + 1, 0)
        x = np.zeros((len(w.keys) + 1, WORD + CHARS), np.float32)
        x[:-1, :WORD] = self.p["word"][place]
        if len(w.keys):
            x[:-1, WORD:] = np.add.reduceat(self.p["chars"][w.trigrams], w.first, axis=0) / w.size[:, None]
        return x, place

    def forward(self, x: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Scores (log odds) of the windows ``ids`` (n, WINDOW): places in x, the last one where no word is."""
        p, n, last = self.p, len(ids), len(x) - 1
        mask = (ids != last).astype(np.float32)
        states, tape = np.zeros((n, ids.shape[1], 2 * HIDDEN), np.float32), []
        h2 = 2 * HIDDEN
        for k, side in enumerate("fb"):
            proj, rec = x @ p[f"in_{side}"] + p[f"add_{side}"], p[f"rec_{side}"]
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(ids.shape[1]) if side == "f" else range(ids.shape[1] - 1, -1, -1):
                a = proj[ids[:, t]]
                u = h @ rec
                zr = 1 / (1 + np.exp(-(a[:, :h2] + u[:, :h2])))
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(a[:, h2:] + r * u[:, h2:])
                m = mask[:, t, None]
                new = h + m * (1 - z) * (c - h)
                if keep:
                    tape.append((side, t, h, z, r, c, u[:, h2:], m))
                h = new
                states[:, t, k * HIDDEN:(k + 1) * HIDDEN] = h
        hidden = np.tanh(states @ p["attend"])
        e = hidden @ p["pick"]
        e = np.exp(e - e.max(1, keepdims=True)) * mask
        a = e / np.maximum(e.sum(1, keepdims=True), 1e-9)
        pooled = (a[:, :, None] * states).sum(1)
        score = pooled @ p["out"] + p["bias"][0]
        return (score, (x, ids, states, hidden, a, pooled, tape)) if keep else score

    def backward(self, kept, grad: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weights and of x, given those of the scores."""
        p, (x, ids, states, hidden, a, pooled, tape) = self.p, kept
        g = {"out": pooled.T @ grad, "bias": np.array([grad.sum()], np.float32)}
        d_pool = grad[:, None] * p["out"]
        d_states = a[:, :, None] * d_pool[:, None, :]
        d_a = (states * d_pool[:, None, :]).sum(2)
        d_e = a * (d_a - (a * d_a).sum(1, keepdims=True))
        g["pick"] = (hidden * d_e[:, :, None]).sum((0, 1))
        d_hid = d_e[:, :, None] * p["pick"] * (1 - hidden * hidden)
        g["attend"] = np.einsum("nti,nta->ia", states, d_hid)
        d_states = d_states + d_hid @ p["attend"].T
        d_x = np.zeros_like(x)
        for side in "fb":
            g |= {f"rec_{side}": np.zeros_like(p[f"rec_{side}"]), f"in_{side}": np.zeros_like(p[f"in_{side}"]), f"add_{side}": np.zeros_like(p[f"add_{side}"])}
        d_h, now = None, ""
        for side, t, h, z, r, c, u, m in reversed(tape):
            if side != now:
                d_h, now = np.zeros_like(h), side
                d_proj = np.zeros((len(x), 3 * HIDDEN), np.float32)
            k = "fb".index(side)
            d = d_h + d_states[:, t, k * HIDDEN:(k + 1) * HIDDEN]
            d_c = d * m * (1 - z) * (1 - c * c)
            d_z = -d * m * (c - h) * z * (1 - z)
            d_r = d_c * u * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_c * r], 1)
            d_p = np.concatenate([d_z, d_r, d_c], 1)
            g[f"rec_{side}"] += h.T @ d_u
            np.add.at(d_proj, ids[:, t], d_p)
            d_h = d * (1 - m * (1 - z)) + d_u @ p[f"rec_{side}"].T
            if t == (0 if side == "f" else ids.shape[1] - 1):
                g[f"in_{side}"] = x.T @ d_proj
                g[f"add_{side}"] = d_proj.sum(0)
                d_x += d_proj @ p[f"in_{side}"].T
        return g, d_x


def _ids(of: np.ndarray, start: np.ndarray, length: np.ndarray, last: int) -> np.ndarray:
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    return np.where(inside, of[np.where(inside, at, 0)], last) if len(of) else np.full((len(start), WINDOW), last)


def window_scores(net: Network, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row_word: np.ndarray,
                  block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Row and log odds of each window."""
    w = Words(data, starts, ends)
    x, _ = net.inputs(w)
    row, first, length = windows(row_word)
    out = np.empty(len(row), np.float32)
    for s in range(0, len(row), block):
        out[s:s + block] = net.forward(x, _ids(w.of, first[s:s + block], length[s:s + block], len(x) - 1))
    return row, out


def train(column, toxic: np.ndarray, seed: int = 1) -> Network:
    """Fits the network on whole texts (``column``: strings) and their 0/1 labels."""
    rng = np.random.default_rng(seed)
    w, row_word = gathered(column)
    toxic = toxic.astype(np.float32)
    good, bad = max(float((1 - toxic).sum()), 0.0), float(toxic.sum())
    # texts that hold each word's core, by kind
    cores, core_of = np.unique(w.keys, return_inverse=True)
    word_row = np.repeat(np.arange(len(row_word) - 1), np.diff(row_word))
    pair = np.unique(word_row * np.int64(len(cores) + 1) + core_of[w.of])
    row, core = pair // (len(cores) + 1), pair % (len(cores) + 1)
    held = np.bincount(core, minlength=len(cores))
    held_bad = np.bincount(core, toxic[row] if len(row) else None, minlength=len(cores))
    odds = np.log((held_bad + 0.5) / (bad + 1)) - np.log((held - held_bad + 0.5) / (good + 1))
    own = held >= MIN_DOCS
    net = Network(cores[own], np.clip(odds[own], -3, 4).astype(np.float32), rng)
    prior = float(np.clip(np.log((bad + 0.5) / (good + 0.5)), -4, 4)) if len(toxic) else -4.0
    net.p["bias"][0] = prior
    if not bad or not good:
        net.p["out"][:] = 0
        net.p["bias"][0] = min(prior, -1.0) if not bad else max(prior, 1.0)
        return net
    wrow, first, length = windows(row_word)
    heads = np.flatnonzero(np.concatenate([[True], wrow[1:] != wrow[:-1]]))
    spans = np.concatenate([heads, [len(wrow)]])
    guess = np.concatenate([np.zeros(1), odds])[core_of + 1] * own[core_of]  # by distinct word
    strong = np.concatenate([[0.0], np.cumsum(np.maximum(guess[w.of], 0) ** 2)]) if len(w.of) else np.zeros(1)
    rank = strong[first + length] - strong[first]
    moments: dict[str, list[np.ndarray]] = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    ticks = 0
    weight = np.where(toxic > 0, min(4.0, np.sqrt(good / bad)), 1.0).astype(np.float32)
    for epoch in range(EPOCHS):
        if epoch == RERANK:
            x, _ = net.inputs(w)
            rank = np.concatenate([net.forward(x, _ids(w.of, first[s:s + 8192], length[s:s + 8192], len(x) - 1))
                                   for s in range(0, len(wrow), 8192)])
        worst = np.array([a + int(rank[a:b].argmax()) for a, b in zip(spans[:-1], spans[1:])])
        other = spans[:-1] + (rng.random(len(heads)) * np.diff(spans)).astype(np.int64)
        clean = toxic[wrow[heads]] == 0
        chosen = np.concatenate([worst, other[clean]])
        rng.shuffle(chosen)
        batch = int(np.clip(len(chosen) // STEPS, 16, BATCH))
        for s in range(0, len(chosen), batch):
            some = chosen[s:s + batch]
            # the words of this batch alone; the place after the last is for no word
            ids = _ids(w.of, first[some], length[some], len(w.keys))
            used, local = np.unique(ids, return_inverse=True)
            local = local.reshape(ids.shape)
            sub = _subset(w, used[used < len(w.keys)])
            x, place = net.inputs(sub)
            score, kept = net.forward(x, local, keep=True)
            y = toxic[wrow[some]]
            grad = ((_sigmoid(score) - y) * weight[wrow[some]] / len(some)).astype(np.float32)
            g, d_x = net.backward(kept, grad)
            d_x = d_x[:-1]
            g["word"] = np.zeros_like(net.p["word"])
            np.add.at(g["word"], place, d_x[:, :WORD])
            g["word"][0] = 0
            g["chars"] = np.zeros_like(net.p["chars"])
            np.add.at(g["chars"], sub.trigrams, np.repeat(d_x[:, WORD:] / sub.size[:, None], sub.size, axis=0))
            ticks += 1
            for k, v in g.items():
                m1, m2 = moments[k]
                m1 += 0.1 * (v - m1)
                m2 += 0.01 * (v * v - m2)
                net.p[k] -= (RATE * (0.3 if k in ("word", "chars") else 1.0) * (m1 / (1 - 0.9 ** ticks))
                             / (np.sqrt(m2 / (1 - 0.99 ** ticks)) + 1e-6)).astype(np.float32)
    return net


def _subset(w: Words, some: np.ndarray) -> Words:
    """Only the distinct words ``some``."""
    out = object.__new__(Words)
    out.keys, out.size, out.of = w.keys[some], w.size[some], some
    out.first = np.cumsum(out.size) - out.size
    inner = np.repeat(w.first[some] - out.first, out.size) + np.arange(int(out.size.sum()))
    out.trigrams = w.trigrams[inner] if len(inner) else w.trigrams[:0]
    return out


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
                  limit: int = TRAIN_ROWS, limit_bytes: int = TRAIN_BYTES) -> pa.Table:
    """(text, y) of at most ``limit`` labelled ids, the first by their hash, whose
    whole texts have ``limit_bytes`` at most; rows with other labels than 0 and 1 are left out."""
    chosen = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("y"))
              .groupBy("_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("_id"), "_id").limit(limit))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("text")).dropna(subset=["_id"])
    # at most ``limit`` rows of two numbers are broadcast; a repeated id counts once
    # the running size is over at most ``limit`` rows
    size = F.sum(F.octet_length(F.coalesce("text", F.lit("")))).over(Window.orderBy(F.xxhash64("_id"), "_id"))
    return (rows.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.first("text").alias("text"), F.first("y").alias("y"))
            .withColumn("_size", size).where(F.col("_size") <= limit_bytes).orderBy("_id").select("text", "y").toArrow())


def fit(docs: DataFrame, labels: DataFrame, **names) -> Network:
    rows = training_rows(docs, labels, **names)
    return train(rows.column("text"), rows.column("y").to_numpy())


def score(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of the worst window."""
    small_batches(docs.sparkSession, LEAN_BATCH)
    docs = without(docs, "score")
    place, names = docs.columns.index(text), docs.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(place), lower=True, limit=LEAN_SLICE):
                row, s = window_scores(net, t.data, t.starts, t.ends, t.row_word)
                worst = np.full(len(t), -np.inf)
                np.maximum.at(worst, row, s)
                rows = batch.slice(t.first, len(t))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(_sigmoid(worst))], names=[*names, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(lean(task), f"{schema}, score double")
