"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A text is cut into overlapping windows of ``WINDOW`` words, one every ``STRIDE``, the last one
at the end. Each word enters as its own embedding (hashed) joined with the mean embedding of
its character n-grams (hashed, with word boundaries), so unseen words are judged by their
spelling. A GRU reads the window forwards, another backwards; attention weighs the states, and
the pooled state gives the window's logit. A text scores as its worst window.

Labels mark whole texts, so training looks for the guilty window: in each round the current
network picks the worst of a text's windows, and gradients (written out by hand, Adam) go
through that one. Embeddings start from how surprisingly often a word or n-gram occurs in
toxic training texts and learn slowly, those seen in few texts stay zero, and words are
dropped at random: what is rare could only be learnt by heart. The fit uses at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled texts, by a
hash order of their ids, and all windows of each; of either kind, only the first texts of that
order whose windows together are at most ``MAX_WINDOWS``. Scoring runs in tasks over every
window of every text. The projection of a word into the gates does not depend on its
neighbours, so tasks compute it once per distinct word and keep a bounded cache.

Cases: ASCII letters are lower-cased and ASCII punctuation separates words; a null, empty or
wordless text is one empty window; without labels of both classes every score is the share of
toxic labels (0.5 without any); a null doc_id is held out; repeated rows score alike.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import held_out, table, with_score
from ledgerline.llm.sampling import labelled, sample_rows, smallest_hashes

WINDOW, STRIDE = 64, 32
MAX_TOXIC, MAX_CLEAN, MAX_WINDOWS = 1500, 3000, 60_000
WORD_BUCKETS, GRAM_BUCKETS = 1 << 16, 1 << 16
EMBED, STATES, ATTENTION = 8, 12, 8
DROP, DECAY, SLOW = 0.15, 0.05, 0.1
CACHE_WORDS = 300_000
CHUNK = 1024
SEPARATORS = bytes.maketrans(bytes(c for c in range(33, 127) if not chr(c).isalnum()),
                             b" " * sum(not chr(c).isalnum() for c in range(33, 127)))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().translate(SEPARATORS).split()


def window_starts(n: int) -> np.ndarray:
    """First words of the overlapping windows of a text of ``n`` words."""
    if n <= WINDOW:
        return np.zeros(1, dtype=np.int64)
    starts = np.arange(0, n - WINDOW, STRIDE, dtype=np.int64)
    return np.append(starts, n - WINDOW)


def word_inputs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, the buckets of all character 3- and 4-grams, and where each word's start.

    Words are bounded by ^ and $$, so each has at least one n-gram. All words are hashed at
    once, over their bytes laid end to end."""
    buckets = np.fromiter((zlib.crc32(w) % WORD_BUCKETS for w in words), dtype=np.int64, count=len(words))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 3
    data = np.frombuffer(b"^" + b"$$^".join(words) + b"$$", dtype=np.uint8).astype(np.uint64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))  # bytes up to the word's end
    padded = np.r_[data, np.zeros(3, np.uint64)]
    three = sum(padded[i:i + len(data)] << np.uint64(8 * i) for i in range(3))
    both = np.stack([three, three | padded[3:] << np.uint64(24) | np.uint64(1 << 40)], axis=1)
    use = np.stack([left >= 3, left >= 4], axis=1)
    flat = ((both[use] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % GRAM_BUCKETS
    counts = np.add.reduceat(use.sum(axis=1), np.cumsum(sizes) - sizes)
    return buckets, flat, np.cumsum(counts) - counts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class BiGRU:
    """Parameters, forward pass, and gradients."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        f = lambda *shape: rng.normal(0, 1 / math.sqrt(shape[0]), shape).astype(np.float32)
        h = STATES
        self.p = {
            "word": rng.normal(0, 0.05, (WORD_BUCKETS, EMBED)).astype(np.float32),
            "gram": rng.normal(0, 0.05, (GRAM_BUCKETS, EMBED)).astype(np.float32),
            "in": f(2 * EMBED, 6 * h), "bias": np.zeros(6 * h, np.float32),
            "fwd": f(h, 3 * h), "bwd": f(h, 3 * h),
            "att": f(2 * h, ATTENTION), "look": f(ATTENTION),
            "out": f(2 * h), "base": np.zeros(1, np.float32),
        }
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    # --- forward

    def embed(self, inputs) -> np.ndarray:
        buckets, flat, starts = inputs
        sizes = np.diff(np.append(starts, len(flat)))
        mean = np.add.reduceat(self.p["gram"][flat], starts, axis=0) / sizes[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][buckets], mean], axis=1)

    def project(self, inputs) -> np.ndarray:
        """Gate inputs of each distinct word, both directions."""
        return self.embed(inputs) @ self.p["in"] + self.p["bias"]

    def _run(self, x: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None) -> np.ndarray:
        """GRU over axis 0 of gate inputs (steps, n, 3 states); all states."""
        h = STATES
        s = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((len(x), x.shape[1], h), np.float32)
        for t in range(len(x)):
            g = s @ u
            zr = sigmoid(x[t, :, :2 * h] + g[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            c = np.tanh(x[t, :, 2 * h:] + r * g[:, 2 * h:])
            new = s + mask[t] * (1 - z) * (c - s)
            if keep is not None:
                keep.append((s, z, r, c, g[:, 2 * h:]))
            s = out[t] = new
        return out

    def forward(self, proj: np.ndarray, idx: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows: ``idx`` (n, WINDOW) rows of ``proj``, ``mask`` of real words."""
        h, p = STATES, self.p
        x = proj[idx.T]
        m = mask.T[:, :, None].astype(np.float32)
        kf, kb = ([], []) if keep is not None else (None, None)
        states = np.concatenate([self._run(x[:, :, :3 * h], m, p["fwd"], kf),
                                 self._run(x[::-1, :, 3 * h:], m[::-1], p["bwd"], kb)[::-1]], axis=2)
        a = np.tanh(states @ p["att"])
        e = a @ p["look"] + np.where(mask.T, 0, -1e4).astype(np.float32)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", w, states)
        if keep is not None:
            keep.update(m=m, kf=kf, kb=kb, states=states, a=a, w=w, pooled=pooled)
        return pooled @ p["out"] + p["base"][0]

    # --- backward

    def _back(self, d: np.ndarray, m: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the gate inputs and of ``u`` for state gradients ``d`` (steps, n, states)."""
        h = STATES
        dx, du = np.empty((len(d), d.shape[1], 3 * h), np.float32), np.zeros_like(u)
        ds = np.zeros_like(d[0])
        for t in range(len(d) - 1, -1, -1):
            s, z, r, c, gc = kept[t]
            ds = ds + d[t]
            dn = ds * m[t]
            dc = dn * (1 - z) * (1 - c * c)
            dz = dn * (s - c) * z * (1 - z)
            dr = dc * gc * r * (1 - r)
            dx[t] = np.concatenate([dz, dr, dc], axis=1)
            dg = np.concatenate([dz, dr, dc * r], axis=1)
            du += s.T @ dg
            ds = ds * (1 - m[t]) + dn * z + dg @ u.T
        return dx, du

    def gradients(self, inputs, idx: np.ndarray, mask: np.ndarray, slope: np.ndarray, kept: dict) -> dict:
        """Gradients for d(loss)/d(logit) = ``slope`` after ``forward(..., keep=kept)``."""
        h, p, k = STATES, self.p, kept
        states, w, a = k["states"], k["w"], k["a"]
        g = {"out": k["pooled"].T @ slope, "base": np.array([slope.sum()], np.float32)}
        dp = slope[:, None] * p["out"]
        ds = w[:, :, None] * dp
        dw = np.einsum("nh,tnh->tn", dp, states)
        de = w * (dw - (w * dw).sum(axis=0))
        g["look"] = np.einsum("tn,tna->a", de, a)
        da = de[:, :, None] * p["look"] * (1 - a * a)
        g["att"] = np.einsum("tnh,tna->ha", states, da)
        ds += da @ p["att"].T
        dxf, g["fwd"] = self._back(ds[:, :, :h], k["m"], p["fwd"], k["kf"])
        dxb, g["bwd"] = self._back(ds[::-1, :, h:], k["m"][::-1], p["bwd"], k["kb"])
        dx = np.concatenate([dxf, dxb[::-1]], axis=2)
        buckets, flat, starts = inputs
        dproj = _sums(idx.T.ravel(), dx.reshape(-1, 6 * h), len(buckets))
        emb = self.embed(inputs)
        g["in"], g["bias"] = emb.T @ dproj, dproj.sum(axis=0)
        demb = dproj @ p["in"].T
        sizes = np.diff(np.append(starts, len(flat)))
        g["word"] = _sums(buckets, demb[:, :EMBED], WORD_BUCKETS)
        g["gram"] = _sums(flat, np.repeat(demb[:, EMBED:] / sizes[:, None], sizes, axis=0), GRAM_BUCKETS)
        return g

    def adam(self, grads: dict, rate: float) -> None:
        self.t += 1
        norm = math.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        clip = min(1.0, 5.0 / (norm + 1e-9))
        for k, g in grads.items():
            g = g * clip
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            self.p[k] *= 1 - rate * DECAY
            own = rate * (SLOW if k in ("word", "gram") else 1)
            self.p[k] -= (own * (self.m[k] / (1 - 0.9 ** self.t))
                          / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)).astype(np.float32)


def _sums(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows summed by index."""
    out = np.empty((n, rows.shape[1]), np.float32)
    for c in range(rows.shape[1]):
        out[:, c] = np.bincount(index, weights=rows[:, c], minlength=n)
    return out


# --- training ---------------------------------------------------------------------------

def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of the sampled texts, as lists of words."""
    for batch in batches:
        for i in range(batch.num_rows):
            words = words_of(batch.column("text")[i].as_py())
            windows = [b" ".join(words[s:s + WINDOW]) for s in window_starts(len(words))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([windows], pa.list_(pa.binary())), batch.column("y").slice(i, 1), batch.column("h").slice(i, 1),
                 pa.array([len(windows)], pa.int64())], names=["windows", "y", "h", "n"])


def _index(windows: list[bytes], vocabulary: dict) -> tuple[np.ndarray, np.ndarray]:
    idx, mask = np.zeros((len(windows), WINDOW), dtype=np.int32), np.zeros((len(windows), WINDOW), dtype=bool)
    for i, window in enumerate(windows):
        w = window.split()
        idx[i, :len(w)] = [vocabulary.setdefault(x, len(vocabulary)) for x in w]
        mask[i, :len(w)] = True
    return idx, mask


def _surprise(texts, y: np.ndarray, n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``n`` buckets: how many standard deviations more toxic texts hold it than if
    it were spread evenly (within 6, below 2.5 is chance: 0), and whether ``least`` texts hold
    it. ``texts`` yields the distinct buckets of one text after the other."""
    all_, toxic = np.zeros(n), np.zeros(n)
    for label, cell in zip(y, texts):
        all_[cell] += 1
        toxic[cell] += label
    expected = all_ * y.mean()
    z = np.clip((toxic - expected) / np.sqrt(expected + 1), -6, 6)
    return np.where(np.abs(z) < 2.5, 0, z).astype(np.float32), all_ >= least


def fit(texts: list[list[bytes]], y: np.ndarray, seed: int = 0, batch: int = 192, rate: float = 0.006) -> BiGRU:
    """Train on windows grouped by text."""
    updates = int(np.clip(15 * len(y) / batch, 120, 300))
    rng, net, vocabulary = np.random.default_rng(seed), BiGRU(seed), {b"": 0}
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    idx, mask = _index([w for t in texts for w in t], vocabulary)
    words = list(vocabulary)
    parts = [word_inputs(words[i:i + 20_000]) for i in range(0, len(words), 20_000)]
    buckets, flat = (np.concatenate([p[i] for p in parts]).astype(np.int32) for i in (0, 1))
    sizes = np.concatenate([np.diff(np.append(p[2], len(p[1]))) for p in parts])
    starts = np.cumsum(sizes) - sizes
    del words, parts, vocabulary

    def of_rows(cells: np.ndarray):
        """Inputs of the distinct words of some windows, and the windows in their terms."""
        used, local = np.unique(cells, return_inverse=True)
        n = sizes[used]
        at = np.repeat(starts[used] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return (buckets[used], flat[at], np.cumsum(n) - n), local.reshape(cells.shape)

    # embeddings only for what several texts share
    least = max(3, len(y) // 200)
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts) - counts
    cells = lambda: (np.unique(idx[a:a + n][mask[a:a + n]]) for a, n in zip(first, counts))
    grams = (np.unique(np.concatenate([flat[starts[v]:starts[v] + sizes[v]] for v in c] or [flat[:0]])) for c in cells())
    usual = {}
    for k, per_text, n in (("word", (np.unique(buckets[c]) for c in cells()), WORD_BUCKETS),
                           ("gram", grams, GRAM_BUCKETS)):
        z, usual[k] = _surprise(per_text, y, n, least)
        net.p[k][:, 0] = 0.4 * z
        net.p[k] *= usual[k][:, None]
    done, rounds = 0, 0
    while done < updates:
        if rounds < 2:  # any window, until the network knows something
            logits = rng.random(len(owner))
        else:
            logits = np.empty(len(owner), np.float32)
            for i in range(0, len(idx), CHUNK):
                inputs, local = of_rows(idx[i:i + CHUNK])
                logits[i:i + CHUNK] = net.forward(net.project(inputs), local, mask[i:i + CHUNK])
        order = np.lexsort((-logits, owner))
        # each text's worst window, and for clean texts any other one as well
        any_ = first + (rng.random(len(y)) * counts).astype(int)
        rows_, y_ = np.r_[order[first], any_[y == 0]], np.r_[y, y[y == 0]]
        for _ in range(max(1, min(4, 40 * batch // len(y)))):
            for part in np.array_split(rng.permutation(len(y_)), max(1, len(y_) // batch)):
                rows = rows_[part]
                (inputs, local), kept = of_rows(idx[rows]), {}
                real = mask[rows] & (rng.random((len(rows), WINDOW)) > DROP)
                z = net.forward(net.project(inputs), local, real, kept)
                slope = ((sigmoid(z) - y_[part]) / len(part)).astype(np.float32)
                grads = net.gradients(inputs, local, real, slope, kept)
                for k, use in usual.items():
                    grads[k] *= use[:, None]
                net.adam(grads, rate * min(1.0, 1.5 * (1 - done / updates) + 0.05))
                done += 1
        rounds += 1
    return net


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN,
          max_windows: int = MAX_WINDOWS):
    """A network, or a constant share where the labels don't hold both classes."""
    known = labelled(docs, labels, "toxic")
    picks = [smallest_hashes(known.where(F.col("y") == c), n, 3, F.lit(c))
             for c, n in ((0, max_clean), (1, max_toxic))]
    rows = sample_rows(docs, picks, [max_clean, max_toxic]).mapInArrow(
        _training_windows, "windows array<binary>, y int, h long, n long")
    # whole texts while their windows fit; the window holds the sampled texts of one label
    upto = Window.partitionBy("y").orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum("n").over(upto)).where(F.col("upto") <= max_windows).select("windows", "y").toArrow()
    pairs = sorted(zip(rows.column("windows").to_pylist(), rows.column("y").to_pylist()))
    y = np.array([p[1] for p in pairs], dtype=np.int64)
    if not (y == 1).any() or not (y == 0).any():
        return float(y.mean()) if len(y) else 0.5
    return fit([p[0] for p in pairs], y)


# --- scoring ----------------------------------------------------------------------------

class Scorer:
    """Scores whole texts with a bounded cache of word projections."""

    def __init__(self, net: BiGRU):
        self.net = net
        self._reset()

    def _reset(self) -> None:
        self.known = {}
        self.table = np.zeros((1024, 6 * STATES), np.float32)

    def _ids(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if len(known) + len(new) > CACHE_WORDS and known:
            self._reset()
            known, new = self.known, list(dict.fromkeys(words))
        if new:
            n = len(known)
            if n + len(new) > len(self.table):
                grown = np.zeros((3 * (n + len(new)) // 2, 6 * STATES), np.float32)
                grown[:n] = self.table[:n]
                self.table = grown
            for i in range(0, len(new), 20_000):
                part = new[i:i + 20_000]
                self.table[n + i:n + i + len(part)] = self.net.project(word_inputs(part))
            known.update(zip(new, range(n, n + len(new))))
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Worst-window probability of each text."""
        worst = np.full(len(texts), -np.inf, dtype=np.float32)
        todo, held = [], 0
        for n, text in enumerate(texts):
            words = words_of(text) or [b""]
            todo.append((n, words))
            held += len(words)
            if held >= CHUNK * STRIDE:
                self._windows(todo, worst)
                todo, held = [], 0
        if todo:
            self._windows(todo, worst)
        return sigmoid(worst.astype(np.float64))

    def _windows(self, texts: list[tuple[int, list[bytes]]], worst: np.ndarray) -> None:
        ids = self._ids([w for _, words in texts for w in words])
        starts, owner, left, at = [], [], [], 0
        for n, words in texts:
            s = window_starts(len(words))
            starts.append(at + s)
            owner.append(np.full(len(s), n))
            left.append(np.full(len(s), min(WINDOW, len(words)) if words != [b""] else 0))
            at += len(words)
        starts, owner, left = map(np.concatenate, (starts, owner, left))
        steps = np.arange(WINDOW)
        for i in range(0, len(starts), CHUNK):
            mask = steps[None, :] < left[i:i + CHUNK, None]
            idx = ids[np.minimum(starts[i:i + CHUNK, None] + steps, len(ids) - 1)]
            np.maximum.at(worst, owner[i:i + CHUNK], self.net.forward(self.table, idx, mask))


def _scorer(net):
    """``net``: a network, or the constant that every text gets."""
    def start():
        if not isinstance(net, BiGRU):
            return lambda texts: np.full(len(texts), net)
        model = Scorer(net)
        return lambda texts: model.scores(texts.to_pylist())
    return start


def score(docs: DataFrame, labels: DataFrame, out: str = "toxicity", **options) -> DataFrame:
    """``docs`` with the score added as column ``out``."""
    net = train(docs, labels, **options)
    if isinstance(net, BiGRU):
        net.m = net.v = None  # not needed to score
    return with_score(docs, _scorer(net), out)


def op1_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = score(docs, table(spark, sf_dir, "labels"))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
                    (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
