"""Quality classifier by positive-unlabelled learning.

Trusted positives (documents labelled 1) and unlabelled web text are all it learns from;
labels 0 are never used. First the class prior - the share of good documents in the web text -
is estimated: a classifier tells positives from unlabelled text, and on rows it has not seen
the best bin of top scores bounds the prior from above (best-bin estimation). Then a small
network minimises the non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),

stepping back along the second term whenever a batch makes it negative.

Features of a whole text are the rates of pairs of adjacent character classes and a few
statistics of its words and lines: no vocabulary, no labels, no other columns. They are
computed by numpy inside tasks, one text at a time. The fit uses at most ``MAX_POSITIVES`` and
``MAX_UNLABELLED`` rows, taken by a hash order of their ids; scoring covers every row.

Cases: a null text is scored as the empty one; without any trusted positive every score is
0.5; a null doc_id is held out; rows that repeat are scored alike; other columns pass through
``keep_good`` untouched.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, held_out, table, with_score
from ledgerline.llm.sampling import labelled, sample_rows, smallest_hashes

MAX_POSITIVES = 3000
MAX_UNLABELLED = 6000
THRESHOLD = 0.3
HIDDEN = 24
SLICE = 256  # rows whose features are in memory at once
COLUMNS = 64  # features whose mean and spread are taken at once

# Character classes: each string is one class of ASCII characters; bytes of multi-byte
# characters are a class of their own, as are all characters not named here.
CLASSES = ("aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "0123456789", " ", "\n", "\t\r",
           ".", ",", ";:", "!", "?", "\"'", "()[]{}<>", "|", "%", "$", "&", "#", "*", "@", "/\\", "-_", "+=~^`")
N_CLASSES = len(CLASSES) + 2


def _class_table() -> np.ndarray:
    t = np.full(256, len(CLASSES), dtype=np.uint8)
    for i, chars in enumerate(CLASSES):
        t[np.frombuffer(chars.encode(), dtype=np.uint8)] = i
    t[128:] = len(CLASSES) + 1
    return t


CLASS_OF = _class_table()


def features(text: str | None) -> np.ndarray:
    data = (text or "").encode("utf-8", "replace")
    c = CLASS_OF[np.frombuffer(data, dtype=np.uint8)].astype(np.int32)
    pairs = np.bincount(c[:-1] * N_CLASSES + c[1:], minlength=N_CLASSES * N_CLASSES)
    rates = np.sqrt(pairs / max(1, len(c) - 1))
    words, lines = data.split(), data.split(b"\n")
    n = max(1, len(words))
    again = sum(map(bytes.__eq__, words, words[1:])) / n  # a word right after itself
    most = max(Counter(words).values(), default=0) / n
    more = [math.log1p(len(data)), len(data) / n, len(set(words)) / n, len(set(lines)) / len(lines),
            sum(map(bytes.isupper, words)) / n, len(words) / len(lines) / 100, again, most]
    return np.r_[rates, more].astype(np.float32)


N_STATISTICS = 8
N_FEATURES = N_CLASSES * N_CLASSES + N_STATISTICS


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [features(t.as_py()).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), batch.column("y")], names=["x", "y"])


class Network:
    """Standardised features, one hidden layer of tanh units, logistic output."""

    def __init__(self, *samples: np.ndarray, seed: int, hidden: int = HIDDEN):
        rng, width = np.random.default_rng(seed), samples[0].shape[1]
        # some columns at a time: the samples together are the most that the driver holds
        means, scales = [], []
        for i in range(0, width, COLUMNS):
            block = np.concatenate([x[:, i:i + COLUMNS] for x in samples])
            means.append(block.mean(axis=0))
            scales.append(1 / (block.std(axis=0) + 0.01))
        self.mean, self.scale = np.concatenate(means), np.concatenate(scales)
        self.p = [w.astype(np.float32) for w in (
            rng.normal(0, 1 / math.sqrt(width), (width, hidden)), np.zeros(hidden),
            rng.normal(0, 1 / math.sqrt(hidden), hidden), np.zeros(1))]
        self.m, self.v, self.t = [np.zeros_like(w) for w in self.p], [np.zeros_like(w) for w in self.p], 0

    def prepare(self, x: np.ndarray) -> np.ndarray:
        z = x - self.mean
        z *= self.scale
        np.clip(z, -8, 8, out=z)
        z[:, -N_STATISTICS:] *= 3  # few against hundreds of pair rates
        return z

    def logit(self, z: np.ndarray) -> np.ndarray:
        """Logits of prepared rows."""
        w, b, u, c = self.p
        return np.tanh(z @ w + b) @ u + c[0]

    def step(self, z: np.ndarray, slope: np.ndarray, rate: float = 0.003, decay: float = 1e-4) -> None:
        """One Adam step against d(loss)/d(logit) = ``slope`` at the prepared rows ``z``."""
        w, b, u, c = self.p
        slope = slope.astype(np.float32)
        h = np.tanh(z @ w + b)
        back = slope[:, None] * u * (1 - h * h)
        grads = [z.T @ back + decay * w, back.sum(axis=0), h.T @ slope + decay * u, np.array([slope.sum()])]
        self.t += 1
        self.p = list(self.p)
        for i, g in enumerate(grads):
            self.m[i] = 0.9 * self.m[i] + 0.1 * g
            self.v[i] = 0.999 * self.v[i] + 0.001 * g * g
            self.p[i] = self.p[i] - rate * (self.m[i] / (1 - 0.9 ** self.t)) / (
                np.sqrt(self.v[i] / (1 - 0.999 ** self.t)) + 1e-8)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _batches(rng, n_p: int, n_u: int, steps: int, size: int):
    for _ in range(steps):
        yield rng.integers(0, n_p, min(size, n_p)), rng.integers(0, n_u, min(size, n_u))


def estimate_prior(pos: np.ndarray, unl: np.ndarray, seed: int = 0, steps: int = 400) -> float:
    """Share of positives among the unlabelled rows, by the best bin of top scores."""
    rng = np.random.default_rng(seed)
    at_p, at_u = rng.permutation(len(pos)), rng.permutation(len(unl))   # rows are copied only where they are used
    hp, hu = max(1, len(pos) // 2), max(1, len(unl) // 2)
    scores = []
    for a, b in ((slice(None, hp), slice(None, hu)), (slice(hp, None), slice(hu, None))):
        fit_p, fit_u = pos[at_p[a]], unl[at_u[b]]
        if not len(fit_p) or not len(fit_u):
            return 0.5
        net = Network(fit_p, fit_u, seed=seed)
        fit_p, fit_u = net.prepare(fit_p), net.prepare(fit_u)
        for i, j in _batches(rng, len(fit_p), len(fit_u), steps, 256):
            sp, su = sigmoid(net.logit(fit_p[i])), sigmoid(net.logit(fit_u[j]))
            net.step(np.r_[fit_p[i], fit_u[j]], np.r_[(sp - 1) / len(i), su / len(j)])
        del fit_p, fit_u
        rest_p, rest_u = (at_p[hp:], at_u[hu:]) if a.start is None else (at_p[:hp], at_u[:hu])
        scores.append((np.sort(net.logit(net.prepare(pos[rest_p]))), np.sort(net.logit(net.prepare(unl[rest_u])))))
    found = []
    for sp, su in scores:
        # a bin: all scores of at least c; it must be wide enough for the bound to mean something
        cuts = np.quantile(sp, np.linspace(0, 0.95, 96))
        q_p = 1 - np.searchsorted(sp, cuts) / len(sp)
        q_u = 1 - np.searchsorted(su, cuts) / len(su)
        noise = math.sqrt(math.log(40) / 2 / len(sp)) + math.sqrt(math.log(40) / 2 / len(su))
        best = np.argmin((q_u + noise) / q_p)
        found.append(q_u[best] / q_p[best])
    # the best bin bounds the prior from above: go two standard errors below it
    at = float(np.clip(np.mean(found), 0.05, 0.98))
    return max(0.05, at - 2 * math.sqrt(at * (1 - at) / max(1, min(hu, len(unl) - hu))))


def risk(net: Network, pos: np.ndarray, unl: np.ndarray, prior: float) -> float:
    """The non-negative unbiased risk of prepared rows."""
    zp, zu = net.logit(pos), net.logit(unl)
    negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    return float(prior * np.logaddexp(0, -zp).mean() + max(0.0, negative))


def fit(pos: np.ndarray, unl: np.ndarray, seed: int = 1, steps: int = 1500, size: int = 256) -> Network | None:
    """Minimise the non-negative risk with the logistic loss on four fifths of the rows; the
    parameters with the least risk on the last fifth are kept."""
    if not len(pos) or not len(unl):
        return None
    prior = estimate_prior(pos, unl)
    rng, net = np.random.default_rng(seed), Network(pos, unl, seed=seed)
    pos = net.prepare(pos[rng.permutation(len(pos))])
    unl = net.prepare(unl[rng.permutation(len(unl))])
    n_p, n_u = max(1, len(pos) // 5), max(1, len(unl) // 5)
    held = (pos[:n_p], unl[:n_u])
    pos, unl = (pos[n_p:], unl[n_u:]) if len(pos) > 1 and len(unl) > 1 else (pos, unl)
    best, kept = math.inf, net.p
    for t, (i, j) in enumerate(_batches(rng, len(pos), len(unl), steps, size), start=1):
        p, u = pos[i], unl[j]
        zp, zu = net.logit(p), net.logit(u)
        sp, su = sigmoid(zp), sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if negative >= 0:
            slope = np.r_[prior * (sp - 1 - sp) / len(i), su / len(j)]
        else:  # undo what made the negative part less than zero
            slope = np.r_[prior * sp / len(i), -su / len(j)]
        net.step(np.r_[p, u], slope)
        if t % 25 == 0 or t == steps:
            now = risk(net, *held, prior)
            if now < best:
                best, kept = now, net.p
    net.p = list(kept)
    return net


def train(docs: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES,
          max_unlabelled: int = MAX_UNLABELLED) -> Network | None:
    good = labelled(docs, labels, "quality").where("y = 1")
    web = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    picks = [smallest_hashes(good, max_positives, 1, F.lit(1)), smallest_hashes(web, max_unlabelled, 2, F.lit(0))]
    rows = sample_rows(docs, picks, [max_positives, max_unlabelled]).select("text", "y").mapInArrow(_feature_rows, "x binary, y int").toArrow()
    x, y = np.empty((len(rows), N_FEATURES), np.float32), rows.column("y").to_numpy()
    done = 0
    for chunk in rows.column("x").chunks:
        for v in chunk:
            x[done] = np.frombuffer(v.as_py(), dtype=np.float32)
            done += 1
    rows = chunk = v = None
    pa.default_memory_pool().release_unused()
    return fit(*_by_label(x, y))


def _by_label(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positives, unlabelled rows): the order rows arrive in must not matter."""
    order = np.lexsort((x[:, -8], x[:, -7], y)) if len(y) else np.empty(0, int)
    return x[order[y[order] == 1]], x[order[y[order] == 0]]


def _scorer(net: Network | None):
    def scores(texts: pa.Array) -> np.ndarray:
        s = np.full(len(texts), 0.5)
        for i in range(0, len(texts) if net else 0, SLICE):
            x = np.stack([features(t.as_py()) for t in texts[i:i + SLICE]])
            s[i:i + SLICE] = sigmoid(net.logit(net.prepare(x)))
        return s
    return lambda: scores


def score(docs: DataFrame, labels: DataFrame, out: str = "quality_score", **options) -> DataFrame:
    """``docs`` with the score added as column ``out``."""
    return with_score(docs, _scorer(train(docs, labels, **options)), out)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that the classifier does not reject."""
    out = fresh(docs, "quality_score")
    return score(docs, labels, out, **options).where(F.col(out) >= threshold).drop(out)


def op7_quality(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = score(docs, table(spark, sf_dir, "labels"))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
                    (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
