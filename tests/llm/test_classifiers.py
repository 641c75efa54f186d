from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from conftest import SF_ORACLE
from pyspark.sql import functions as F
from support import DOCS, odd_documents, with_clashes

from ledgerline.llm import quality, toxicity
from ledgerline.llm.common import held_out, table
from ledgerline.llm.registry import QUERIES

LABELS = "doc_id long, quality int, toxic int, y int"


def test_held_out_is_the_crc_remainder(spark):
    rows = spark.range(300).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


# --- network of the toxicity operator

def test_gradients():
    net = toxicity.BiGRU(1)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    inputs = toxicity.word_inputs([b"", b"abc", b"de", b"fgh", b"idiot"])
    rng = np.random.default_rng(0)
    idx = rng.integers(0, 5, (3, toxicity.WINDOW))
    mask = np.arange(toxicity.WINDOW)[None] < np.array([64, 10, 30])[:, None]
    y = np.array([1, 0, 1.0])

    def loss():
        z = net.forward(net.project(inputs), idx, mask)
        return (np.logaddexp(0, z) - y * z).sum()
    kept = {}
    z = net.forward(net.project(inputs), idx, mask, kept)
    grads = net.gradients(inputs, idx, mask, toxicity.sigmoid(z) - y, kept)
    for k, g in grads.items():
        flat, i = net.p[k].reshape(-1), int(np.abs(g).argmax())
        old = flat[i]
        flat[i] = old + 1e-2
        up = loss()
        flat[i] = old - 1e-2
        down = loss()
        flat[i] = old
        assert abs((up - down) / 2e-2 - g.reshape(-1)[i]) < 1e-3, k


def test_windows_cover_every_word():
    for n in (0, 1, 63, 64, 65, 96, 97, 500, 1000):
        starts = toxicity.window_starts(n)
        seen = {p for s in starts for p in range(s, min(s + toxicity.WINDOW, n))}
        assert seen == set(range(n)) and (np.diff(starts) <= toxicity.STRIDE).all()


def test_batched_scores_equal_single_scores():
    rng = random.Random(2)
    net = toxicity.BiGRU(3)
    texts = [None, "", "one"] + [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(400))) for _ in range(30)]
    together = toxicity.Scorer(net).scores(texts)
    for t, s in zip(texts, together):
        words = toxicity.words_of(t) or [b""]
        proj = net.project(toxicity.word_inputs(words))
        best = -np.inf
        for a in toxicity.window_starts(len(words)):
            idx = np.arange(a, min(a + toxicity.WINDOW, len(words)))
            pad = np.zeros(toxicity.WINDOW, dtype=int)
            pad[:len(idx)] = idx
            real = np.arange(toxicity.WINDOW) < (len(idx) if words != [b""] else 0)
            best = max(best, net.forward(proj, pad[None], real[None])[0])
        assert abs(toxicity.sigmoid(best) - s) < 1e-4


def test_cache_limit_does_not_change_scores(monkeypatch):
    net = toxicity.BiGRU(3)
    texts = [" ".join(f"t{i}w{j}" for j in range(120)) for i in range(300)]
    want = toxicity.Scorer(net).scores(texts)
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 5000)
    assert np.allclose(toxicity.Scorer(net).scores(texts), want, atol=1e-5)


# --- positive-unlabelled learning

def test_prior_and_risk_on_made_data():
    """Two kinds of texts that differ in some of the rates and statistics, the rest is noise."""
    rng = np.random.default_rng(4)
    signal = np.r_[np.arange(40), quality.N_FEATURES - 1 - np.arange(3)]

    def rows(n, sign):
        x = rng.normal(0, 1, (n, quality.N_FEATURES))
        x[:, signal] += sign
        return x.astype(np.float32)
    for prior in (0.3, 0.6):
        n = int(3000 * prior)
        pos, unl = rows(1500, 1), np.r_[rows(n, 1), rows(3000 - n, -1)]
        assert abs(quality.estimate_prior(pos, unl) - prior) < 0.06
        net = quality.fit(pos, unl)
        score = lambda x: quality.sigmoid(net.logit(net.prepare(x)))
        assert (score(rows(500, 1)) >= 0.3).mean() > 0.95 and (score(rows(500, -1)) < 0.3).mean() > 0.9


def test_statistics_of_texts():
    x = quality.features("the the the the\nTHE END")
    assert x[-2] == pytest.approx(3 / 6) and x[-1] == pytest.approx(4 / 6) and len(x) == quality.N_FEATURES
    assert np.isfinite(quality.features(None)).all() and np.isfinite(quality.features("")).all()


# --- both on the test tables

@pytest.mark.parametrize("name,label,least", [("op7_quality", "quality", 0.93), ("op1_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, label, least):
    got = QUERIES[name](spark, SF_ORACLE)
    docs = table(spark, SF_ORACLE, "documents")
    assert got.count() == docs.count()
    j = got.join(table(spark, SF_ORACLE, "labels"), "doc_id").toPandas()
    test = j[j.held_out]
    assert (test.predicted == test[label]).mean() >= least
    assert j.score.between(0, 1).all()
    threshold = 0.3 if name.startswith("op7") else 0.5
    assert ((j.score >= threshold).astype(int) == j.predicted).all()


@pytest.mark.parametrize("module,out", [(quality, "quality_score"), (toxicity, "toxicity")])
def test_odd_rows(spark, module, out):
    rng = random.Random(1)
    df = with_clashes(spark.createDataFrame(odd_documents(), DOCS)).drop(out)
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None]), 7) for r in odd_documents()]
    labels += [(None, 1, 1, 7), (100, 0, 1, 7), (100, 1, 0, 7), (99999, 1, 1, 7)]
    lab = spark.createDataFrame(labels, LABELS)
    got = module.score(df, lab)
    assert got.columns == [*df.columns, out] and got.count() == df.count()
    assert all(0 <= r[out] <= 1 for r in got.select(out).collect())
    assert module.score(df.where("false"), lab).count() == 0
    plain = module.score(df, lab.where("false")).select(out).distinct().collect()
    assert [r[out] for r in plain] == [0.5]
    if module is quality:
        kept = quality.keep_good(with_clashes(df.select("doc_id", "text", "lang", "source", "n_chars")), lab)
        assert "quality_score" in kept.columns and len(set(kept.columns)) == len(kept.columns)


# --- samples

def test_a_hot_id_does_not_fill_the_sample(spark):
    from ledgerline.llm.sampling import sample_rows

    docs = spark.createDataFrame([(1, "same")] * 200 + [(1, f"other {i}") for i in range(300)] + [(i, f"text {i}") for i in range(2, 12)],
                                 "doc_id long, text string")
    picks = [spark.createDataFrame([(i, i % 2) for i in range(1, 12) if i % 2 == y], "doc_id long, y int") for y in (0, 1)]
    got = sample_rows(docs, picks, [5, 40]).collect()
    assert sorted(r["y"] for r in got) == [0] * 5 + [1] * 40
    assert len({r["text"] for r in got}) == 45 and len({r["h"] for r in got}) == 45
    assert sorted(map(tuple, got)) == sorted(map(tuple, sample_rows(docs.repartition(7), picks, [5, 40]).collect()))


def test_training_reads_whole_texts(spark, monkeypatch):
    """All windows of a sampled text; whole texts only, while their windows fit."""
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, y: seen.append((texts, y)) or 0.5)
    sizes = {i: 10 + 40 * i for i in range(1, 60)}
    docs = spark.createDataFrame([(i, " ".join(f"t{i}w{j}" for j in range(n))) for i, n in sizes.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in sizes], "doc_id long, quality int, toxic int")
    toxicity.train(docs, labels)
    texts, y = seen[0]
    whole = [sum(len(toxicity.window_starts(sizes[i])) for i in sizes if zlib.crc32(str(i).encode()) % 5 and i % 2 == c) for c in (0, 1)]
    assert [sum(len(t) for t, l in zip(texts, y) if l == c) for c in (0, 1)] == whole
    toxicity.train(docs, labels, max_windows=100)
    texts, y = seen[1]
    for c in (0, 1):
        own = [t for t, l in zip(texts, y) if l == c]
        assert 0 < sum(map(len, own)) <= 100
        for t in own:   # every window of the text is there
            i = int(t[0].split()[0][1:].split(b"w")[0])
            assert len(t) == len(toxicity.window_starts(sizes[i]))


def test_quality_network_takes_its_samples_apart():
    import tracemalloc

    rng = np.random.default_rng(4)
    pos, unl = (rng.normal(0, 1, (n, quality.N_FEATURES)).astype(np.float32) for n in (2000, 4000))
    both = np.concatenate([pos, unl])
    tracemalloc.start()
    net = quality.Network(pos, unl, seed=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(net.mean, both.mean(axis=0)) and np.array_equal(net.scale, 1 / (both.std(axis=0) + 0.01))
    assert peak < both.nbytes / 2   # the samples are not copied whole
