"""The factorization machine: its sum against the plain double sum, and pairs that no linear model tells."""

import random
import zlib

import numpy as np
import pytest

from corpusmill.llm import toxicity

from .fixtures import documents


def test_margins_equal_the_double_sum():
    r = np.random.default_rng(1)
    w0, w, v = np.array([0.3]), r.standard_normal(toxicity.DIM), r.standard_normal((toxicity.DIM, toxicity.FACTORS))
    rows = [np.unique(r.integers(0, toxicity.DIM, n)).astype(np.int32) for n in (0, 1, 2, 9, 0, 40)]
    for x, got in zip(rows, toxicity.margins((w0, w, v), rows)):
        pairs = sum(float(v[i] @ v[j]) for k, i in enumerate(x) for j in x[k + 1 :])
        assert got == pytest.approx(0.3 + w[x].sum() + pairs / max(1, len(x)) ** 0.5)


def test_pairs_decide(spark):
    """An insult is toxic with one group's name and harmless with the other's: each word alone says nothing."""
    r = random.Random(3)
    plain, insults, groups = [f"word{k}" for k in range(200)], ["xinsult", "yinsult"], ["xfolk", "yfolk"]
    rows, labels = [], []
    for i in range(1500):
        a, b = r.randrange(2), r.randrange(2)
        words = [r.choice(plain) for _ in range(12)] + [insults[a], groups[b]]
        r.shuffle(words)
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(a == b)))
    model = toxicity.fit_toxicity(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).first()
    w0, w, v = (np.frombuffer(x, np.float32) for x in (model.w0, model.w, model.v))
    v = v.reshape(toxicity.DIM, toxicity.FACTORS)
    fold = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    terms, y = [toxicity.terms(rows[i][1]) for i in fold], np.array([labels[i][1] for i in fold])
    right = lambda m: ((toxicity.scores(m, terms) >= 0.5) == y).mean()
    assert right((w0, w, v)) > 0.9
    assert right((w0, w, v * 0)) < 0.75


def test_sample_stays_bounded_when_ids_repeat(spark):
    rows = [(i % 50, f"text {i} of many words", "en", "s") for i in range(400)]
    y = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    assert toxicity.fit_toxicity(documents(spark, rows), y, max_rows=60).count() == 1
    got = toxicity.score_toxicity(documents(spark, rows), toxicity.fit_toxicity(documents(spark, rows), y, max_rows=60))
    assert got.count() == 400
