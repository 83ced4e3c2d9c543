"""The quality classifier's parts against plain loops over words."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shelfline.llm import quality
from shelfline.llm.common import words_of

WORDS = ["alpha", "Beta", "beta", "x1", "42", "ünï", "!!", "end.", "日本", "a" * 50]


def texts(n=60):
    rng = random.Random(5)
    return [None, "", " \t", "one", *(" ".join(rng.choices(WORDS, k=rng.randrange(1, 40))) for _ in range(n))]


def buckets(text):
    return [int(w) % quality.BUCKETS for w in words_of((text or "").encode(), lower=False)[0]]


@pytest.mark.parametrize("flood", [1, quality.FLOOD])
def test_context_vectors_are_sums_over_neighbours(monkeypatch, flood):
    monkeypatch.setattr(quality, "FLOOD", flood)
    count, total = Counter(), defaultdict(lambda: np.zeros(quality.WIDTH))
    for text in texts():
        words = buckets(text)
        count.update(words)
        for i, word in enumerate(words):
            for j in range(max(0, i - quality.REACH), min(len(words), i + quality.REACH + 1)):
                if j != i:
                    total[word] += quality.DENSE[words[j]]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts()[a:a + 7], pa.string())}) for a in range(0, len(texts()), 7)]
    got = [r for b in quality._contexts(iter(batches)) for r in b.to_pylist()]
    assert {r["bucket"]: r["n"] for r in got} == count
    for r in got:
        assert [r[v] for v in quality._VECTOR] == total[r["bucket"]].tolist()


def test_features_are_means_over_words():
    vectors = np.random.default_rng(3).normal(size=(quality.BUCKETS, quality.WIDTH))
    width = quality.WIDTH
    for text in texts():
        words, got = buckets(text), quality.features(text, vectors)
        if not words:
            assert not got.any()
            continue
        n = len(words)
        shapes = quality._bucket(text)[1]
        assert np.allclose(got[:width], sum(vectors[w] for w in words) / n)
        assert np.allclose(got[width:2 * width], sum(quality.DENSE[s] for s in shapes) / n)
        rest = [np.linalg.norm(sum(quality.DENSE[w] for w in words) / n),
                *(sum(words[i] == words[i + k] for i in range(n - k)) / (n - k) if n > k else 0.0 for k in (1, 2, 3)),
                len(set(words)) / n, math.log(1 + n)]
        assert np.allclose(got[2 * width:], rest)


def test_scores_are_a_plain_forward_pass():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5))
    network = quality.Network(x, (x[:, 0] > 0).astype(float))
    w, b, v, c = network.parts
    for row, score in zip(x, network.score(x)):
        scaled = [min(6.0, max(-6.0, (row[k] - network.mean[k]) / network.dev[k])) for k in range(5)]
        hidden = [math.tanh(sum(scaled[k] * w[k, h] for k in range(5)) + b[h]) for h in range(quality.HIDDEN)]
        z = sum(hidden[h] * v[h] for h in range(quality.HIDDEN)) + c[0]
        assert math.isclose(score, 1 / (1 + math.exp(-z / network.temperature)), rel_tol=1e-9)


@pytest.mark.parametrize("labels, share", [([], 0.5), ([1.0, 1.0], 1.0), ([0.0], 0.0)])
def test_scores_without_both_classes_are_the_share(labels, share):
    network = quality.Network(np.zeros((len(labels), 5)), np.array(labels))
    assert network.score(np.ones((3, 5))).tolist() == [share] * 3
