"""Features and training of the quality classifier against a plain version, gram by gram and step by step."""

import math
import random

import numpy as np

from colloquy.llm import quality
from colloquy.llm.quality import QualityModel

M64 = (1 << 64) - 1
R = 0x9E3779B97F4A7C15


def _mix(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & M64
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & M64
    return h ^ (h >> 31)


def _plain(text, m):
    """Buckets by loops over words and their n-grams; a word's ends are spaces."""
    out = {}
    for w in text.replace("\t", " ").replace("\n", " ").split(" "):
        if not w:
            continue
        grams = []
        c = [32, *map(ord, w), 32]
        for n in range(m.min_n, m.max_n + 1):
            for i in range(len(c) - n + 1):
                h = 0
                for x in c[i : i + n]:
                    h = (h * R + x) & M64
                grams.append((h + n) & M64)
        whole = 0
        for i, x in enumerate(c[1:-1], 1):
            whole = (whole + x * pow(R, i, 1 << 64)) & M64
        grams.append(whole)
        for h in grams:
            b = _mix(h) >> (64 - m.buckets_log2)
            out[b] = out.get(b, 0) + 1
    return out


def test_features_equal_a_plain_version(monkeypatch):
    monkeypatch.setattr(quality, "_PIECE", 40)
    rng = random.Random(6)
    m = QualityModel(buckets_log2=12)
    for text in ["", " \n ", "a", "the cat", "é€ x\ty", " ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(60))]:
        ids, n = quality.features(text, m)
        assert dict(zip(ids.tolist(), n.tolist(), strict=True)) == _plain(text, m)
        weights = np.random.default_rng(1).normal(size=1 << 12).astype(np.float32)
        plain = _plain(text, m)
        want = 0.25 + sum(float(weights[b]) * c for b, c in plain.items()) / max(1, sum(plain.values()))
        assert math.isclose(quality.log_odds(text, weights, 0.25, m), want, abs_tol=1e-6)


def test_training_equals_plain_gradient_steps():
    m = QualityModel(buckets_log2=6, dim=3, epochs=2)
    texts = ["good text here", "bad", "more good text", "bad bad words", ""]
    good = [1, 0, 1, 0, 1]
    rows = [quality.features(t, m) for t in texts]
    weights, bias = quality.train(rows, good, m)

    rng = np.random.default_rng(m.seed)
    vec = rng.uniform(-1 / m.dim, 1 / m.dim, (1 << m.buckets_log2, m.dim)).tolist()
    out, b = [[0.0, 0.0] for _ in range(m.dim)], [0.0, 0.0]
    step = 0
    for _ in range(m.epochs):
        for i in rng.permutation(len(rows)):
            ids, n = rows[i]
            share = [c / max(1, n.sum()) for c in n]
            rate = m.rate * (1 - step / (m.epochs * len(rows)))
            step += 1
            mean = [sum(s * vec[j][d] for j, s in zip(ids, share, strict=True)) for d in range(m.dim)]
            z = [sum(mean[d] * out[d][c] for d in range(m.dim)) + b[c] for c in (0, 1)]
            e = [math.exp(x - max(z)) for x in z]
            p = [x / sum(e) - (c == good[i]) for c, x in enumerate(e)]
            for j, s in zip(ids, share, strict=True):
                for d in range(m.dim):
                    vec[j][d] -= rate * s * (out[d][0] * p[0] + out[d][1] * p[1]) * len(ids) ** 0.5
            for d in range(m.dim):
                for c in (0, 1):
                    out[d][c] -= rate * mean[d] * p[c]
            b = [b[c] - rate * 0.1 * p[c] for c in (0, 1)]
    want = [sum(vec[j][d] * (out[d][1] - out[d][0]) for d in range(m.dim)) for j in range(1 << m.buckets_log2)]
    assert np.allclose(weights, want, atol=1e-6) and math.isclose(bias, b[1] - b[0], abs_tol=1e-9)
