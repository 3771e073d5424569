"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words and character n-grams (within words,
with the word's ends as characters), followed by a softmax layer; both are trained by stochastic gradient
descent. Because the output layer is linear, scoring needs one number per hash bucket, so a task holds the
folded model only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import mix


@dataclass(frozen=True)
class QualityModel:
    """Parameters. ``sample`` bounds the labelled rows that training reads, whatever the size of the corpus."""

    buckets_log2: int = 16
    dim: int = 16
    min_n: int = 3
    max_n: int = 5
    epochs: int = 6
    rate: float = 0.5
    sample: int = 4096
    threshold: float = 0.7
    seed: int = 4


_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PIECE = 1 << 19  # characters worked on at a time, cut at white space


def _pieces(text: str):
    """The text in parts of bounded length, cut where white space allows."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        while end < len(text) and text[end] not in " \t\n\v\f\r":
            end += 1
        yield text[at:end]
        at = end


def buckets(text: str, m: QualityModel) -> np.ndarray:
    """Hash buckets of all words and n-grams of one piece of text, with repeats."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (c == 32) | ((c >= 9) & (c <= 13))
    keep = ~(space & np.concatenate(([True], space[:-1])))
    c, space = c[keep], space[keep]
    if not len(c) or space.all():
        return np.empty(0, np.int64)
    if not space[-1]:
        c, space = np.append(c, np.uint32(32)), np.append(space, True)
    c = np.concatenate(([np.uint64(32)], np.where(space, 32, c))).astype(np.uint64)
    space = np.concatenate(([True], space))
    ends = np.flatnonzero(space)
    inner = np.cumsum(space)  # spaces up to and with a position
    out = []
    for n in range(m.min_n, m.max_n + 1):
        k = len(c) - n + 1
        if k <= 0:
            continue
        h = c[:k].copy()
        for j in range(1, n):
            h *= _R
            h += c[j : j + k]
        whole = inner[n - 2 : n - 2 + k] == inner[:k]  # no word end strictly inside
        out.append(h[whole] + np.uint64(n))
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(c) - 1, _R))))
    back = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(c) - 1, _R_INVERSE))))
    total = np.cumsum(c * power)
    out.append((total[ends[1:] - 1] - total[ends[:-1]]) * back[ends[:-1]])
    return (mix(np.concatenate(out)) >> np.uint64(64 - m.buckets_log2)).astype(np.int64)


def features(text: str | None, m: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a whole text and how often each comes."""
    n = np.zeros(1 << m.buckets_log2, np.int64)
    for piece in _pieces(text or ""):
        n += np.bincount(buckets(piece, m), minlength=len(n))
    ids = np.flatnonzero(n)
    return ids.astype(np.int32), n[ids]


def train(rows: list[tuple[np.ndarray, np.ndarray]], good: list[int], m: QualityModel) -> tuple[np.ndarray, float]:
    """Fit the model to documents' features; returns the log-odds per bucket and the intercept (the softmax of two classes, folded)."""
    rng = np.random.default_rng(m.seed)
    vectors = rng.uniform(-1 / m.dim, 1 / m.dim, (1 << m.buckets_log2, m.dim))
    out, bias = np.zeros((m.dim, 2)), np.zeros(2)
    steps, done = max(1, m.epochs * len(rows)), 0
    for _ in range(m.epochs):
        for i in rng.permutation(len(rows)):
            ids, n = rows[i]
            share, y = n / max(1, n.sum()), good[i]
            rate = m.rate * (1 - done / steps)
            done += 1
            v = vectors[ids]
            mean = share @ v
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            vectors[ids] = v - (rate * share)[:, None] * (out @ p)[None, :] * len(ids) ** 0.5
            out -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
    fold = out[:, 1] - out[:, 0]
    return (vectors @ fold).astype(np.float32), float(bias[1] - bias[0])


def log_odds(text: str | None, weights: np.ndarray, bias: float, m: QualityModel) -> float:
    total, n = 0.0, 0
    for piece in _pieces(text or ""):
        b = buckets(piece, m)
        total += float(weights[b].sum(dtype=np.float64))
        n += len(b)
    return bias + total / max(1, n)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, m: QualityModel) -> tuple[np.ndarray, float]:
    """Train on at most ``m.sample`` labelled rows, drawn by a hash of doc_id; held-out rows are never read."""
    rows = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    drawn = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(m.sample)
    # a table of m.sample rows of two numbers at most: safe to broadcast
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")
    kinds = "doc_id long, good int, ids binary, n binary"

    def read(batches):
        for pdf in batches:
            found = [features(t, m) for t in pdf.text]
            yield pd.DataFrame({"doc_id": pdf.doc_id, "good": pdf.good, "ids": [i.tobytes() for i, _ in found], "n": [n.astype(np.int32).tobytes() for _, n in found]})

    def learn(batches):
        rows = pd.concat([pdf for pdf in batches] or [pd.DataFrame(columns=["doc_id", "good", "ids", "n"])])
        pairs = [(np.frombuffer(i, np.int32), np.frombuffer(n, np.int32)) for i, n in zip(rows.ids, rows.n, strict=True)]
        weights, bias = train(pairs, rows.good.astype(int).tolist(), m)
        yield pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias]})

    # texts become features where they lie; of rows that repeat a doc_id one counts. One task trains, on m.sample rows at most.
    rows = got.select("doc_id", "good", "text").mapInPandas(read, kinds).groupBy("doc_id").agg(F.min(F.struct("good", "ids", "n")).alias("r"))
    one = rows.select("doc_id", "r.*").coalesce(1).sortWithinPartitions("doc_id").mapInPandas(learn, "weights binary, bias double").first()
    if one is None:
        return np.zeros(1 << m.buckets_log2, np.float32), 0.0
    return np.frombuffer(one.weights, np.float32), one.bias


def score(docs: DataFrame, labels: DataFrame, m: QualityModel = QualityModel()) -> DataFrame:
    """The columns of ``docs`` with score (0 to 1) and predicted (1 if score >= threshold).

    The score reads the text alone. An empty or null text has no features and scores the intercept;
    without any label every score is 0.5. Repeated rows score alike; an empty table gives an empty result; columns
    of ``docs`` named score or predicted are replaced.
    """
    weights, bias = fit(docs, labels, m)
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))  # one number per bucket: 256 KB

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        w, b = shared.value
        z = np.array([log_odds(t, w, b, m) for t in texts], np.float64)
        return pd.Series(1 / (1 + np.exp(-z)))

    out = docs.withColumn("score", probability(F.col("text").cast("string")))
    return out.withColumn("predicted", (F.col("score") >= m.threshold).cast("int"))
