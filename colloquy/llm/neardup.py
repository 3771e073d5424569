"""MinHash near-duplicate detection with SetSketch registers.

A document's set holds its distinct k-word shingles. Every register keeps the
smallest of the shingles' exponential hashes on an exponentially spaced scale,
truncated to two bytes: registers of a union are the maxima of registers
(mergeable) and agree with a probability close to the Jaccard similarity
(locality-sensitive). Bands of registers name candidate buckets, a joint
likelihood over the registers discards hopeless pairs, and every pair that
remains is verified on the full sets.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import mix, record_batches, rows_of, signed, stored, window_hashes, word_hashes
from colloquy.llm.components import link_buckets

_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


@dataclass(frozen=True)
class NearDup:
    """Parameters. There are as many bands as it takes that a pair at the threshold shares none with a probability of ``miss`` at most."""

    shingle_words: int = 5
    percent: int = 80  # link when 100 * |A and B| >= percent * |A or B|
    rows: int = 5
    miss: float = 1e-5
    base: float = 1.001
    rate: float = 20.0
    top: int = 65535
    seed: int = 17

    @property
    def bands(self) -> int:
        apart = 1 - (self.percent / 100) ** self.rows  # the chance that a band differs
        return max(1, math.ceil(math.log(self.miss) / math.log(apart))) if apart > 0 else 1

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of the whole text, A-Z lower-cased; fewer than k words make one shingle."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    return np.unique(window_hashes(h, min(k, len(h))) + np.uint64(min(k, len(h))))


def sketcher(p: NearDup):
    """A function from a non-empty set to its registers; long sets go in blocks, whose registers merge by maximum."""
    rng = np.random.default_rng(p.seed)
    a = (rng.integers(0, 2**31, (p.registers, 1)) * 2 + 1).astype(np.uint32)
    x = rng.integers(0, 2**32, (p.registers, 1)).astype(np.uint32)

    def sketch(s: np.ndarray) -> np.ndarray:
        s = (s >> np.uint64(32)).astype(np.uint32)
        high = np.zeros(p.registers, np.uint32)
        for i in range(0, len(s), 256):
            h = s[None, i : i + 256] ^ x
            h *= a
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            np.maximum(high, h.max(axis=1), out=high)
        least = -np.log1p(-(2.0**32 - 0.5 - high) / 2.0**32) / p.rate  # the smallest of |s| exponentials
        return np.clip(np.floor(1 - np.log(least) / np.log(p.base)), 0, p.top).astype(np.uint16)

    return sketch


def band_keys(registers: np.ndarray, p: NearDup) -> np.ndarray:
    """One key per band for every row of registers."""
    r = registers.reshape(-1, p.bands, p.rows).astype(np.uint64)
    h = np.tile(np.arange(1, p.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(r), 1))
    for j in range(p.rows):
        h = mix(h + r[:, :, j] + np.uint64(1))
    return h


def similarity_upper(plus: np.ndarray, minus: np.ndarray, same: np.ndarray, nu: np.ndarray, nv: np.ndarray, base: float) -> np.ndarray:
    """Largest similarity that the registers leave plausible (log-likelihood within 12 of the best).

    ``plus``/``minus``/``same`` count registers of U above, below and equal to those of V; with
    u, v the shares of the two set sizes and d the Jaccard similarity, a register is above with
    probability p(u - v d), below with p(v - u d), p(x) = -log_b(1 - x (b - 1) / b).
    """
    grid = np.linspace(0, 1, 101)
    u = (nu / (nu + nv))[:, None]
    v = 1 - u
    d = np.minimum(grid[None, :], np.minimum(u / v, v / u))
    prob = lambda z: np.clip(-np.log1p(-z * (base - 1) / base) / np.log(base), 1e-12, 1)
    above, below = prob(u - v * d), prob(v - u * d)
    like = plus[:, None] * np.log(above) + minus[:, None] * np.log(below) + same[:, None] * np.log(np.clip(1 - above - below, 1e-12, 1))
    ok = like >= like.max(axis=1, keepdims=True) - 12
    return np.where(ok, d, 0).max(axis=1)


def signatures(docs: DataFrame, p: NearDup) -> DataFrame:
    """(doc_id, n_shingles, set_hash, registers, bands) per row of ``docs``; an empty set has null hash and bands."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_hash", pa.binary()), ("registers", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        import xxhash

        sketch = sketcher(p)
        for whole in batches:
            for i in range(0, whole.num_rows, 2048):
                b = whole.slice(i, 2048)
                sets = [shingles(t.as_py(), p.shingle_words) for t in b.column(1)]
                regs = [sketch(s) if len(s) else None for s in sets]
                keys = iter(signed(band_keys(np.array([r for r in regs if r is not None]), p)) if any(r is not None for r in regs) else ())
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0),
                        pa.array(map(len, sets), pa.int64()),
                        pa.array((xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets), pa.binary()),
                        pa.array((r if r is None else r.tobytes() for r in regs), pa.binary()),
                        pa.array((r if r is None else next(keys) for r in regs), pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, set_hash binary, registers binary, bands array<long>"
    )


def _plausible(pairs: DataFrame, p: NearDup) -> DataFrame:
    """Pairs whose registers leave a similarity at the threshold plausible."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, -1) for c in ("ra", "rb"))
            na, nb = (b.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("na", "nb"))
            up = similarity_upper((ra > rb).sum(1), (ra < rb).sum(1), (ra == rb).sum(1), na, nb, p.base)
            keep = pa.array(up >= p.percent / 100 - 1e-9)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], schema=schema)

    return pairs.mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, p: NearDup) -> DataFrame:
    """Pairs that pass on the full shingle sets."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        last, sb = None, None

        def rows():
            nonlocal last, sb
            for batch in batches:
                for a, b, ta, tb in zip(*(batch.column(c) for c in ("a", "b", "ta", "tb")), strict=True):
                    a, b = a.as_py(), b.as_py()
                    if b != last:
                        last, sb = b, shingles(tb.as_py(), p.shingle_words)
                    sa = shingles(ta.as_py(), p.shingle_words)
                    both = len(np.intersect1d(sa, sb, assume_unique=True))
                    if 100 * both >= p.percent * (len(sa) + len(sb) - both):
                        yield a, b

        yield from record_batches(rows(), schema)

    return pairs.mapInArrow(run, "a long, b long")


def overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 1 << 15) -> np.ndarray:
    """Intersection sizes of all left sets with all right sets (sorted hash arrays)."""
    out = np.zeros((len(left), len(right)), np.float64)
    ids = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for lo in range(0, len(ids), columns):
        part = ids[lo : lo + columns]

        def grid(sets):
            m = np.zeros((len(sets), len(part)), np.float32)
            for r, s in enumerate(sets):
                s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
                at = np.searchsorted(part, s)
                m[r, at[part[at] == s]] = 1
            return m

        out += grid(left) @ grid(right).T
    return out


def compare_blocks(p: NearDup):
    """``compare`` of ``link_buckets``: exact similarity of every pair that no earlier band has brought together."""

    def compare(key, left, right, same):
        bl, br = (np.array(f.bands.tolist(), np.int64) for f in (left, right))
        need = left.component.to_numpy()[:, None] != right.component.to_numpy()[None, :]
        if same:
            need &= np.tri(len(left), k=-1, dtype=bool)
        band = int(np.argmax(bl[0] == key))
        for t in range(band):
            need &= bl[:, t][:, None] != br[:, t][None, :]
        nl, nr = left.n.to_numpy(np.float64), right.n.to_numpy(np.float64)
        need &= 100 * np.minimum(nl[:, None], nr[None, :]) >= p.percent * np.maximum(nl[:, None], nr[None, :])
        li, ri = np.flatnonzero(need.any(1)), np.flatnonzero(need.any(0))
        if not len(li):
            return []
        both = overlaps([shingles(t, p.shingle_words) for t in left.text.iloc[li]], [shingles(t, p.shingle_words) for t in right.text.iloc[ri]])
        linked = need[np.ix_(li, ri)] & (100 * both >= p.percent * (nl[li][:, None] + nr[ri][None, :] - both))
        return [(int(li[x]), int(ri[y])) for x, y in zip(*np.nonzero(linked), strict=True)]

    return compare


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    Documents with equal sets form a class without any pair; the smallest
    doc_id of each class goes on to the bands. component_id is the smallest
    doc_id reachable over links, kept marks it. Empty or null texts have no
    shingles and stand alone; a null doc_id is kept with a null component.
    Rows that repeat a doc_id each get a row; their texts are linked like those
    of two documents only through the doc_id they share. Extra columns are ignored.
    """
    sig = stored(signatures(docs, p), "signatures")
    classes = sig.where("set_hash is not null and doc_id is not null").groupBy("set_hash").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "classes")
    # one row per representative, even where rows repeat a doc_id
    reps = classes.join(sig.drop("n_shingles"), "set_hash").where("doc_id = rep").select("set_hash", "rep", "bands", "registers").dropDuplicates(["rep"])
    size = sig.select("set_hash", F.col("n_shingles").alias("n")).distinct()
    known = stored(reps.join(size, "set_hash"), "representatives")
    members = known.select(F.explode("bands").alias("key"), F.col("rep").alias("id"))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    regs = known.select("rep", "registers", "n")

    def verify(pairs: DataFrame) -> DataFrame:
        side = lambda s: regs.select(F.col("rep").alias(s), F.col("registers").alias(f"r{s}"), F.col("n").alias(f"n{s}"))
        hopeful = stored(_plausible(pairs.join(side("a"), "a").join(side("b"), "b"), p), "plausible")
        needed = hopeful.select(F.col("a").alias("doc_id")).union(hopeful.select("b")).distinct()
        texts = stored(rows_of(text, needed).dropDuplicates(["doc_id"]), "texts")
        ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
        tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
        return _confirmed(hopeful.join(ta, "a").join(tb, "b"), p)

    def payload(wanted: DataFrame) -> DataFrame:
        texts = rows_of(text, wanted.select(F.col("id").alias("doc_id"))).dropDuplicates(["doc_id"])
        return known.select(F.col("rep").alias("id"), "bands", "n").join(texts.withColumnRenamed("doc_id", "id"), "id")

    comp = link_buckets(members, verify, payload, compare_blocks(p))
    out = sig.select("doc_id", "n_shingles", "set_hash").join(classes, "set_hash", "left")
    out = out.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))
    )
