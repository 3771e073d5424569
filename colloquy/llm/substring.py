"""Substring dedup: word windows that start in an earlier document are removed, found level by level.

Level 1 looks at windows of half the length alone: a window of ``2 h - 1`` words
holds ``h`` windows of ``h`` words, and two equal windows agree on which of them
has the smallest hash. Only these *seeds* are shuffled (about two per ``h + 1``
words), each with a hash of the words its run of full windows spans. A seed that no
other document holds is dropped with all its windows. Runs whose span is equal to an
earlier document's are repeated as a whole; only runs that share the seed but not the
span go on to level 2, where their full-length windows are compared one by one.

Every task first combines its own batch (one row per seed or window, with the
smallest doc_id), so a passage that a third of all documents share sends one row per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import mix, parts, signed, stored, window_hashes, word_hashes, words_of

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ROWS = pa.schema([("key", pa.int64()), ("span", pa.int64()), ("doc_id", pa.int64()), ("packed", pa.binary())])
_SPARK_ROWS = "key long, span long, doc_id long, packed binary"


class Runs:
    """The runs of a document's windows that share a seed: window positions first..last, seed hash, span hash."""

    def __init__(self, h: np.ndarray, window: int):
        half = (window + 1) // 2
        seeds = window_hashes(h, half)
        n = len(h) - window + 1
        if n <= 0:
            self.first = self.last = np.empty(0, np.int64)
            self.seed = self.span = np.empty(0, np.uint64)
            return
        best, at = seeds[:n].copy(), np.zeros(n, np.int64)
        for j in range(1, window - half + 1):
            less = seeds[j : j + n] < best
            best[less] = seeds[j : j + n][less]
            at[less] = j
        at += np.arange(n)
        cut = np.flatnonzero(np.diff(at)) + 1
        self.first = np.concatenate(([0], cut))
        self.last = np.concatenate((cut - 1, [n - 1]))
        place = at[self.first]
        self.seed = seeds[place]
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(h) - 1, _BASE))))
        inverse = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, _BASE_INVERSE))))
        total = np.concatenate(([np.uint64(0)], np.cumsum(h * power)))
        words = (total[self.last + window] - total[self.first]) * inverse[self.first]
        shape = (self.last - self.first).astype(np.uint64) * np.uint64(64) + (place - self.first).astype(np.uint64)
        self.span = mix(words + mix(self.seed + shape))


def _first_rows(key: np.ndarray, span: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row order by (key, span, doc), and where a new key and a new (key, span) start in it."""
    order = np.lexsort((doc, span, key))
    k, s = key[order], span[order]
    new_key = np.concatenate(([True], k[1:] != k[:-1]))
    return order, new_key, new_key | np.concatenate(([True], s[1:] != s[:-1]))


def _row(key=None, span=None, doc=None, packed=None, n=0) -> pa.RecordBatch:
    nulls = pa.nulls(n, pa.int64())
    cols = [signed(key), nulls if span is None else signed(span), doc, pa.nulls(n, pa.binary()) if packed is None else packed]
    return pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(cols, _ROWS.types, strict=True)], schema=_ROWS)


def _per_doc(doc: np.ndarray, kind: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per document the values already settled in this batch: (16 bytes kind and value)*, under a key of the document's own."""
    if not len(doc):
        return
    order = np.argsort(doc, kind="stable")
    pairs = np.stack([kind[order].astype(np.uint64), value[order]], axis=1)
    ids, start = np.unique(doc[order], return_index=True)
    packed = [pairs[a:b].tobytes() for a, b in zip(start, [*start[1:], len(order)], strict=True)]
    yield _row(mix(ids.view(np.uint64)), doc=ids, packed=packed, n=len(ids))


def _seed_rows(window: int):
    """Level 1, combined per batch: rows (seed, span, doc), a marker (seed, null, doc) where spans differ, settled values per document."""

    def run(batches):
        for b in parts(batches):
            seeds, spans, docs = [], [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                r = Runs(word_hashes(words_of(text.as_py())), window)
                if len(r.seed):
                    seeds.append(r.seed)
                    spans.append(r.span)
                    docs.append(np.full(len(r.seed), doc, np.int64))
            if not seeds:
                continue
            key, span, doc = map(np.concatenate, (seeds, spans, docs))
            order, new_key, new_span = _first_rows(key, span, doc)
            key, span, doc = key[order], span[order], doc[order]
            group, sub = np.cumsum(new_key) - 1, np.cumsum(new_span) - 1
            first = np.flatnonzero(new_span)
            later = doc > doc[first][sub]  # an earlier document of this batch has the same span
            several = np.bincount(group[first]) > 1
            open_ = several[group[first]]
            yield _row(key[first][~open_], span[first][~open_], doc[first][~open_], n=int((~open_).sum()))
            lowest = np.full(len(several), np.iinfo(np.int64).max)
            np.minimum.at(lowest, group[first], doc[first])
            yield _row(key[new_key][several], None, lowest[several], n=int(several.sum()))
            yield from _per_doc(
                np.concatenate([doc[later], doc[first][open_]]),
                np.concatenate([np.zeros(int(later.sum()), np.uint64), np.ones(int(open_.sum()), np.uint64)]),
                np.concatenate([span[later], span[first][open_]]),
            )

    return run


def _settled(spans, states, packed) -> tuple[np.ndarray, np.ndarray]:
    """Values with state 0 and with state 1 of one document, from the shuffled rows and the batch's own."""
    parts = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in packed or []]
    if spans:
        parts.append(np.stack([np.array(states, np.uint64), np.array(spans, np.int64).view(np.uint64)], axis=1))
    pairs = np.concatenate(parts) if parts else np.empty((0, 2), np.uint64)
    return pairs[pairs[:, 0] == 0, 1], pairs[pairs[:, 0] == 1, 1]


def _open_windows(runs: Runs, level1) -> tuple[np.ndarray, np.ndarray]:
    """Windows of whole repeated runs, and windows that level 2 has to compare, as positions."""
    whole, part = _settled(*level1)
    whole = np.isin(runs.span, whole)
    part = np.isin(runs.span, part) & ~whole
    spread = lambda which: np.concatenate([np.arange(a, b + 1) for a, b in zip(runs.first[which], runs.last[which], strict=True)] or [np.empty(0, np.int64)])
    return spread(whole), spread(part)


def _window_rows(window: int):
    """Level 2, combined per batch: rows (window hash, null, doc) and the windows settled in this batch per document."""

    def run(batches):
        for b in parts(batches):
            keys, docs = [], []
            for doc, text, *level1 in zip(b.column("doc_id").to_pylist(), b.column("text"), *(b.column(c) for c in ("spans", "states", "packed")), strict=True):
                level1 = [x.as_py() for x in level1]
                if not len(_settled(*level1)[1]):
                    continue
                h = word_hashes(words_of(text.as_py()))
                at = _open_windows(Runs(h, window), level1)[1]
                if len(at):
                    keys.append(window_hashes(h, window)[at])
                    docs.append(np.full(len(at), doc, np.int64))
            if not keys:
                continue
            key, doc = np.concatenate(keys), np.concatenate(docs)
            order, new, _ = _first_rows(key, key, doc)
            key, doc = key[order], doc[order]
            first = np.flatnonzero(new)
            later = doc > doc[first][np.cumsum(new) - 1]
            yield _row(key[first], None, doc[first], n=len(first))
            yield from _per_doc(doc[later], np.zeros(int(later.sum()), np.uint64), key[later])

    return run


def _removed(window: int):
    """Every document with its removed word spans and the text of its kept words."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())])

    def one(doc, text, level1, level2):
        words = words_of(text)
        if not level1[0] and not level1[2]:
            return doc, len(words), 0, [], b" ".join(words).decode("utf-8", "replace")
        h = word_hashes(words)
        whole, part = _open_windows(Runs(h, window), level1)
        part = part[np.isin(window_hashes(h, window)[part], _settled(level2[0], [0] * len(level2[0] or []), level2[1])[0])]
        edge = np.zeros(len(words) + 1, np.int64)
        start = np.concatenate([whole, part])
        np.add.at(edge, start, 1)
        np.add.at(edge, start + window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        turn = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
        spans = [{"start": int(s), "end": int(e)} for s, e in zip(turn[::2], turn[1::2], strict=True)]
        kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
        return doc, len(words), int(gone.sum()), spans, kept.decode("utf-8", "replace")

    def run(batches):
        names = ("text", "spans", "states", "packed", "windows", "packed2")
        for b in parts(batches, 1024):
            rows = [one(d, t.as_py(), (s.as_py(), st.as_py(), p.as_py()), (w.as_py(), p2.as_py())) for d, t, s, st, p, w, p2 in zip(b.column("doc_id").to_pylist(), *(b.column(c) for c in names), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    return run


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_text) per row of ``docs``.

    A word goes if a window of ``window`` words covers it whose word sequence also starts in a
    document with a smaller doc_id, judged on the input. spans are the removed word ranges
    [start, end); kept_text joins the kept words by one space. Null or empty texts have no words.
    A null doc_id is smaller than none and has none smaller: such rows stay whole. Rows that repeat a
    doc_id count as one document. Extra columns are ignored; an empty table gives an empty result.
    """
    if window < 3 or window % 2 == 0:
        raise ValueError("window must be an odd number of words, 3 or more")
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seeds = text.where("doc_id is not null").mapInArrow(_seed_rows(window), _SPARK_ROWS)
    by_seed, by_span = Window.partitionBy("key"), Window.partitionBy("key", "span")
    differ = F.max(F.col("span").isNull()).over(by_seed) | (F.min("span").over(by_seed) != F.max("span").over(by_seed))
    seen = seeds.select("*", differ.alias("differ"), F.min("doc_id").over(by_seed).alias("lo"), F.max("doc_id").over(by_seed).alias("hi"), F.min("doc_id").over(by_span).alias("earliest"))
    state = F.when(F.col("earliest") < F.col("doc_id"), 0).when(F.col("differ") & (F.col("lo") < F.col("hi")), 1)
    seen = seen.select("doc_id", "span", F.when(F.col("span").isNotNull(), state).alias("state"), "packed").where("state is not null or packed is not null")
    level1 = stored(
        seen.groupBy("doc_id").agg(
            F.collect_list(F.when(F.col("state").isNotNull(), F.col("span"))).alias("spans"), F.collect_list("state").alias("states"), F.collect_list("packed").alias("packed")
        ),
        "repeated-seeds",
    )
    known = text.join(level1, "doc_id", "left")
    windows = known.mapInArrow(_window_rows(window), _SPARK_ROWS)
    windows = windows.withColumn("earliest", F.min("doc_id").over(by_seed)).where("earliest < doc_id or packed is not null")
    level2 = windows.groupBy("doc_id").agg(F.collect_list(F.when(F.col("packed").isNull(), F.col("key"))).alias("windows"), F.collect_list("packed").alias("packed2"))
    return known.join(level2, "doc_id", "left").mapInArrow(
        _removed(window), "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"
    )
