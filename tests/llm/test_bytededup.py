import hashlib
import random

import numpy as np
import pytest

from colloquy.llm import anchors, bytededup, queries
from colloquy.llm.suffixes import suffix_arrays

SF = "/root/testdata/sf0.001"


def test_suffix_arrays_equal_sorting():
    rng = random.Random(1)
    for _ in range(200):
        texts = [[rng.randint(1, a) for _ in range(rng.randint(0, 40))] + [0] for a in (1, 2, 3, 9)[: rng.randint(1, 4)]]
        starts = np.cumsum([0] + [len(t) for t in texts])[:-1]
        got = suffix_arrays(np.array(sum(texts, []), np.int16), starts)
        for t, s in zip(texts, starts, strict=True):
            assert (got[s : s + len(t)] - s).tolist() == sorted(range(len(t)), key=lambda i, t=t: t[i:])


def _brute(rows, size):
    """rows (doc_id, bytes) of distinct ids, in order of doc_id."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        gone = bytearray(len(text))
        for i in range(len(text) - size + 1):
            w = text[i : i + size]
            if w in seen:
                gone[i : i + size] = b"\1" * size
            seen.add(w)
        runs = sum(1 for i in range(len(text)) if gone[i] and not (i and gone[i - 1]))
        out[doc] = (len(text), sum(gone), runs, bytes(c for c, g in zip(text, gone, strict=True) if not g))
    return out


def _same(spark, rows, size=100, parts=4):
    df = spark.createDataFrame([(i, t, 1, "k", 2) for i, t in rows], "doc_id long, text string, hash int, key string, copy int").repartition(parts)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in bytededup.remove_repeated_bytes(df, size).collect()}
    assert got == _brute([(i, (t or "").encode()) for i, t in rows], size)


def _prose(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta théta iota kappa lambda mu nu xi omicron pi rho".split()) + rng.choice(("", "s", "ing")) for _ in range(n))


def test_removed_bytes_equal_brute_force(spark):
    rng = random.Random(2)
    base = [_prose(rng, 80) for _ in range(6)]
    rows = [*base, *base]
    for t in base:
        w = t.split()
        for i in (10, 40, 41):
            rows.append(" ".join(w[:i] + ["other"] + w[i + 1 :]))
        rows.append(_prose(rng, 9) + t[101:260] + _prose(rng, 9) + t[130:290])
        rows.append(t[:99])
        rows.append(t[:100])
    rows += [None, "", "x" * 99, "x" * 100, "x" * 700, "ab" * 300, _prose(rng, 30) + "y" * 120, "é" * 90, base[0] + base[0]]
    rng.shuffle(rows)
    _same(spark, list(enumerate(rows, 5)))


def test_smaller_windows_and_chunk_edges(spark, monkeypatch):
    monkeypatch.setattr(anchors, "CHUNK", 256)  # seen by workers: functions travel with their module's values
    rng = random.Random(3)
    passage = _prose(rng, 60)
    _same(spark, [(i, _prose(rng, 30) + passage + _prose(rng, 20)) for i in range(12)] + [(50, passage * 4)], size=64)


def test_large_groups_are_halved(spark, monkeypatch):
    monkeypatch.setattr(bytededup, "GROUP", 3)
    rng = random.Random(4)
    phrase = "a phrase that very many documents hold and continue differently"
    rows = [(i, _prose(rng, rng.randint(0, 12)) + phrase + _prose(rng, rng.randint(0, 9))) for i in range(60)]
    rows += [(100 + i, t) for i, (_, t) in enumerate(rows[:30])]
    rows += [(200 + i, t[20:180]) for i, (_, t) in enumerate(rows[:30])]
    _same(spark, rows)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = _brute(docs, 100)
    got = queries.op13_suffix_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {i: (*v[:3], hashlib.sha256(v[3]).hexdigest()) for i, v in want.items()}


def test_odd_tables(spark, small_docs, no_docs):
    assert bytededup.remove_repeated_bytes(no_docs).count() == 0
    got = bytededup.remove_repeated_bytes(small_docs).collect()
    assert len(got) == small_docs.count()
    assert [r.n_removed for r in got if r.doc_id is None] == [0]
    rows = {(r.doc_id, (r.text or "").encode()) for r in small_docs.collect() if r.doc_id is not None}
    want = _brute(list(rows), 100)  # the repeated rows are equal
    assert {(r.doc_id, r.n_removed, bytes(r.kept)) for r in got if r.doc_id is not None} == {(i, v[1], v[3]) for i, v in want.items()}
    # different texts of one doc_id
    t = _prose(random.Random(9), 60)
    two = spark.createDataFrame([(1, t), (1, t + "!"), (2, t)], "doc_id long, text string")
    removed = sorted((r.doc_id, r.n_removed) for r in bytededup.remove_repeated_bytes(two).collect())
    n = len(t.encode())
    assert removed in ([(1, 0), (1, n), (2, n)],)
    with pytest.raises(ValueError):
        bytededup.remove_repeated_bytes(two, 40)
