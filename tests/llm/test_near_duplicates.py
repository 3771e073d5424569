import re

import numpy as np

from colloquy.llm import components, neardup


def _sets(rows, k):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        out[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    return out


def _brute(rows, k, percent):
    sets = _sets(rows, k)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def _found(out):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.collect() if r.doc_id is not None}


def test_components_equal_brute_force(small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect() if r.doc_id is not None]
    for k, percent in ((3, 85), (5, 80)):
        out = neardup.near_duplicates(small_docs, neardup.NearDup(shingle_words=k, percent=percent))
        assert out.count() == small_docs.count()
        assert _found(out) == _brute(rows, k, percent)


def test_a_large_group_of_near_copies_goes_through_blocks(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 6)):
            w[at] = f"x{rng.integers(0, 9999)}"
        rows.append((i, " ".join(w)))
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), neardup.NearDup(shingle_words=3, percent=85))
    assert _found(out) == _brute(rows, 3, 85)


def test_empty_table(no_docs):
    assert neardup.near_duplicates(no_docs).count() == 0


def test_registers_merge_and_track_similarity():
    p = neardup.NearDup()
    sketch = neardup.sketcher(p)
    rng = np.random.default_rng(2)
    a, b = (np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64)) for _ in range(2))
    assert (np.maximum(sketch(a), sketch(b)) == sketch(np.union1d(a, b))).all()
    half = np.union1d(a[:1000], b[:0])
    n = lambda *x: [np.array([float(v)]) for v in x]
    x, y = sketch(a), sketch(half)
    up = neardup.similarity_upper(*n((x > y).sum(), (x < y).sum(), (x == y).sum()), *n(len(a), len(half)), p.base)
    assert 1 / 3 <= up[0] < 0.7


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands_follow_the_threshold():
    for percent, bands in ((85, 20), (80, 29), (50, 363), (100, 1)):
        p = neardup.NearDup(percent=percent)
        assert p.bands == bands and p.registers == 5 * bands
        assert (1 - (percent / 100) ** p.rows) ** p.bands <= p.miss
