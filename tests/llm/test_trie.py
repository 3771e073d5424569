import hashlib
import random
import zlib

from colloquy.llm import trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
KIND = "conv_id long, turn long, role string, text string, depth int, node string, total string"


def _key(role, text):
    r, t = role.encode(), text.encode()
    return hashlib.sha256(str(len(r)).encode() + b":" + r + t).digest()[:16]


def _brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, _key(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])
        built[c] = tuple(base[:h]) + tuple(turns[h:])
    members, ends = {}, {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members.setdefault(built[c][:d], []).append(c)
        ends.setdefault(built[c], []).append(c)
    out = set()
    for path, inside in members.items():
        below = [q for q in members if q[: len(path)] == path]
        children = [q for q in below if len(q) == len(path) + 1]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        joined = ",".join(map(str, ends.get(path, []))).encode()
        parent = members[path[:-1]][0] if path else None
        out.add((inside[0], len(path), parent, len(inside), len(children), len(leaves), saved, hashlib.sha256(joined).hexdigest()))
    return out


def _same(spark, rows):
    df = spark.createDataFrame([(*r, 1, "n", "t") for r in rows], KIND).repartition(4)
    got = trie.prefix_trie(df).select(*COLUMNS).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == _brute(rows)


def test_trie_equals_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for c in list(range(40)) + [-7, -5, 1005]:
        for i in range(rng.choice((1, 2, 3, 5, 8, 9, 12))):
            rows.append((c, i, ("user", "assistant")[i % 2], rng.choice(("hello", "ok", "é" * 3, "", "longer text " * 20))))
    rows += rows[:9]  # repeated rows
    rows += [(3, None, None, None), (4, 2, None, "x"), (None, 0, "user", "lost"), (50, None, "user", "a"), (50, None, "user", "b")]
    _same(spark, rows)


def test_long_and_equal_conversations(spark):
    long = [(c, i, "user", f"turn {i}" if i < 40 + c else f"own {c}") for c in (0, 5, 6) for i in range(60)]
    copies = [(c, i, "user", f"copy {i}") for c in range(100, 160) for i in range(3)]
    _same(spark, long + copies)


def test_no_conversations(spark):
    none = spark.createDataFrame([], KIND)
    assert trie.prefix_trie(none).count() == 0
    assert trie.prefix_trie(none.union(spark.createDataFrame([(None, 1, "user", "x", 1, "n", "t")], KIND))).count() == 0


def test_a_node_with_many_ends_is_hashed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 100)
    ends = spark.range(-5, 3000).selectExpr("if(id % 3 = 0, X'01', X'02') AS end", "id AS conv_id").repartition(5)
    got = {bytes(r.node): r.ends_sha256 for r in trie.ends_hashes(ends).collect()}
    want = {k: hashlib.sha256(",".join(str(i) for i in range(-5, 3000) if (i % 3 == 0) == (k == b"\x01")).encode()).hexdigest() for k in (b"\x01", b"\x02")}
    assert got == want
