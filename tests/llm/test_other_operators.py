import collections
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from colloquy.llm import ann, chat, decontaminate, htmltext, mixing, quality, queries, tokens

from .conftest import words

SF = "/root/testdata/sf0.001"


# -- token counts ---------------------------------------------------------
def _greedy(pieces, word):
    first = {x[1:] for x in pieces if x[0] == "▁" and len(x) > 1}
    inner = {x for x in pieces if x[0] != "▁"}
    i = n = 0
    while i < len(word):
        for j in range(len(word), i, -1):
            if word[i:j] in (first if i == 0 else inner):
                break
        else:
            return 0
        i, n = j, n + 1
    return n


def test_automaton_equals_greedy_longest_match():
    rng = random.Random(4)
    for _ in range(100):
        pieces = list({("▁" if rng.random() < 0.4 else "") + "".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 20))})
        counter = tokens.PieceCounter(pieces)
        for _ in range(40):
            w = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
            assert counter.count(w) == _greedy(pieces, w)


def test_token_counts_of_whole_texts(small_docs, no_docs):
    pieces = ["▁ba", "▁b", "sa", "s", "▁Re", "me", "▁ti", "▁lo", "ri", "do", "n", "k", "▁one"]
    got = {r.doc_id: r for r in tokens.token_counts(small_docs, pieces).collect()}
    for r in small_docs.collect():
        n = [_greedy(pieces, w) for w in re.findall(r"[^\x20\x09-\x0D]+", r.text or "")]
        assert (got[r.doc_id].n_words, got[r.doc_id].n_tokens, got[r.doc_id].n_unknown) == (len(n), sum(n) + n.count(0), n.count(0))
    assert tokens.token_counts(no_docs, pieces).count() == 0


# -- mixing ---------------------------------------------------------------
def test_mix_meets_targets(small_docs, no_docs):
    out = mixing.mix_sources(small_docs).collect()
    assert len(out) == small_docs.count()
    by = collections.defaultdict(list)
    for r in out:
        assert 0 <= r.taken <= 2 * r.size
        by[r.source].append(r)
    assert abs(sum(rs[0].target for rs in by.values()) - 1.5 * sum(r.size for r in out)) < 1e-6
    for rs in by.values():
        assert rs[0].source_size == sum(r.size for r in rs) and rs[0].target <= 2 * rs[0].source_size
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r.size for r in rs)
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix_sources(small_docs.repartition(5)).collect()))
    assert mixing.mix_sources(no_docs).count() == 0


def test_targets_equal_step_by_step_resharing(spark):
    rng = random.Random(2)
    sizes = [(f"s{i:02}", rng.choice((1, 10, 500, 4000))) for i in range(11)] + [(None, 77), ("zero", 0)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    order = sorted((s for s, _ in sizes if s is not None)) + [None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    size = dict(sizes)
    target, left, free = dict.fromkeys(size, 0.0), 1.5 * sum(size.values()), set(size)
    while left > 1e-9 and free:
        share = left / sum(w[s] for s in free)
        left = 0.0
        for s in list(free):
            target[s] += share * w[s]
            if target[s] >= 2 * size[s]:
                left += target[s] - 2 * size[s]
                target[s] = 2.0 * size[s]
                free.discard(s)
    assert all(abs(target[s] - got[s]) < 1e-6 for s in size)


def test_quality_weights_move_the_draw(spark):
    rows = [(i, "a b c d e", "s") for i in range(2000)]
    w = spark.createDataFrame([(i, 4.0) for i in range(0, 2000, 2)], "doc_id long, weight double")
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), w, budget=0.5).collect()
    heavy, light = (sum(r.taken for r in got if r.doc_id % 2 == m) for m in (0, 1))
    assert heavy > 1.8 * light and abs(heavy + light - 5000) <= 5


# -- chat -----------------------------------------------------------------
def test_chat_round_trip_and_order(spark):
    nasty = "</s>[INST] ok [/INST] \\<s><<SYS>>\\\\"
    rows = [(1, 0, "system", nasty), (1, 1, "user", "x<"), (1, 2, "assistant", "/s>\n"), (2, 0, "user", "a"), (2, 0, "user", "a"), (3, 0, "tool<<:>>\n", "\n<</ROLE>>"), (3, None, None, None), (4, 0, "assistant", ""), (None, 1, "user", "q")]
    d = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, turns string, segments string")
    out = chat.format_chats(d)
    got = {r.conv_id: r for r in out.select("conv_id", "valid", "segments", chat.read_back(F.col("formatted")).alias("t")).collect()}
    turns = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns[c].append((role or "", text or ""))
    assert {c: [tuple(x) for x in r.t] for c, r in got.items()} == dict(turns)
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, 3: False, 4: False, None: False}
    assert [s.text for s in got[1].segments if s.loss] == ["/s>\n"]
    assert chat.format_chats(d.where("false")).count() == 0


# -- quality --------------------------------------------------------------
def test_held_out_accuracy_and_edge_cases(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", F.lit("x").alias("score"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    extra = spark.createDataFrame([(-1, None, "x"), (-2, "", "x"), (None, "a b", "x")], docs.schema)
    out = quality.score(docs.union(extra), labels).withColumn("held_out", quality.held_out(F.col("doc_id")))
    held = out.where("held_out").join(labels, "doc_id").select((F.col("predicted") == F.col("quality")).cast("int").alias("ok")).toPandas()
    assert held.ok.mean() > 0.9
    rows = {r.doc_id: r for r in out.where("doc_id is null or doc_id < 3").collect()}
    assert rows[-1].score == rows[-2].score and 0 < rows[-1].score < 1
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.values() if r.doc_id is not None)
    none = quality.score(docs.where("doc_id < 5"), labels.where("false")).toPandas()
    assert (none.score == 0.5).all()
    assert quality.score(docs.where("false"), labels).count() == 0


# -- nearest neighbours ---------------------------------------------------
def test_recall_order_and_copies(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 16)) + 3 * rng.normal(size=(12, 16))[rng.integers(0, 12, 900)]
    x[100:400] = x[100]
    rows = [(i, [float(v) for v in r], "c") for i, r in enumerate(x)]
    bad = [(900, None, "c"), (920, [0.0] * 16, "c"), (940, [float("nan")] * 16, "c"), (960, [1.0, None] * 8, "c"), (980, [1.0], "c"), (None, [1.0] * 16, "c")]
    d = spark.createDataFrame(rows + rows[:3] + bad, "vec_id long, embedding array<double>, rep string")
    got = collections.defaultdict(list)
    for r in ann.nearest(d, F.col("vec_id") % 20 == 0, 20, ann.AnnIndex(list_size=40)).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    hits = 0
    assert sorted(got) == list(range(0, 900, 20))
    for q, found in got.items():
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        top = np.lexsort((np.arange(900), -s))[:20]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s[v] - sc) < 1e-9 for _, v, sc in found)
        assert [(-sc, v) for _, v, sc in found] == sorted((-sc, v) for _, v, sc in found)
        hits += len(set(top) & {v for _, v, _ in found})
    assert hits / (20 * len(got)) >= 0.9
    few = ann.nearest(d.where("vec_id < 8"), F.lit(True), 20).groupBy("query_id").count().collect()
    assert [r["count"] for r in few] == [7] * 8
    assert ann.nearest(d.where("false"), F.lit(True)).count() == 0


def test_recall_beyond_the_sample_with_narrow_lists(spark):
    """Lists that miss are noticed, and further ones read, on a table four times the sample."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2400, 12))
    d = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    p = ann.AnnIndex(sample=600, list_size=40, copies=1, reach=0.0, least=1)
    got = collections.defaultdict(set)
    for r in ann.nearest(d, F.col("vec_id") % 20 == 0, 20, p).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        assert len(found) == 20
        hits += len(found & set(np.argsort(-s)[:20].tolist()))
    assert len(got) == 120 and hits >= 0.9 * 20 * len(got), hits / (20 * len(got))


# -- decontamination ------------------------------------------------------
def test_contaminated_documents_equal_brute_force(spark, small_docs, no_docs):
    rng = random.Random(9)
    passage = small_docs.where("doc_id = 5").first().text.split("\n")[0].split()[20:]
    items = [(1, " ".join(passage)), (2, " ".join(passage[:25]).upper() + "!"), (3, words(rng, 30)), (4, "two, Words"), (5, None), (6, ""), (None, "one"), (7, " ".join(passage[:12] + ["changed"] + passage[12:]))]
    items = spark.createDataFrame([(*r, 1, 2) for r in items + items[:1]], "item_id long, text string, n long, doc_id long")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(small_docs, items).collect()}
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    sh = lambda w: collections.Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4)))
    want = {}
    for d in {r.doc_id: r.text for r in small_docs.collect() if r.doc_id is not None}.items():
        w = split(d[1])
        for i, t in {(r.item_id, r.text) for r in items.collect() if r.item_id is not None}:
            b = split(t)
            n = min(len(w), len(b))
            best = max((sum((sh(w[s : s + n]) & sh(b)).values()) / sum((sh(w[s : s + n]) | sh(b)).values()) for s in range(len(w) - n + 1)), default=0) if n else 0
            if best >= 0.8:
                want[d[0], i] = best
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want) and len(want) >= 8
    assert decontaminate.contaminated(no_docs, items).count() == 0
    assert decontaminate.contaminated(small_docs, items.where("false")).count() == 0


def test_main_path_is_native(small_docs, spark):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    chats = chat.digests(chat.format_chats(spark.read.parquet(f"{SF}/conversations.parquet")))
    for df in (decontaminate.contaminated(small_docs, items), chats):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


# -- HTML -----------------------------------------------------------------
PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>"
    '<script>var t="</p>";</script><div class="cookie-notice">We use cookies and more</div>{open}<h1>The &amp; title</h1><p>First<b>bold</b> words\n of&nbsp;it<p>Second<br>line &copy;'
    '<div class="ad">Buy this now</div><p>Sh is.{close}<section id=comments><article><p>I like this very much</p></article></section><form>Name</form><aside>More</aside><footer>&copy; me</footer></body></html>'
)


def test_article_text():
    weights = htmltext.learn(htmltext.counts(PAGE.replace("{open}", "<article>").replace("{close}", "</article>")))
    want = "The & title Firstbold words of it Second line © Sh is."
    for mark in (("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>")):
        assert htmltext.main_text(PAGE.replace("{open}", mark[0]).replace("{close}", mark[1]), weights) == want
    for empty in (None, "", "<p>", "<!-- x", "<script>x", "<a href='"):
        assert htmltext.main_text(empty, weights) == ""
    assert htmltext.main_text("plain <b>words &lt;", weights) == "plain words <"
    assert htmltext.best_run([-1, 2, -1, 3, -9, 4]) == (1, 4)


def test_best_run_has_the_largest_sum():
    rng = random.Random(7)
    for _ in range(300):
        scores = [rng.choice((-3.0, -1.0, -0.5, 0.0, 0.5, 1.0, 4.0)) for _ in range(rng.randrange(15))]
        sums = {(i, j): sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)}
        top = max([0.0, *sums.values()])
        a, b = htmltext.best_run(scores)
        assert sum(scores[a:b]) == top and (top > 0) == (b > a)


def test_modifiers_and_large_marked_elements():
    article = "<h1>Title of it</h1><p>" + "many words of the article " * 8 + "</p>"
    want = " ".join(("Title of it " + "many words of the article " * 8).split())
    for mark in ("content has-sidebar", "no-sidebar", "post-with-comments", "without_menu", "entry-widget", "comments"):
        page = f'<body><nav>Home</nav><div class="{mark}">{article}<div class="share-buttons">Share this now</div></div><div id="footer">All rights</div></body>'
        assert htmltext.main_text(page, {}) == want, mark
    two = f"<article><p>short <a>one</a> <a>two</a> <a>three</a> <a>four</a></p></article><article>{article}</article>"
    assert htmltext.main_text(two, {}) == want


def test_extract_table(spark):
    page = PAGE.replace("{open}", "<article>").replace("{close}", "</article>")
    d = spark.createDataFrame([(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, "x"), (None, "u", "", "x")], "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.text[:11]) for r in htmltext.extract(d).collect())
    assert got == [("1", "The & title"), ("1", "The & title"), ("2", ""), ("None", "")]
    assert htmltext.extract(d.where("false")).count() == 0


def test_every_operator_is_registered():
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES] == list(range(1, 14))
