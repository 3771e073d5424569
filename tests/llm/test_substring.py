import pytest

from colloquy.llm import substring


def _brute(rows, n):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - n + 1):
            first.setdefault(tuple(words[i][j : j + n]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if first[tuple(w[j : j + n])] < i:
                gone[j : j + n] = [True] * n
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


@pytest.mark.parametrize("n", [13, 7])
def test_removed_words_equal_brute_force(small_docs, n):
    rows = [(r.doc_id, r.text) for r in small_docs.collect() if r.doc_id is not None]
    got = substring.remove_repeats(small_docs, n).collect()
    assert len(got) == small_docs.count()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got if r.doc_id is not None} == _brute(rows, n)
    assert [r.n_removed for r in got if r.doc_id is None] == [0]
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_repeats_within_one_document_stay(spark):
    d = spark.createDataFrame([(1, " ".join(["a b c d e f g h i j k l m n"] * 9))], "doc_id long, text string")
    assert substring.remove_repeats(d).first().n_removed == 0


def test_empty_table_and_bad_window(no_docs):
    assert substring.remove_repeats(no_docs).count() == 0
    with pytest.raises(ValueError):
        substring.remove_repeats(no_docs, 4)
