import random

import pytest

DOCS = "doc_id long, text string, source string, key long, id long, component string"


def words(rng, n):
    return " ".join(rng.choice(("ba", "Re", "ti", "lo", "nu", "ka")) + rng.choice(("sa", "me", "ri", "do", "vu")) + rng.choice(("", "n", "s", "k")) for _ in range(n))


@pytest.fixture(scope="session")
def small_docs(spark):
    """Copies, near copies, shared passages, repeated rows, nulls, empty, tiny and long texts; extra columns that clash."""
    rng = random.Random(3)
    base = [words(rng, 60) for _ in range(6)]
    passage = words(rng, 30)
    rows = []
    for i, t in enumerate(base):
        w = t.split()
        rows.append(t)
        rows.append(t)
        rows.append(" ".join(w[:20] + ["other"] + w[21:]))
        rows.append(" ".join(w[:55]))
        rows.append(words(rng, 20) + " " + passage + "\n" + words(rng, 10))
        rows.append(f"Page {i} of 12 of the long report on things\n" + words(rng, 40))
    rows += [None, "", " \n\t ", "one", "two words", "two words", words(rng, 4000), passage + "é x " + passage]
    table = [(i + 1, t, f"s{i % 4}" if i % 5 else None, 1, 2, "x") for i, t in enumerate(rows)]
    table += [table[0], table[8], (None, base[0], "s1", 1, 2, "x")]
    return spark.createDataFrame(table, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
