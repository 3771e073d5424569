"""Count reports: golden reproduction of the published corpus table, and properties."""

from pyspark.sql import functions as F

from colloquy.config import DEFAULT_VOCAB
from colloquy.operators import counts as ct
from colloquy.plans.reports import count_report

SPLITS = ["train", "valid", "test1", "test2", "test3"]

# Published rows per (subset, version) and split for the extended corpus (golden values).
PUBLISHED = {
    ("aci", "asr"): [35, 11, 22, 22, 22],
    ("aci", "asrcorr"): [35, 11, 22, 22, 22],
    ("virtassist", "humantrans"): [20, 5, 10, 10, 10],
    ("virtscribe", "asr"): [12, 4, 8, 8, 8],
    ("virtscribe", "humantrans"): [12, 4, 8, 8, 8],
}


def published_long(spark):
    rows = [
        (subset, split, tv, n)
        for (subset, tv), counts in PUBLISHED.items()
        for split, n in zip(SPLITS, counts)
    ]
    return spark.createDataFrame(rows, "subset string, split string, transcript_version string, count long")


def test_pivot_reproduces_published_table(spark):
    long = published_long(spark)
    order = ct.report_order(long, DEFAULT_VOCAB)
    assert order.subsets == ("aci", "virtassist", "virtscribe") and order.subsets_known
    pivot = ct.pivot_by_split(long, ["subset", "transcript_version"], order)
    got = [tuple(r) for r in pivot.collect()]
    assert got[-1] == ("ALL", "ALL", 114, 35, 70, 70, 70, 359)
    body = {(r[0], r[1]): r[2:] for r in got[:-1]}
    assert len(body) == 9  # unobserved pairs appear with zeros, as published
    assert body[("aci", "humantrans")] == (0, 0, 0, 0, 0, 0)
    assert body[("virtassist", "humantrans")] == (20, 5, 10, 10, 10, 55)
    assert [k for k in body] == [(s, v) for s in order.subsets for v in order.versions]


def test_overall_totals_are_true_totals(spark):
    long = published_long(spark)
    overall = [tuple(r) for r in ct.overall_with_totals(long).collect()]
    assert overall[-1] == ("ALL", "ALL", 359)  # quirk Q2 fixed: not double-counted
    assert overall[0] == ("aci", "ALL", 224)  # 'ALL' sorts before versions inside a subset
    subtotal = {r[0]: r[2] for r in overall if r[1] == "ALL" and r[0] != "ALL"}
    assert subtotal == {"aci": 224, "virtassist": 55, "virtscribe": 80}


def test_pivots_by_subset_and_version(spark):
    long = published_long(spark)
    by_subset = {r[0]: r[-1] for r in ct.pivot_by_split(long, ["subset"]).collect()}
    assert by_subset == {"aci": 224, "virtassist": 55, "virtscribe": 80, "ALL": 359}
    by_tv = {r[0]: r[-1] for r in ct.pivot_by_split(long, ["transcript_version"]).collect()}
    assert by_tv == {"asr": 152, "asrcorr": 112, "humantrans": 95, "ALL": 359}


def test_unknown_subsets_sort_alphabetically_and_extras_after(spark):
    rows = [("zeta", "train", "asr", 1), ("alpha", "valid", "custom", 2), ("alpha", "extra", None, 3)]
    corpus = spark.createDataFrame(
        [(s, sp, tv) for s, sp, tv, n in rows for _ in range(n)], "subset string, split string, transcript_version string"
    )
    rep = count_report(corpus)
    assert rep.order.subsets == ("alpha", "zeta") and not rep.order.subsets_known
    assert rep.order.versions == ("asr", "<missing>", "custom")
    assert rep.order.splits == ("train", "valid", "extra")
    assert rep.by_split.columns == ["subset", "transcript_version", "train", "valid", "extra", "Total"]
    cats = {r.transcript_version: (r.version_rank, r.is_known_version) for r in ct.version_categories(rep.long).collect()}
    assert cats == {"asr": (1, True), "<missing>": (2, False), "custom": (3, False)}


def test_rollup_total_equals_sum_of_leaves(spark):
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("lang").alias("subset"), F.lit("train").alias("split"), F.col("source").alias("transcript_version")
    )
    rep = count_report(corpus)
    leaves = sum(r["count"] for r in rep.long.collect())
    assert rep.overall.collect()[-1]["Count"] == leaves == corpus.count()


def test_empty_selection_raises(spark):
    import pytest

    corpus = published_long(spark).select("subset", "split", "transcript_version")
    with pytest.raises(RuntimeError, match="no rows to count"):
        count_report(corpus, splits=["nope"])


def test_report_releases_its_cache(spark):
    rep = count_report(published_long(spark).select("subset", "split", "transcript_version"))
    assert rep.cached.is_cached
    rep.unpersist()
    assert not rep.cached.is_cached
