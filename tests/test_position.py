"""Global positions and flagged coverage against plain Python."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from colloquy.operators.coverage import coverage_segments, coverage_totals
from colloquy.operators.position import GROUP, ordered_table, with_offsets, with_position, with_position_in_group


def _rows(n=500):
    rng = random.Random(1)
    return [(i, rng.choice(("x", "y", "é", "", None)), rng.choice((None, 1.5, -2.0, 7.25)), rng.random()) for i in range(n)]


def test_positions_in_any_order(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id int, name string, size double, r double").repartition(7)
    got = {r.id: r.place for r in with_position(df, ["name", "-size", "id"], partitions=9).collect()}
    low = lambda x: (x is not None, x.encode() if isinstance(x, str) else x or 0)
    want = sorted(rows, key=lambda r: r[0])
    want.sort(key=lambda r: low(r[2]), reverse=True)
    want.sort(key=lambda r: low(r[1]))
    # Python's reverse sort keeps the order of equal rows
    assert got == {r[0]: i + 1 for i, r in enumerate(want)}


def test_ties_spread_over_partitions_and_number_once(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") < 1500, "hot").otherwise(F.col("id").cast("string")).alias("k")).repartition(5)
    placed = with_position(df, ["k"], partitions=8)
    assert sorted(r.place for r in placed.select("place").collect()) == list(range(1, 2001))
    assert placed.where("k = 'hot'").agg(F.max("place") - F.min("place")).first()[0] == 1499
    parts = ordered_table(df, ["k"], 8).where("k = 'hot'").select("_part").distinct().count()
    assert parts > 1


def test_numbers_inside_groups(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id int, name string, size double, r double")
    got = {r.id: r.no for r in with_position_in_group(df, ["name"], ["-r"], "no", 6).collect()}
    want = {}
    for name in {r[1] for r in rows}:
        for i, r in enumerate(sorted((r for r in rows if r[1] == name), key=lambda r: -r[3])):
            want[r[0]] = i + 1
    assert got == want
    assert with_position_in_group(df.where("false"), ["name"], ["r"]).count() == 0


def test_offsets_over_many_partitions(spark):
    n = 3 * GROUP + 5
    counts = spark.range(n).select(F.col("id").cast("int").alias("part"), (F.col("id") % 7).alias("n")).where("part % 3 <> 1")
    got = {r.part: r.offset for r in with_offsets(counts).collect()}
    want, total = {}, 0
    for p in range(n):
        if p % 3 != 1:
            want[p] = total
            total += p % 7
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("abc"), st.integers(1, 12), st.integers(1, 12)), max_size=25))
def test_coverage_equals_counting_lines(spark, ranges):
    ranges = [(k, m, min(a, b), max(a, b)) for k, m, a, b in ranges]
    df = spark.createDataFrame([(k if k else None, m, a, b, 12) for k, m, a, b in ranges], "key int, model string, first long, last long, n_lines long")
    flagged = {}
    for k, m, a, b in ranges:
        for line in range(a, b + 1):
            flagged.setdefault((k if k else None, line), set()).add(m)
    segments = coverage_segments(df, ["key"])
    got = {}
    for r in segments.collect():
        for line in range(r.line_start, r.line_end + 1):
            assert (r.key, line) not in got
            got[r.key, line] = r.n_judges
        assert got.get((r.key, r.line_start - 1)) != r.n_judges  # runs are maximal, where the one before is known
    assert got == {x: len(m) for x, m in flagged.items()}
    totals = {r.key: (r.n_flagged, r.n_majority, r.n_unanimous, r.n_lines) for r in coverage_totals(segments, df, 3, ["key"]).collect()}
    for key in {k for k, _ in flagged}:
        counts = [len(m) for (k, _), m in flagged.items() if k == key]
        assert totals[key] == (len(counts), sum(c >= 2 for c in counts), sum(c == 3 for c in counts), 12)
