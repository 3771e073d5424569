"""Plan shape: the scale properties the operators rely on, checked on the physical plans."""

import re

import pytest

from colloquy.plans.catalog import QUERIES

from conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(q(spark, SF_SMALL)) for name, q in QUERIES.items()}


def test_no_pairwise_joins_and_no_row_udfs(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan, name  # Python only through Arrow batches


def test_python_only_where_text_is_folded(plans):
    with_python = {n for n, p in plans.items() if "ArrowEvalPython" in p}
    assert with_python == {"normalize_ascii", "normalize_ascii_turns", "union_sources", "prompt_judge", "normalize_mapped"}


@pytest.mark.parametrize("name", ["dedup_keep_first", "union_sources", "sample_per_cell"])
def test_top_k_is_reduced_before_the_shuffle(plans, name):
    plan = plans[name]
    partial = plan.find("WindowGroupLimit")
    assert "Partial" in plan and "Final" in plan
    # The partial limit sits below (after, in the printed tree) the exchange.
    assert plan.rfind("Partial") > plan.find("Exchange hashpartitioning") > partial >= 0


@pytest.mark.parametrize(
    "name",
    ["counts_long", "counts_rollup", "counts_pivot_version", "notes_per_cell", "list_cells", "manifest", "extra_versions"],
)
def test_counting_never_reads_the_text(plans, name):
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plans[name])
    assert schemas and all("text" not in s for s in schemas), schemas


def test_aggregations_combine_map_side(plans):
    for name in ["counts_long", "notes_per_cell", "consensus", "progress_counts"]:
        assert "partial_count" in plans[name] or "partial_sum" in plans[name], name


def test_metrics_is_one_grouping_sets_pass(plans):
    plan = plans["metrics_cube"]
    assert plan.count("Expand") == 2  # findings cells and corpus totals, each expanded once


def test_published_read_prunes_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    from colloquy.sinks.layout import write_corpus
    from colloquy.sources import testdata as td
    from colloquy.sources.tables import read_corpus

    root = str(tmp_path / "corpus")
    write_corpus(td.corpus(spark, SF_SMALL), root, ["encounter_id", "transcript_version", "dialogue"])
    df = read_corpus(spark, root, subset="en", split="train+valid").select("encounter_id")
    plan = plan_of(df)
    assert re.search(r"PartitionFilters: \[.*subset.*en.*split.*train", plan.replace("\n", " ")), plan
    assert "dialogue" not in re.findall(r"ReadSchema: (struct<[^>]*>)", plan)[0]
    assert df.count() == td.corpus(spark, SF_SMALL).where(F.col("subset") == "en").where(
        F.col("split").isin("train", "valid")
    ).count()


def _shuffle_records(df) -> list[int]:
    """Records written by every shuffle of an executed DataFrame (final adaptive plan)."""

    def walk(node, acc):
        if "QueryStage" in node.nodeName():
            walk(node.plan(), acc)
        if "ShuffleExchange" in node.getClass().getSimpleName():
            acc.append(int(node.metrics().apply("shuffleRecordsWritten").value()))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), acc)
        return acc

    plan = df._jdf.queryExecution().executedPlan()
    return walk(plan.executedPlan() if hasattr(plan, "executedPlan") else plan, [])


def test_hot_key_collapses_before_the_shuffle(spark):
    """A dialogue copied across a third of the rows leaves each map task as one row."""
    from pyspark.sql import functions as F

    from colloquy.operators.corpus import dedup_keep_first

    n, parts = 30000, 6
    df = spark.range(n, numPartitions=parts).select(
        F.lit("aci").alias("subset"),
        F.lit("train").alias("split"),
        F.lit("asr").alias("transcript_version"),
        F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("d"), F.col("id").cast("string"))).alias(
            "dialogue"
        ),
        F.lit(0).alias("src_rank"),
        F.lit("f").alias("file_path"),
        F.col("id").alias("row_pos"),
    )
    out = dedup_keep_first(df)
    rows = out.collect()
    distinct_other = n - n // 3
    assert len(rows) == distinct_other + 1
    assert [r.row_pos for r in rows if r.dialogue == ""] == [0]  # the first copy is kept
    assert _shuffle_records(out) == [distinct_other + parts]


def test_counted_dedup_equals_window_dedup_and_collapses_map_side(spark):
    from pyspark.sql import functions as F

    from colloquy.operators.corpus import dedup_keep_first, dedup_keep_first_counted

    n, parts = 30000, 6
    df = spark.range(n, numPartitions=parts).select(
        F.lit("aci").alias("subset"),
        (F.col("id") % 2).cast("string").alias("split"),
        F.lit("asr").alias("transcript_version"),
        F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("d"), (F.col("id") % 9000).cast("string")))
        .alias("dialogue"),
        F.lit(0).alias("src_rank"),
        F.lit("f").alias("file_path"),
        F.col("id").alias("row_pos"),
    )
    counted = dedup_keep_first_counted(df)
    rows = counted.collect()
    window = {tuple(r) for r in dedup_keep_first(df).collect()}
    assert {tuple(r)[:-1] for r in rows} == window
    assert sum(r.n_copies for r in rows) == n
    distinct = len(window)
    # Map-side combine: each map task emits at most one row per distinct key.
    (written,) = _shuffle_records(counted)
    assert distinct <= written <= distinct * parts and written < n


def test_plans_carry_no_broadcast_hint(spark):
    from colloquy.operators import audit as au
    from colloquy.operators.resolve import flagged_ranges, resolve_ranges
    from colloquy.sources import testdata as td

    key = list(td.TESTDATA_AUDIT.key)
    corpus = td.labelled_prompt_inputs(spark, SF_SMALL)
    wide = au.fan_out(au.build_prompts(corpus.where("split <> 'valid'")), td.testdata_judges())
    todo = au.judge_todo(corpus, au.verdicts_long(wide, key), td.testdata_judges(), key)
    assert {r.split for r in todo.select("split").distinct().collect()} >= {"valid"}
    lines = resolve_ranges(flagged_ranges(au.findings(wide, key), key), corpus, key)
    for df in (todo, lines):
        assert "ResolvedHint" not in df._jdf.queryExecution().optimizedPlan().toString()
        assert "hint" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


def _exchanged(df) -> str:
    """The attributes that exchanges of a plan carry or deal by."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    optimized = df._jdf.queryExecution().executedPlan().toString()
    return plan + "\n".join(x for x in optimized.splitlines() if "Exchange" in x)


def test_dedup_and_samples_exchange_no_text(spark):
    from colloquy.plans.catalog import QUERIES

    for name in ("dedup_keep_first", "dedup_counted", "dedup_report", "union_sources", "sample_per_cell"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        for i, x in enumerate(lines):
            if "Exchange" in x:
                assert "dialogue" not in x and "text" not in x
                below = next(y for y in lines[i + 1 :] if "Project" in y or "Aggregate" in y or "Scan" in y)
                assert not re.search(r"(dialogue|text)#\d+(?=[,\]])", below.split("Project", 1)[-1]), (name, below)


def test_sample_is_exact_and_bounded_for_a_hot_cell(spark):
    from pyspark.sql import functions as F

    from colloquy.operators.corpus import sample_per_cell

    n_rows, parts, buckets = 20000, 8, 1024
    df = spark.range(n_rows, numPartitions=parts).select(
        # One real cell holding every row (a computed column, so the optimizer cannot fold it away).
        F.when(F.col("id") >= 0, F.lit("aci")).otherwise(F.lit("other")).alias("subset"),
        F.when(F.col("id") >= 0, F.lit("train")).otherwise(F.lit("other")).alias("split"),
        F.lit(0).alias("src_rank"),
        F.lit("f").alias("file_path"),
        (n_rows - F.col("id")).alias("row_pos"),
    )
    s = sample_per_cell(df, n=5, buckets=buckets)
    rows = s.collect()
    assert sorted(r.row_pos for r in rows) == [1, 2, 3, 4, 5]
    assert [r.sample_rank for r in sorted(rows, key=lambda r: r.row_pos)] == [1, 2, 3, 4, 5]
    first, second = sorted(_shuffle_records(s), reverse=True)
    assert first <= 5 * buckets * parts and second <= 5 * buckets
