"""Findings and metrics by differences, streams with state, and the bucketed lookup."""

import os
import random

import pytest
from pyspark.sql import functions as F

from colloquy.config import AuditConfig
from colloquy.operators import metrics as me
from colloquy.operators import rolling as ro
from colloquy.operators.audit import ColumnJudge
from colloquy.operators.corpus import cell_counts, dedup_keep_first
from colloquy.operators.resolve import covered_lines, resolve_ranges
from colloquy.plans import rolling_audit as ra
from colloquy.plans.audit_job import read_verdicts
from colloquy.sinks.bucketed import store_bucketed, with_transcripts
from colloquy.sources import testdata as td
from colloquy.streaming import stateful as sf

from conftest import SF_SMALL

CONFIG = AuditConfig(judges=("a", "b"), key=("subset", "split", "encounter_id", "transcript_version"))
KEY = list(CONFIG.key)
BAD = '{"errors":[{"lines":[1,2],"reason":"x"}]}'
FINE = '{"errors":[{"lines":[-1,-1],"reason":"x"}]}'


def _corpus(spark, n=60):
    rng = random.Random(2)
    rows = [(f"E{i}", rng.choice(("aci", "vs", None)), rng.choice(("train", "valid")), rng.choice(("asr", None)), f"line {i}\nsecond") for i in range(n)]
    return spark.createDataFrame(rows, "encounter_id string, subset string, split string, transcript_version string, dialogue string").withColumn("n", F.substring("encounter_id", 2, 9).cast("int"))


def _judges(shift):
    """Answers that change from run to run; one judge's calls fail now and then."""
    return [
        ColumnJudge("a", lambda: F.when((F.col("n") + shift) % 3 == 0, BAD).otherwise(FINE)),
        ColumnJudge("b", lambda: F.when((F.col("n") + shift) % 5 == 0, BAD).when((F.col("n") + shift) % 7 != 0, FINE)),
    ]


def _rows(df):
    return sorted((str(tuple(r)) for r in df.collect()))


def _recomputed(spark, store):
    states = ro.states(read_verdicts(spark, store), KEY)
    return me.metrics(states.where("flagged").drop("flagged"), cell_counts(states), 2, ["train", "valid"]), states.where("flagged").drop("flagged")


def test_runs_by_difference_equal_a_recomputation(spark, scratch):
    corpus, root = _corpus(spark), f"{scratch}/s"
    with pytest.raises(FileNotFoundError):
        ra.rolling_metrics(spark, ra.RollingStore(root))
    runs = [(corpus.where("n < 30"), 0, False), (corpus, 0, False), (corpus.where("n % 2 = 0"), 1, True), (corpus.where("subset = 'vs'"), 2, True), (corpus, 2, False)]
    for run, (part, shift, again) in enumerate(runs, 1):
        store = ra.run_rolling_audit(spark, part, _judges(shift), root, CONFIG, run_id=run, again=again)
        metrics, findings = _recomputed(spark, store)
        assert _rows(ra.rolling_metrics(spark, store, ["train", "valid"])) == _rows(metrics)
        assert _rows(ra.rolling_findings(spark, store, CONFIG).select(*KEY, "models_with_errors", F.to_json("errors"))) == _rows(
            findings.select(*KEY, "models_with_errors", F.to_json("errors"))
        )
    # the last run once more under its id replaces its differences
    before = _rows(ra.rolling_metrics(spark, store, ["train", "valid"]))
    ra.record_run(spark, store, 5, CONFIG)
    assert _rows(ra.rolling_metrics(spark, store, ["train", "valid"])) == before
    # nothing is left to ask: an empty run changes nothing
    ra.run_rolling_audit(spark, corpus.where("n % 7 <> 5"), _judges(2), root, CONFIG, run_id=6)
    assert _rows(ra.rolling_metrics(spark, store, ["train", "valid"])) == before


def test_a_run_reads_its_subsets_partitions_only(spark, scratch):
    corpus, root = _corpus(spark), f"{scratch}/p"
    ra.run_rolling_audit(spark, corpus, _judges(0), root, CONFIG, run_id=1)
    store = ra.run_rolling_audit(spark, corpus.where("subset = 'vs'"), _judges(1), root, CONFIG, run_id=2, again=True)
    new = read_verdicts(spark, store).where("run_id = 2")
    prior = ra.prior_of(spark, store, new, 2)
    files = {f.split(store.verdicts.split("/")[-1] + "/")[1].split("/part-")[0] for f in prior.inputFiles()}
    plan = prior._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [subset" in plan.replace("isnotnull(subset#", "subset#") or "PartitionFilters" in plan
    assert {tuple(r) for r in prior.select("subset", "run_id").distinct().collect()} == {("vs", 1)} and files


def test_contributions_are_taken_back(spark):
    """Differences merge in any order and end in no rows where everything was withdrawn."""
    kind = "subset string, split string, transcript_version string, encounter_id string, judge_rank int, model string, status string, response string, run_id long"
    one = [("aci", "train", "asr", "E1", 0, "a", "ok", BAD, 1), ("aci", "train", "asr", "E1", 1, "b", "ok", BAD, 1)]
    two = [("aci", "train", "asr", "E1", 0, "a", "ok", FINE, 2), ("aci", "train", "asr", "E1", 1, "b", "ok", FINE, 2)]
    first, second = (spark.createDataFrame(r, kind) for r in (one, two))
    added = ro.cell_changes(ro.changed_states(first, None, KEY), 2)
    assert [tuple(r) for r in added.collect()] == [("aci", "train", "asr", 1, 1, 1, 1)]
    changed = ro.changed_states(second, first, KEY)
    taken = ro.cell_changes(changed, 2)
    assert [tuple(r) for r in taken.collect()] == [("aci", "train", "asr", 0, -1, -1, -1)]
    assert [tuple(r) for r in ro.merged_cells(taken.unionByName(added)).collect()] == [("aci", "train", "asr", 1, 0, 0, 0)]
    assert [r.flagged for r in ro.finding_changes(changed, KEY).collect()] == [False]
    assert ro.cell_changes(ro.changed_states(second, second, KEY), 2).count() == 0


# -- streams --------------------------------------------------------------
def test_copies_are_found_across_batches_and_restarts(spark, scratch):
    rows = [(f"E{i}", "aci" if i % 4 else None, "train", "asr", f"text {i % 7}" if i % 2 else None, 0, "f", i) for i in range(90)]
    df = spark.createDataFrame(rows, "encounter_id string, subset string, split string, transcript_version string, dialogue string, src_rank int, file_path string, row_pos long")
    for n in range(3):
        df.where(f"row_pos >= {30 * n} and row_pos < {30 * n + 30}").repartition(4).write.mode("append").parquet(f"{scratch}/in")
        query = sf.start_keep_first_stream(spark, f"{scratch}/in", df.schema, f"{scratch}/out", f"{scratch}/state")
        query.awaitTermination()
        progress = sf.start_progress_stream(spark, f"{scratch}/in", df.schema, f"{scratch}/counts", f"{scratch}/counts-state", files_per_batch=2)
        progress.awaitTermination()
    want = {r.encounter_id for r in dedup_keep_first(df.withColumn("dialogue", F.coalesce("dialogue", F.lit("")))).collect()}
    kept = spark.read.parquet(f"{scratch}/out")
    assert sorted(r.encounter_id for r in kept.collect()) == sorted(want)
    assert "dialogue" not in kept.columns
    assert {(r.subset, r.n_rows) for r in sf.read_progress(spark, f"{scratch}/counts").collect()} == {("aci", 67), (None, 23)}


def test_the_first_of_a_batch_is_found_without_python(spark):
    kind = "encounter_id string, subset string, split string, transcript_version string, digest string, src_rank int, file_path string, row_pos long"
    rows = [("c", "aci", None, "asr", "x", None, "a", 0), ("b", "aci", None, "asr", "x", 1, "f", 7), ("a", "aci", None, "asr", "x", 1, "f", 9), ("d", "aci", None, "asr", "y", 2, None, 1)]
    found = sf.first_rows(spark.createDataFrame(rows, kind))
    assert "Pandas" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.digest, r["first"].encounter_id, r["first"].at == r.latest) for r in found.collect()} == {("x", "b", True), ("y", "d", True)}


# -- bucketed lookup ------------------------------------------------------
def test_no_exchange_carries_a_dialogue(spark, scratch):
    corpus = td.corpus(spark, SF_SMALL).select("subset", "split", "encounter_id", F.when(F.col("doc_id") % 3 > 0, F.col("transcript_version")).alias("transcript_version"), "dialogue")
    store_bucketed(corpus, "corpus_in_buckets", f"{scratch}/b", 4, KEY)
    assert len([f for f in os.listdir(f"{scratch}/b") if f.startswith("part-")]) == 4
    ranges = corpus.where("encounter_id like '%7'").select(*KEY, F.lit("m").alias("model"), F.lit(0).alias("item"), F.lit(1).alias("line_start"), F.lit(2).alias("line_end"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = covered_lines(with_transcripts(spark, ranges, "corpus_in_buckets", ["dialogue"], KEY), KEY)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
        assert _rows(found) == _rows(resolve_ranges(ranges, corpus, KEY)) != []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE corpus_in_buckets")
