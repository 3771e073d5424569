"""Properties from the test plan: dedup idempotent, majority contains unanimity, totals add up."""

from pyspark.sql import functions as F

from colloquy.functions import verdict as vd
from colloquy.operators import audit as au
from colloquy.operators import corpus as co
from colloquy.operators import metrics as me
from colloquy.sources import testdata as td

from conftest import SF_SMALL

KEY = list(td.TESTDATA_AUDIT.key)


def test_dedup_is_idempotent(spark):
    corpus = td.corpus(spark, SF_SMALL)
    once = co.dedup_keep_first(corpus)
    twice = co.dedup_keep_first(once)
    cols = ["encounter_id", "subset", "split", "transcript_version"]
    assert sorted(map(tuple, once.select(*cols).collect())) == sorted(map(tuple, twice.select(*cols).collect()))
    counted = co.dedup_keep_first_counted(once)
    assert counted.where("n_copies <> 1").count() == 0


def test_majority_contains_unanimity(spark):
    wide = au.fan_out(au.build_prompts(td.labelled_prompt_inputs(spark, SF_SMALL)), td.testdata_judges())
    f = au.findings(wide, KEY)
    n = td.TESTDATA_AUDIT.n_models
    flags = f.select(
        vd.unanimous("models_with_errors", n).alias("u"), vd.majority(F.size("models_with_errors"), n).alias("m")
    )
    assert flags.where("u AND NOT m").count() == 0
    assert flags.count() > 0


def test_metric_levels_add_up(spark):
    corpus = td.corpus(spark, SF_SMALL)
    wide = au.fan_out(au.build_prompts(td.labelled_prompt_inputs(spark, SF_SMALL)), td.testdata_judges())
    m = me.metrics(au.findings(wide, KEY), co.cell_counts(corpus), td.TESTDATA_AUDIT.n_models).collect()
    summary = next(r for r in m if r.grouping == "summary")
    for level in ("by_subset", "by_split", "by_subset_and_split", "by_transcript_version"):
        rows = [r for r in m if r.grouping == level]
        assert sum(r.notes_with_errors for r in rows) == summary.notes_with_errors, level
        assert sum(r.majority_consensus_errors for r in rows) == summary.majority_consensus_errors, level
        if level != "by_transcript_version":
            assert sum(r.total_notes for r in rows) == summary.total_notes == corpus.count(), level
