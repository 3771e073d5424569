"""The four jobs chained as a user runs them: build -> counts -> audit -> metrics."""

import os

import pandas as pd
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_AUDIT, AuditConfig
from colloquy.operators import audit as au
from colloquy.plans.audit_job import resolve_findings, run_audit_job
from colloquy.plans.build import build_extended
from colloquy.plans.reports import count_published
from colloquy.sources.tables import read_corpus_record

from test_build import documents_as_files, write_csv


def first_line_judge(name, letter):
    """Flags the first line when the transcript's first character is ``letter``."""

    def answer(prompts: pd.Series) -> pd.Series:
        def one(p):
            if p is None:
                return None
            body = p.split("Here is a full transcript for you to analyze:\n", 1)[1]
            first = body.split(": ", 1)[1][:1] if ": " in body else ""
            lines = "[1,1]" if first == letter else "[-1,-1]"
            return '{"errors":[{"lines":%s,"reason":"first letter"}]}' % lines

        return prompts.map(one)

    return au.BatchJudge(name, answer)


def test_build_count_audit(spark, scratch):
    data = os.path.join(scratch, "data")
    documents_as_files(spark, data)
    # A variant file without an id column: every row gets encounter_id ''.
    write_csv(
        os.path.join(data, "extra", "valid_virtscribe_asr.csv"),
        ["dialogue", "note"],
        [["E first", "n"], ["E second", "n"], ["T third", "n"]],
    )
    out = os.path.join(scratch, "out")
    res = build_extended(spark, data, out)

    # J-C on the published layout, with the long-form CSV (SNK-6).
    csv_path = os.path.join(scratch, "counts_csv")
    rep = count_published(spark, res.data_root, out_csv=csv_path)
    total = rep.by_split.collect()[-1]
    assert total.subset == "ALL" and total.Total == res.corpus.count()
    back = spark.read.option("header", True).csv(csv_path)
    assert back.columns == ["subset", "split", "transcript_version", "count"]
    assert sum(int(r["count"]) for r in back.collect()) == total.Total

    # J-D on the published corpus with the default (content-aware) key.
    corpus = read_corpus_record(spark, res.data_root)
    judges = [first_line_judge("judge/e", "E"), first_line_judge("judge/t", "T"), first_line_judge("judge/e2", "E")]
    cfg = AuditConfig(judges=tuple(j.name for j in judges))
    assert "transcript_key" in cfg.key and cfg.key[:4] == DEFAULT_AUDIT.key[:4]
    result = run_audit_job(spark, corpus, judges, os.path.join(scratch, "audit"), cfg, run_id=1)

    empty_id = result.findings.where("subset = 'virtscribe' AND split = 'valid' AND encounter_id = ''")
    assert empty_id.count() == 3  # three transcripts with id '' stay three findings
    by_models = {r.m: r.n for r in empty_id.groupBy(F.array_join("models_with_errors", ",").alias("m")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert by_models == {"judge/e,judge/e2": 2, "judge/t": 1}

    m = {(r.grouping, r.subset, r.split): r for r in result.metrics.collect()}
    summary = m[("summary", None, None)]
    assert summary.total_notes == res.corpus.count()
    assert summary.notes_with_errors == result.findings.count()
    flagged_e = corpus.where(F.substring("dialogue", 1, 1).isin("E", "T")).count()
    assert summary.notes_with_errors == flagged_e
    assert summary.majority_consensus_errors == corpus.where(F.substring("dialogue", 1, 1) == "E").count()

    # JOIN-7 on the stored findings: every flag here is [1, 1], so one line per (transcript, judge),
    # the first line of the transcript.
    small = resolve_findings(spark, corpus, os.path.join(scratch, "audit"), cfg)
    lines = small.where("subset = 'virtscribe' AND split = 'valid' AND encounter_id = ''").select("model", "line").collect()
    assert sorted((r.model, r.line) for r in lines) == [
        ("judge/e", "E first"), ("judge/e", "E second"), ("judge/e2", "E first"), ("judge/e2", "E second"),
        ("judge/t", "T third"),
    ]
    assert small.count() == sum(len(r.models_with_errors) for r in result.findings.collect())
    assert small.where("line_no <> 1").count() == 0
