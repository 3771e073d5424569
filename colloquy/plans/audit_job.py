"""Speaker-swap audit job (J-D), resumable.

Storage layout under ``store_root`` (shared storage on a cluster):

* ``verdicts/``  - long verdict table, appended once per run (source of truth)
* ``findings/``  - flagged transcripts as JSON lines per subset (rewritten)
* ``progress/``  - keys whose judges all answered (rewritten)
* ``metrics/``   - long metrics table; ``metrics_json/`` the nested document

A run asks judges only for (transcript, judge) pairs without a successful
answer; if nothing is left it recomputes findings and metrics only (INC-2).
A run stores its slices one by one, each as one write of its own partitions:
an interrupted run keeps the finished ones, and running it again with the same run_id replaces them.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_AUDIT, SPLITS, AuditConfig
from colloquy.operators import audit as au
from colloquy.operators import corpus as co
from colloquy.operators import metrics as me
from colloquy.operators.resolve import flagged_ranges, resolve_ranges
from colloquy.sinks import findings as sk
from colloquy.sources.csv_files import has_files


@dataclass(frozen=True)
class AuditStore:
    root: str

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def verdicts(self) -> str:
        return self._p("verdicts")

    @property
    def findings(self) -> str:
        return self._p("findings")

    @property
    def progress(self) -> str:
        return self._p("progress")

    @property
    def metrics(self) -> str:
        return self._p("metrics")

    @property
    def metrics_json(self) -> str:
        return self._p("metrics_json")


@dataclass
class AuditResult:
    asked_judges: bool  # this run sent at least one transcript to a judge
    verdicts: DataFrame
    findings: DataFrame
    metrics: DataFrame


def read_verdicts(spark: SparkSession, store: AuditStore) -> DataFrame | None:
    if not has_files(spark, store.verdicts, ".parquet"):
        return None
    return spark.read.option("basePath", store.verdicts).parquet(store.verdicts)


def prior_verdicts(spark: SparkSession, store: AuditStore, run_id: int) -> DataFrame | None:
    """Verdicts of every other run. A run (or a replayed micro-batch) plans its work
    without its own earlier output, so a replay redoes exactly the same work and its
    overwrite of its own partitions is complete."""
    v = read_verdicts(spark, store)
    return None if v is None else v.where(F.col("run_id") != F.lit(run_id))


def judge_pending(
    spark: SparkSession,
    corpus: DataFrame,
    judges: Sequence[au.Judge],
    store: AuditStore,
    config: AuditConfig,
    max_attempts: int | None = None,
    run_id: int = -1,
) -> DataFrame:
    return au.judge_todo(corpus, prior_verdicts(spark, store, run_id), judges, config.key, max_attempts)


def run_audit_job(
    spark: SparkSession,
    corpus: DataFrame,
    judges: Sequence[au.Judge],
    store_root: str,
    config: AuditConfig = DEFAULT_AUDIT,
    splits: Sequence[str] = SPLITS,
    run_id: int | None = None,
    max_attempts: int | None = None,
    slices: int = 1,
) -> AuditResult:
    """One resumable run over ``corpus`` (any selection of the corpus works; what is
    not selected stays pending for a later run). A failed judge call is retried
    by later runs until it succeeds, or ``max_attempts`` times where a bound is given.

    The work is cut into ``slices`` by a hash of the key, each stored as soon as it
    is answered: a run that breaks off keeps the slices before, and the next
    run (with an id of its own) asks for the rest only.
    """
    store = AuditStore(store_root)
    key = list(config.key)
    corpus = au.with_transcript_key(corpus, key)
    run_id = int(time.time() * 1000) if run_id is None else run_id
    for n in range(slices):
        part = corpus if slices == 1 else corpus.where(F.pmod(F.xxhash64(*key), F.lit(slices)) == n)
        todo = judge_pending(spark, part, judges, store, config, max_attempts, run_id)
        wide = au.fan_out(au.build_prompts(todo), judges, skip_col="done_models")
        add_verdicts(au.verdicts_long(wide, key), store, run_id, n)
    written = read_verdicts(spark, store)
    asked = written is not None and not written.where(F.col("run_id") == run_id).select("run_id").isEmpty()
    return finish_run(spark, corpus, store, config, splits, asked, max_attempts, len(judges))


def add_verdicts(rows: DataFrame, store: AuditStore, run_id: int, part: int = 0) -> None:
    """Store one slice of a run's verdicts with the time of asking."""
    rows = rows.withColumn("run_id", F.lit(run_id).cast("long")).withColumn("slice", F.lit(part))
    sk.append_verdicts(rows.withColumn("asked_at", F.lit(int(time.time() * 1000)).cast("long")), store.verdicts)


def import_state(
    corpus: DataFrame,
    progress: DataFrame,
    findings: DataFrame,
    judges: Sequence[au.Judge],
    store_root: str,
    config: AuditConfig = DEFAULT_AUDIT,
    run_id: int = 0,
) -> None:
    """M2: take stored progress and findings (SRC-10, SRC-11) into the verdict table; later runs skip what they cover."""
    corpus = au.with_transcript_key(corpus, config.key)
    rows = au.verdicts_from_state(corpus, progress, findings, judges, config.key)
    add_verdicts(rows.withColumn("n_lines", F.lit(None).cast("int")), AuditStore(store_root), run_id)


def finish_run(
    spark: SparkSession,
    corpus: DataFrame,
    store: AuditStore,
    config: AuditConfig = DEFAULT_AUDIT,
    splits: Sequence[str] = SPLITS,
    asked: bool = False,
    max_attempts: int | None = None,
    n_judges: int | None = None,
) -> AuditResult:
    """INC-2: findings, progress and metrics are pure functions of the stored verdicts
    alone, totals included; this runs alone when nothing is pending."""
    key = list(config.key)
    verdicts = read_verdicts(spark, store)
    if verdicts is None:
        raise RuntimeError(f"no verdicts under {store.verdicts}")
    gathered = au.gather_verdicts(verdicts, key)
    sk.write_findings(au.findings(gathered, key), store.findings)
    n_judges = n_judges or config.n_models
    sk.write_progress(au.progress_from_verdicts(verdicts, key, n_judges, max_attempts), store.progress)
    findings = spark.read.schema(_finding_schema(key)).option("basePath", store.findings).json(store.findings)
    # Every transcript that any run has judged, as the findings come from all runs too.
    totals = co.cell_counts(gathered)
    sk.write_metrics(me.metrics(findings, totals, config.n_models, splits), store.metrics, store.metrics_json)
    return AuditResult(asked, verdicts, findings, spark.read.parquet(store.metrics))


def read_findings(spark: SparkSession, store_root: str, config: AuditConfig = DEFAULT_AUDIT) -> DataFrame:
    store = AuditStore(store_root)
    return spark.read.schema(_finding_schema(config.key)).option("basePath", store.findings).json(store.findings)


def resolve_findings(
    spark: SparkSession,
    corpus: DataFrame,
    store_root: str,
    config: AuditConfig = DEFAULT_AUDIT,
) -> DataFrame:
    """JOIN-7 as a job step: every line inside a flagged range of the stored findings,
    with the judge that flagged it (the manual lookup of the published notes, as a join)."""
    key = list(config.key)
    ranges = flagged_ranges(read_findings(spark, store_root, config), key)
    return resolve_ranges(ranges, au.with_transcript_key(corpus, key), key)


def _finding_schema(key: Sequence[str]):
    from pyspark.sql import types as T

    from colloquy.schemas import FINDING

    extra = [T.StructField(k, T.StringType()) for k in key if k not in FINDING.fieldNames()]
    return T.StructType(FINDING.fields + extra)
