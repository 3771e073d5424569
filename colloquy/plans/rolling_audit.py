"""The audit job with findings and metrics kept by differences: a run's work follows its own transcripts, not the corpus's.

Beside ``verdicts/`` (see ``audit_job``), ``store_root`` holds

* ``cell_changes/run_id=.../``    - counts per cell that the run added or took back
* ``finding_changes/run_id=.../`` - findings that the run made, changed or withdrew, partitioned by subset too

A run reads, of the verdicts before it, only the partitions of the subsets that it judged, and there only the rows of its own
transcripts go on. Metrics are sums over ``cell_changes``: a few rows a run. A run that is repeated under its id replaces its own
partitions, provided no later run has been stored.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_AUDIT, SPLITS, AuditConfig
from colloquy.operators import audit as au
from colloquy.operators import metrics as me
from colloquy.operators import rolling as ro
from colloquy.plans.audit_job import AuditStore, add_verdicts, judge_pending, read_verdicts
from colloquy.sources.csv_files import has_files


@dataclass(frozen=True)
class RollingStore(AuditStore):
    @property
    def cell_changes(self) -> str:
        return self._p("cell_changes")

    @property
    def finding_changes(self) -> str:
        return self._p("finding_changes")


def _write_run(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def _drop_run(spark: SparkSession, path: str, run_id: int) -> None:
    """A repeated run may have fewer rows than before, or none: its old partitions go first."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/run_id={run_id}")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def prior_of(spark: SparkSession, store: RollingStore, new: DataFrame, run_id: int) -> DataFrame | None:
    """Verdicts of earlier runs in the subsets of ``new``: whole partitions of other subsets and runs are not read."""
    verdicts = read_verdicts(spark, store)
    if verdicts is None:
        return None
    subsets = [r.subset for r in new.select("subset").distinct().collect()]  # vocabulary-sized
    inside = F.col("subset").isin([s for s in subsets if s is not None])
    return verdicts.where((F.col("subset").isNull() | inside if None in subsets else inside) & (F.col("run_id") < run_id))


def record_run(spark: SparkSession, store: RollingStore, run_id: int, config: AuditConfig = DEFAULT_AUDIT) -> None:
    """Store the differences that the verdicts of ``run_id`` make."""
    key = list(config.key)
    verdicts = read_verdicts(spark, store)
    new = None if verdicts is None else verdicts.where(F.col("run_id") == run_id)
    for path in (store.cell_changes, store.finding_changes):
        _drop_run(spark, path, run_id)
    if new is None or new.isEmpty():
        return
    changed = ro.changed_states(new, prior_of(spark, store, new, run_id), key)
    run = F.lit(run_id).cast("long").alias("run_id")
    _write_run(ro.cell_changes(changed, config.n_models).select("*", run).coalesce(1), store.cell_changes, "run_id")
    _write_run(ro.finding_changes(changed, key).select("*", run), store.finding_changes, "run_id", "subset")


def run_rolling_audit(
    spark: SparkSession,
    corpus: DataFrame,
    judges: Sequence[au.Judge],
    store_root: str,
    config: AuditConfig = DEFAULT_AUDIT,
    run_id: int | None = None,
    max_attempts: int | None = None,
    again: bool = False,
) -> RollingStore:
    """Ask for what is pending (with ``again`` for everything in ``corpus``), store the verdicts and what they change."""
    store = RollingStore(store_root)
    run_id = int(time.time() * 1000) if run_id is None else run_id
    corpus = au.with_transcript_key(corpus, config.key)
    none = F.array().cast("array<string>")
    todo = corpus.withColumn("done_models", none) if again else judge_pending(spark, corpus, judges, store, config, max_attempts, run_id)
    add_verdicts(au.verdicts_long(au.fan_out(au.build_prompts(todo), judges, skip_col="done_models"), list(config.key)), store, run_id)
    record_run(spark, store, run_id, config)
    return store


def rolling_metrics(spark: SparkSession, store: RollingStore, splits: Sequence[str] = SPLITS) -> DataFrame:
    """The metrics table after all stored runs, from their differences alone."""
    if not has_files(spark, store.cell_changes, ".parquet"):
        raise FileNotFoundError(f"no runs under {store.root}")
    return me.metrics_of_cells(ro.merged_cells(spark.read.parquet(store.cell_changes)), splits)


def rolling_findings(spark: SparkSession, store: RollingStore, config: AuditConfig = DEFAULT_AUDIT) -> DataFrame:
    """The findings after all stored runs."""
    changes = spark.read.option("basePath", store.finding_changes).parquet(store.finding_changes)
    return ro.latest_findings(changes, list(config.key))
