"""Audit sinks: verdicts, findings, progress, metrics (SNK-3, SNK-4, SNK-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from colloquy.operators.metrics import metrics_document


def append_verdicts(verdicts: DataFrame, path: str) -> None:
    """Add one run's verdicts to the verdict table, idempotently.

    Every run (or stream micro-batch) has its own ``run_id`` and lands in its own
    (subset, run_id, slice) partitions, written with dynamic partition overwrite: a
    retried run or a replayed micro-batch replaces exactly what it wrote before,
    an empty batch changes nothing, and other runs are never touched.
    """
    (
        verdicts.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("subset", "run_id", "slice")
        .parquet(path)
    )


def write_findings(findings: DataFrame, path: str) -> None:
    """SNK-3: findings as JSON lines, one folder per subset, fully rewritten from the verdicts."""
    findings.write.mode("overwrite").partitionBy("subset").json(path)


def write_progress(progress: DataFrame, path: str) -> None:
    """SNK-4: the processed keys as a Parquet table (derived from the verdicts)."""
    progress.write.mode("overwrite").partitionBy("subset").parquet(path)


def write_metrics(metrics_long: DataFrame, path: str, json_path: str | None = None) -> None:
    """SNK-5: the long metrics table, and optionally the nested JSON document (vocabulary-sized)."""
    metrics_long.coalesce(1).write.mode("overwrite").parquet(path)
    if json_path:
        spark = metrics_long.sparkSession
        metrics_document(spark.read.parquet(path)).coalesce(1).write.mode("overwrite").text(json_path)
