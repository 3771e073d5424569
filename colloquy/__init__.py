"""colloquy: build, count and audit dialogue-transcript corpora with Spark.

Jobs (each takes the caller's SparkSession):

* ``colloquy.plans.build.build_basic`` / ``build_extended`` - CSV splits (and variant files) to a
  Parquet corpus partitioned by (subset, split), with samples, manifest and dedup report.
* ``colloquy.plans.reports.count_report`` / ``count_published`` - counts, rollups and pivots.
* ``colloquy.plans.audit_job.run_audit_job`` - resumable speaker-swap audit with pluggable judges,
  findings and six-grouping metrics; ``colloquy.streaming.incremental.start_audit_stream`` runs the
  same work as a stream.

Building blocks are ``DataFrame -> DataFrame`` functions in ``colloquy.operators`` and ``Column``
functions in ``colloquy.functions``; vocabularies are parameters in ``colloquy.config``.
"""

from colloquy.config import AuditConfig, BuildOptions, Vocabulary

__all__ = ["AuditConfig", "BuildOptions", "Vocabulary"]
__version__ = "0.1.0"
