"""Sinks: partitioned corpus, samples, manifest, counts CSV, verdicts, findings, progress, metrics."""
