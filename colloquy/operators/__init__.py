"""DataFrame -> DataFrame operators: corpus, counts, audit, metrics, resolve."""
