"""The jobs (build, reports, audit), the registered query catalog with its oracles, oracle compare."""
