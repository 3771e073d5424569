"""All registered queries of the library with their oracles."""

from colloquy.plans import catalog, catalog_jobs

QUERIES = {**catalog.QUERIES, **catalog_jobs.QUERIES}
ORACLE_SQL = {**catalog.ORACLE_SQL, **catalog_jobs.ORACLE_SQL}
