"""releasekit: versioned public-dataset releases as Spark DataFrame jobs.

Subpackages: ``sources`` (readers, writers, dump shapes), ``functions`` (column
expressions, schema walkers), ``operators`` (filters, summaries, sets, registry,
quality, compare, ontology, ingest), ``streaming`` (snapshots) and ``plans`` (the
registered queries over the test tables).
"""
