"""parley: conversation analytics as Spark DataFrame jobs.

Subpackages: ``sources`` (schemas, readers, fixture derivations),
``functions`` (Column-level time and working-hours rules), ``operators``
(reusable DataFrame operators: skew-safe lag, hours lookups, upsert,
statistics), ``plans`` (end-to-end queries) and ``streaming`` (incremental
refresh driven by Structured Streaming).
"""
