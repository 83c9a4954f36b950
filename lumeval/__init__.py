"""lumeval: text evaluation and dataset curation as Spark DataFrame/SQL jobs.

``functions`` holds Column expressions and small per-token helpers,
``operators`` the operators, ``sources`` scans, derived views and the
versioned catalog, ``plans`` the named queries with their SQL oracles, and
``streaming`` the Structured Streaming entry points.
"""

__version__ = "0.1.0"
