"""tidemark — change-feed (CDC) analytics on Spark.

Layers: ``sources`` (derived feeds, keyed messages, versioned snapshot tables),
``streaming`` (Bronze capture, incremental refine), ``operators`` (clean, latest per key,
merge, quality tests, inspection), ``functions`` (exact money, ISO time, distributed
positions), ``plans`` (staging, Gold, the medallion job flow, registered queries and
their SQL oracle).  Entry points: ``plans.medallion.run_medallion`` and ``cli``.
"""

__version__ = "0.1.0"
