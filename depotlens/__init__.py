"""depotlens — depot/customer analytics of a broker's book on Spark.

Package layout:

* ``sources``   – typed loaders of the source tables, file catalog, test-data views
* ``functions`` – column expressions (flow classes, tech names, guarded ratios, ...)
* ``operators`` – DataFrame -> DataFrame steps: features, rules, labels, metrics, QC
* ``plans``     – multi-step jobs: daily run, backfill, first-buy model, ML
* ``sinks``     – idempotent per-date writes and upserts on partitioned tables
* ``streaming`` – incremental run over arriving daily files (Structured Streaming)
"""

__version__ = "0.1.0"
