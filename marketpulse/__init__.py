"""marketpulse — trade analytics and risk monitoring on Spark.

Every transform is a plain ``DataFrame -> DataFrame`` function, so the same
code serves a batch refresh and a Structured Streaming micro-batch.

Layout
------
``functions``  column expressions (time parsing, money rounding, sign rules)
``sources``    file streams, JDBC, CSV, change logs, driver-table views
``operators``  quality rules, dedup, lookups, SCD2, silver and gold tables
``plans``      skew-safe building blocks, table store, the refresh pipeline
``streaming``  streaming pipelines, sinks and triggers
"""

__version__ = "0.1.0"
