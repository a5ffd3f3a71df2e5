"""marketlake — a PySpark-native equity-market ELT and analytics library.

Every operator is a ``DataFrame -> DataFrame`` transform built from
``pyspark.sql.functions`` so Catalyst can prune, push down and fuse it.
Sub-packages:

* ``functions`` — column helpers (safe division, symbol normalisation, ...)
* ``sources``   — raw readers, payload flattening, provider merge, raw writers
* ``operators`` — staging, time-series windows, marts, metrics, incremental
                  loads, type-2 history, layout and data-quality checks
* ``plans``     — end-to-end pipelines, dashboard queries, fixtures and the
                  query registry used by ``__spark_entry__``
* ``streaming`` — Structured Streaming form of the incremental fact refresh
"""

__version__ = "0.1.0"
