"""bundleflow: Spark-native pipeline and analytics for nested JSON bundles.

Layers:
  sources/    file and table scans (whole-file text, file metadata, inventories)
  functions/  column-level helpers for VARIANT paths, casts and strings
  operators/  DataFrame-to-DataFrame operators (explode, pivot, key drift, joins, checks)
  plans/      composite jobs (bronze, resources, silver, bundle views, reports, write-back)
  streaming/  incremental hops with Structured Streaming (availableNow, foreachBatch)
  sinks/      materialisation, replay-safe writes, file copies
"""

__version__ = "0.1.0"
