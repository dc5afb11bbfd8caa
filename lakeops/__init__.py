"""lakeops: lakehouse data operators written as plain Spark DataFrame code.

Sub-packages:
  sources    readers (files, records, JDBC) and test-data views
  functions  column expressions (cleaning, time features, row statistics)
  operators  DataFrame -> DataFrame operators (rolling windows, as-of join, ...)
  plans      tables, dataset graph, incremental views, feature tables
  streaming  Structured Streaming ingest and stateful operators
  registry   the registered queries and their DuckDB oracles
"""

__version__ = "0.1.0"
