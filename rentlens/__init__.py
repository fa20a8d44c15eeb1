"""rentlens — rental-listings ingest, cleaning and dashboard queries on Spark.

Layout:
  schema.py     canonical listings schema and the fixed lookup values
  session.py    SparkSession builder and checkpoint-dir handling
  functions/    Column-level helpers (cleaning, area lookup, derived fields)
  sources/      readers: parquet tables, JSON payloads, captured HTML pages
  operators/    filters, joins, dashboard sheets, windows, table writes
  plans/        bounded-broadcast joins, test-table stand-ins, query registry
  streaming/    Structured Streaming ingest, dedupe, upsert, daily counts
"""

__version__ = "0.1.0"
