"""salesflow: retail sales data on Spark.

Batch: CSV/Parquet/JSON sources, bronze typing with rejects, silver cleaning, per-store gold,
column contracts checked between layers, tolerant reconciliation. Streaming: sales encoded as
keyed JSON messages and decoded back, with quarantine, into tables or Parquet files through
checkpointed, restartable Structured Streaming queries. Every operator is a
DataFrame -> DataFrame function on built-in Spark expressions.
"""

__version__ = "0.1.0"
