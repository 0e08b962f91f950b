"""Order analytics on Spark: ingestion, incremental warehouse, marts and questions."""
