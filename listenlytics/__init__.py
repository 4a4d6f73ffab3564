"""Daily listening analytics on Spark: check, enrich, aggregate, rank, upsert, serve."""
