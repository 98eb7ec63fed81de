"""Ways to keep results: partitioned Parquet, keyed upserts, JDBC, keyed messages."""
