"""DuckDB oracle SQL and a local Spark-vs-DuckDB comparison harness."""
