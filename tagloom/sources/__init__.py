"""Reading and writing: CSV landing, parquet tables, run records."""
