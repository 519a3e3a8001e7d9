"""Reading and writing: CSV, Parquet, text, catalog tables, JDBC, JSON artifacts."""
