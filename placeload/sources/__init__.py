"""Reading from and writing to parquet, catalog tables and JDBC."""
