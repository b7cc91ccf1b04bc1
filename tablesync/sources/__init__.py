"""Reading and writing tables: Parquet folders, JDBC, the ledger."""
