"""Reading and publishing readings: Parquet trees, delimited parts, tables, incremental loads."""
