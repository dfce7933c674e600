"""Document store and keyed tables on Parquet."""
