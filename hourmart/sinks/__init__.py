"""Writers and table maintenance on Parquet."""
