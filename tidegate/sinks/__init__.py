"""Writers of partitioned Parquet datasets."""
