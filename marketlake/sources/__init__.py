"""Raw inputs: Hive-partitioned Parquet readers, the sector seed, the symbol
universe, API payload flattening, provider merge and raw writers."""
