"""Sources and sinks: daily index texts, filing texts, the partitioned Parquet lake, and the
inputs derived from the driver tables (fixtures, rendered texts)."""
