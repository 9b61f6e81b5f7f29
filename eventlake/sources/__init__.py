"""Sources and sinks: raw dumps -> Bronze, Parquet tables, test-table adapters."""
