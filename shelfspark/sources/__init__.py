"""Sources and sinks: CSV feeds, Parquet tables, driver test tables."""
