"""Sources and sinks: JSON lines, JDBC, layered parquet tables."""
