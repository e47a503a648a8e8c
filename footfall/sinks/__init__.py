"""Sinks: versioned day state, ORC/parquet tables and JDBC."""
