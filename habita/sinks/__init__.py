"""Sinks: Parquet lake, keyed serving table (JDBC or Parquet), CSV feed, console."""
