"""Event-log analytics on Spark: one set of DataFrame operators for tables and streams."""
