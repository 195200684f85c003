"""Event-driven analytics on Spark: parsing, windows, joins, enrichment, inference and sinks."""
