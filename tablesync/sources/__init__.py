"""Sources: change events, Kafka records, NDJSON, JDBC scans, settings."""
