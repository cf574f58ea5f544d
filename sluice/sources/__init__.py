"""Readers: Kafka, replayed record files, JDBC, call requests."""
