"""Sinks: tables, JDBC, console, Kafka, and the keyed snapshot."""
