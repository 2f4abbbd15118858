"""Security-telemetry processing on Spark: packets, flows, sessions, events and metrics."""
