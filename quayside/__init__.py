"""Equipment telemetry on Spark: cleaning, dead letter, hourly facts, serving queries."""
