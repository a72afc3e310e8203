"""Adapters that let the shared test tables stand in for telemetry."""
