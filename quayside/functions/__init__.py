"""Column expressions: pure, JVM-side, no data access."""
