"""Column-level helpers (JVM-side expressions, no Python UDFs)."""
