"""Column-level helpers (all JVM-side built-ins)."""
