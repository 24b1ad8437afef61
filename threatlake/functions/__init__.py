"""Column functions, all built from JVM-side expressions."""
