"""Column-level helpers (JVM-side expressions; one Arrow UDF for difflib)."""
