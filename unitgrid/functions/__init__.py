"""Column-level functions; everything here stays inside JVM expressions."""
