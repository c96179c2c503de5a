"""Column-expression helpers (pure functions Column -> Column; all JVM built-ins)."""
