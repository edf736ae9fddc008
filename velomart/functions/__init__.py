"""Column helpers: every derived value is a built-in Spark expression (no UDFs)."""
