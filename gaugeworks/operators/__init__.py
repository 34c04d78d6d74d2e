"""DataFrame operators Spark has no single built-in for."""
