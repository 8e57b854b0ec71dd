"""DataFrame to DataFrame operators: lookups, ordered series, quality checks."""
