"""Daily-series analytics on Spark: raw cumulative counters to a star schema and marts."""
