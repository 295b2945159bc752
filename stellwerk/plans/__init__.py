"""Complete jobs over the benchmark tables."""
