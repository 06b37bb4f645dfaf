"""DataFrame -> DataFrame operators: ingestion, cleaning, profiling, merge."""
