"""The warehouse models: staging, dimensions, fact, aggregates, reports."""
