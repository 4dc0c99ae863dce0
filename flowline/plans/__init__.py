"""End-to-end plans (ingest, train, search, score) and the query catalogue."""
