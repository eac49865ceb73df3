"""Table registry, raw ingestion, layer storage and the nested report."""
