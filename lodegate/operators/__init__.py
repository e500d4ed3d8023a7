"""Table operators: gates, deduplication, resolution, enrichment, storage, export."""
