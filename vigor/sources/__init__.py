"""Sources: table catalog, raw-shape adapters and ingest jobs."""
