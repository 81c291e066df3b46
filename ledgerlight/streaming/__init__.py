"""Incremental maintenance (late data, upserts, appends) and streaming ingestion."""
